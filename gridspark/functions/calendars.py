"""Calendars of periods, from bounds that a table gives or that are given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dekad_calendar(bounds: DataFrame, start: str = "start", end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, time: every 1st, 11th and 21st between the bounds of each row, both counted, at midnight.

    Bounds are cut to midnight; a row whose end is before its start has none.
    """
    rows = bounds.select(*keys, F.to_date(start).alias("_a"), F.to_date(end).alias("_b")).where("_a <= _b")
    months = rows.withColumn("_m", F.explode(F.expr("sequence(trunc(_a, 'month'), _b, interval 1 month)")))
    days = months.withColumn("_n", F.explode(F.array(F.lit(0), F.lit(10), F.lit(20)))).withColumn("_d", F.date_add("_m", F.col("_n")))
    return days.where("_d between _a and _b").select(*keys, F.col("_d").cast("timestamp_ntz").alias("time"))


def period_calendar(bounds: DataFrame, period: str, start: str = "start", end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, time: every period from start to end, both counted, stepping by hour, day, month or year."""
    if period not in {"hour", "day", "month", "year"}:
        raise ValueError(period)
    rows = bounds.where(F.col(start) <= F.col(end))
    return rows.select(*keys, F.explode(F.expr(f"sequence(`{start}`, `{end}`, interval 1 {period})")).alias("time"))


def expand_request(requests: DataFrame, period: str, ts: str = "ts") -> DataFrame:
    """Each request's hours as rows, hour_start: one for an hour, 24 for a day, all of its month for a month."""
    begin = F.date_trunc(period, ts).cast("timestamp_ntz")
    ends = {"hour": "_a", "day": "_a + interval 23 hour", "month": "_a + interval 1 month - interval 1 hour"}
    if period not in ends:
        raise ValueError(period)
    rows = requests.withColumn("_a", begin)
    end = ends[period]
    return rows.withColumn("hour_start", F.explode(F.expr(f"sequence(_a, {end}, interval 1 hour)"))).drop("_a")


def slabs(times: DataFrame, batch: int, time: str = "time") -> DataFrame:
    """slab_id of each distinct time: runs of batch times in order. batch has to be positive.

    The times are an axis, not observations: they are few, and are numbered by years in
    parallel, with the years' counts summed first.
    """
    if batch < 1:
        raise ValueError("batch has to be positive")
    from gridspark.operators.stats import numbered

    return numbered(times.select(time).distinct(), time).withColumn("slab_id", F.floor(F.col("idx") / batch).cast("int"))
