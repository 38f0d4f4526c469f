"""Views of the given tables with the shapes of gridded data, in one SQL text for Spark and others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: {ts} is the timestamp type without a zone; the tables stand in braces.
VIEWS = {
    "grid_raw": """
SELECT CASE l_returnflag WHEN 'A' THEN 't2m' WHEN 'N' THEN 'tp' ELSE 'sp' END AS short_name,
       l_shipdate AS valid_time,
       CAST(90 AS DOUBLE) - CAST((l_suppkey * 11) % 721 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS lat,
       CAST((l_partkey * 11) % 1440 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS lon,
       l_linenumber AS revision,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 5 END AS expver,
       CASE WHEN l_quantity >= 50 THEN CAST(-9999 AS DOUBLE) ELSE l_quantity END AS band1
FROM {lineitem}""",
    "grid_dense": """
SELECT CAST(date_trunc('month', l_shipdate) AS {ts}) AS time,
       CAST(l_suppkey % 10 AS INT) AS lat_idx,
       CAST(l_partkey % 36 AS INT) AS lon_idx,
       l_linenumber AS revision,
       CASE WHEN l_quantity >= 50 THEN NULL ELSE l_quantity END AS value
FROM {lineitem}""",
    "grid_pixels": """
SELECT l_returnflag AS path,
       CAST(l_orderkey % 42 AS INT) AS pix_row,
       CAST(l_partkey % 50 AS INT) AS pix_col,
       max(CASE WHEN (l_orderkey % 42 * 50 + l_partkey % 50) % 6 = 0
                  OR (l_orderkey % 42 < 4 AND l_partkey % 50 < 4) THEN NULL
                ELSE l_quantity END) AS value
FROM {lineitem} GROUP BY 1, 2, 3""",
    "obs_hourly": """
SELECT event_type AS dataset,
       CAST(date_trunc('hour', ts) AS {ts}) AS time,
       CAST(date_trunc('day', ts) AS {ts}) AS ref_time,
       CAST(extract(hour FROM ts) AS INT) AS step_hours,
       user_id AS cell, event_id, ts, value
FROM {events}""",
    "src_manifest": """
SELECT o_orderstatus AS dataset, o_orderdate AS period_start, o_orderkey AS file_id,
       CAST(o_orderkey % 8 + 1 AS INT) AS revision,
       CAST(o_orderkey * 37 % 5000 AS BIGINT) AS size_bytes
FROM {orders} WHERE o_orderkey % 5 <> 0""",
    "disk_manifest": """
SELECT o_orderstatus AS dataset, o_orderdate AS period_start, o_orderkey AS file_id,
       CAST((o_orderkey * 3) % 8 + 1 AS INT) AS revision
FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "catalog_input": """
SELECT r.r_name AS collection, n.n_name AS item,
       CASE WHEN n.n_name LIKE '%7' OR min(s.s_suppkey) IS NULL THEN 'null'
            ELSE concat('v', CAST(min(s.s_suppkey) AS VARCHAR(20))) END AS version
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
LEFT JOIN {supplier} s ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or one of the given tables."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return over(spark, name, {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in VIEWS[name]})


def over(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """A view over these tables."""
    return spark.sql(VIEWS[name].format(ts="TIMESTAMP_NTZ", **{t: f"{{{t}}}" for t in tables}), **tables)


def with_views(sql: str) -> str:
    """SQL that stands after the views it names; its own WITH clauses begin with a comma."""
    names = [v for v in VIEWS if v in sql]
    own = {t: t for t in TABLES}
    views = ",\n".join(f"{v} AS ({VIEWS[v].format(ts='TIMESTAMP', **own)})" for v in names)
    sql = sql.strip()
    head = f"WITH RECURSIVE {views}" if names else ""
    if sql.startswith(","):
        return f"{head}\n{sql}" if names else f"WITH RECURSIVE {sql[1:]}"
    return f"{head}\n{sql}"
