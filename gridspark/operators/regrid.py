"""Rasters to points, block averages and nearest-neighbour regridding."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.columns import axis_position, pixel_centre
from gridspark.session import small


def raster_to_points(tiles: DataFrame) -> DataFrame:
    """Tiles with row-major pixels and an affine transform (a, b, c, d, e, f) to a row a pixel.

    Coordinates are those of pixel centres, for transforms without rotation; the nodata value
    and NaN are null.
    """
    pixels = tiles.select("path", "time", "band", "width", "transform", "nodata", F.posexplode("pixels").alias("_pos", "_v"))
    row, col = F.floor(F.col("_pos") / F.col("width")).cast("int"), (F.col("_pos") % F.col("width")).cast("int")
    t = lambda i: F.col("transform")[i]
    gone = F.isnan("_v") | F.coalesce(F.col("_v") == F.col("nodata"), F.lit(False))
    return pixels.select("path", "time", "band", row.alias("pix_row"), col.alias("pix_col"), (t(5) + t(4) * (row + 0.5)).alias("latitude"), (t(2) + t(0) * (col + 0.5)).alias("longitude"), F.when(~gone, F.col("_v")).alias("value"))


def overlaps(index: Column, size: int, out: int) -> Column:
    """Of a source pixel, the target pixels that it lies in when size pixels are stretched over out: an array of (out, weight).

    Weights are whole numbers, in proportion to the shares of the pixel's length.
    """
    g = math.gcd(size, out)
    wide, long = out // g, size // g  # lengths of a source and of a target pixel
    first, last = F.floor(index * wide / long), F.floor(((index + 1) * wide - 1) / long)
    weight = lambda j: F.least((index + 1) * wide, (j + 1) * long) - F.greatest(index * wide, j * long)
    return F.transform(F.sequence(first.cast("long"), last.cast("long")), lambda j: F.struct(j.cast("int").alias("out"), weight(j).cast("long").alias("weight")))


def downsample_mean(pixels: DataFrame, k: int, height: int, width: int, keys: tuple[str, ...] = ("path",), transform: tuple[float, ...] | None = None) -> DataFrame:
    """keys, out_row, out_col, value: averages by area on a grid of height // k x width // k.

    transform: of the source; with it, also latitude and longitude of the coarse pixels' centres.

    The coarse grid covers the source exactly. Where k doesn't divide a side, a source pixel lies
    in up to four coarse ones and counts in each by its share of area. Missing pixels don't count;
    a block without any other is missing. Tasks sum their own pixels before the shuffle.
    """
    rows, cols = height // k, width // k
    if not 0 < rows <= height or not 0 < cols <= width:
        raise ValueError("k has to be from 1 to the shorter side")
    split = pixels.select(*keys, "value", "pix_col", F.inline(overlaps(F.col("pix_row"), height, rows)).alias("out_row", "_w_row"))
    split = split.select(*keys, "value", "out_row", "_w_row", F.inline(overlaps(F.col("pix_col"), width, cols)).alias("out_col", "_w_col"))
    weight = F.when(F.col("value").isNotNull(), F.col("_w_row") * F.col("_w_col"))
    out = split.groupBy(*keys, "out_row", "out_col").agg((F.sum(F.col("value") * weight) / F.sum(weight)).alias("value"))
    if transform is None:
        return out
    latitude, longitude = pixel_centre(transform, F.col("out_row"), F.col("out_col"), (height / rows, width / cols))
    return out.withColumns({"latitude": latitude, "longitude": longitude})


def regrid_nearest(src: DataFrame, rows: DataFrame, cols: DataFrame, scale: tuple[float, float], keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """Values at target rows and columns (out_row, out_col), from the nearest source pixel.

    scale: source pixels for one target pixel. The source index is worked out on the small
    target axes and joined by equality; a range condition would compare every pair.
    """
    at = lambda out, k: F.floor((F.col(out) + 0.5) * F.lit(k)).cast("int")
    rows = small(rows.withColumn("pix_row", at("out_row", scale[0])))
    cols = small(cols.withColumn("pix_col", at("out_col", scale[1])))
    return src.join(rows, "pix_row").join(cols, "pix_col").select(*keys, "out_row", "out_col", "value")


def regrid_to_axes(src: DataFrame, latitudes: DataFrame, longitudes: DataFrame, transform: tuple[float, ...], keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """keys, latitude, longitude, value on target axes, from the pixel whose centre is nearest.

    src: pixel rows and columns of a regular grid with this transform; latitudes, longitudes: the
    targets' labels. Targets beyond the source's pixels have no row. Of a target midway between
    two pixels the one with the higher index counts.
    """
    a, _, c, _, e, f = map(float, transform)
    rows = small(latitudes.select("latitude", axis_position(F.col("latitude"), f + e / 2, e).alias("pix_row")))
    cols = small(longitudes.select("longitude", axis_position(F.col("longitude"), c + a / 2, a).alias("pix_col")))
    return src.join(rows, "pix_row").join(cols, "pix_col").select(*keys, "latitude", "longitude", "value")
