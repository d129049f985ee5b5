"""Stations and grid cells: neighbours, extraction, near-duplicates, mosaics and terrain."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainspark.functions import kernels
from rainspark.functions import scalars as S
from rainspark.operators.util import by_block, matrices, spread

#: Station networks, best first, for the choice among near-duplicates (fixed values).
STATION_NETWORKS = [
    "Mesonet", "HaleNet", "CraterNet", "Little,HaleNet", "HavoNet", "HIPPNET", "USCRN", "ESRL/GMD", "NWS", "USGS", "HydroNet-UaNet",
    "SCAN", "NREL", "RAWS", "STATE", "NREM", "PrivateObs", "HC&S", "COOP", "CoCoRaHS", "CoCoRaHs",
]


def pair_distances(stations: DataFrame) -> DataFrame:
    """skn, skn_obs, dist (metres) of all station pairs of a county, each way (C11). Distances don't depend on dates.

    The stations of a county are cut into parts and each part meets all stations of the county in a key of its own, so pairs are
    dealt over all tasks instead of one for a county.
    """
    parts = int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = stations.withColumn("_part", F.pmod(F.xxhash64("skn"), F.lit(parts)).cast("int"))
    other = stations.select("county", *(F.col(c).alias(f"{c}_obs") for c in ("skn", "lon", "lat")))
    other = other.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    dist = S.haversine(F.col("lon"), F.col("lat"), F.col("lon_obs"), F.col("lat_obs"))
    met = spread(own, "county", "_part").hint("shuffle_hash").join(spread(other, "county", "_part"), ["county", "_part"])
    return met.filter("skn <> skn_obs").select("county", "skn", "skn_obs", dist.alias("dist"))


def _days_near(table: pa.Table, time: str, k: int, digits: int) -> Iterator[tuple[pa.Table, np.ndarray, pa.Array, pa.Array]]:
    """Each time of a table in ascending order of skn, with where each station's neighbours begin (and the end), their rows in
    it and their distances. In a large network all times share lists of neighbours, of which a time takes those that report."""
    for at, row, col, xy in matrices(table, time, None):
        lon, lat, n = *np.ascontiguousarray(xy.T), col.max() + 1
        lists = kernels.lists_of(lon, lat, len(at) / (len(xy) * n), k, digits) if len(xy) >= kernels.MANY else None
        by_time = np.lexsort((row, col))
        ends = np.searchsorted(col[by_time], np.arange(n + 1))
        number = np.zeros(len(xy), np.int64)
        for low, high in itertools.pairwise(ends.tolist()):
            here = by_time[low:high]
            number[row[here]] = np.arange(len(here))
            starts, place, dist = kernels.nearest_present(lists, row[here], lon, lat, k, digits)
            yield table.take(pa.array(at[here])).combine_chunks(), starts, pa.array(number[place]), pa.array(dist)


def _near_columns(days: DataFrame, group: tuple[str, ...]) -> tuple[list[str], DataFrame, dict[str, str]]:
    more = [c for c in days.columns if c not in (*group, "skn", "lon", "lat")]
    rows = days.select(*group, "skn", "lon", "lat", *more)
    return more, rows, dict(rows.dtypes)


def nearest_lists(days: DataFrame, k: int = 10, group: tuple[str, ...] = ("county", "date"), digits: int = 3) -> DataFrame:
    """Each station-day with `near`: its k nearest stations that report in the same group, nearest first.

    days: group, skn, lon, lat and further columns, which stand in every neighbour with the suffix _obs beside skn_obs
    and dist (metres, to `digits` places; ties go to the lesser skn). A group is one county and day: it grows with the
    network, not with the years. One shuffle of the station-days, by county and block of days; pairs never leave the task.
    """
    more, rows, kinds = _near_columns(days, group)
    item = ", ".join(["skn_obs: " + kinds["skn"], "dist: double", *(f"{c}_obs: {kinds[c]}" for c in more)])
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*group, "skn", *more)) + f", near array<struct<{item}>>"

    def run(table: pa.Table) -> pa.Table:
        out = []
        for day, starts, flat, dist in _days_near(table, group[-1], k, digits):
            parts = [day["skn"].take(flat), dist, *(day[c].take(flat) for c in more)]
            parts = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in parts]
            near = pa.StructArray.from_arrays(parts, ["skn_obs", "dist", *(f"{c}_obs" for c in more)])
            out.append(day.select([*group, "skn", *more]).append_column("near", pa.ListArray.from_arrays(pa.array(starts, pa.int32()), near)))
        return pa.concat_tables(out)

    rows, keys = by_block(rows, group, 1)
    return rows.groupBy(*keys).applyInArrow(run, schema)


def nearest_reporting(days: DataFrame, k: int = 10, group: tuple[str, ...] = ("county", "date"), digits: int = 3) -> DataFrame:
    """A row for each neighbour, with its place from 1 (E8, C12); see nearest_lists."""
    more, rows, kinds = _near_columns(days, group)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*group, "skn")) + f", place int, skn_obs {kinds['skn']}, dist double"
    schema += "".join(f", {c}_obs {kinds[c]}" for c in more)

    def run(table: pa.Table) -> pa.Table:
        out = []
        for day, starts, flat, dist in _days_near(table, group[-1], k, digits):
            size = np.diff(starts)
            own = day.select([*group, "skn"]).take(pa.array(np.repeat(np.arange(len(size)), size)))
            place = (np.arange(len(flat)) - np.repeat(starts[:-1], size) + 1).astype(np.int32)
            for name, x in (("place", pa.array(place)), ("skn_obs", day["skn"].take(flat)), ("dist", dist), *((f"{c}_obs", day[c].take(flat)) for c in more)):
                own = own.append_column(name, x)
            out.append(own)
        return pa.concat_tables(out)

    rows, keys = by_block(rows, group, 1)
    return rows.groupBy(*keys).applyInArrow(run, schema)


def spread_ranks(lists: DataFrame, values: list[str], k: int = 10) -> DataFrame:
    """Neighbour columns side by side, value_1 .. value_k, instead of the list (K10). No shuffle."""
    cells = [F.get("near", F.lit(i))[v].alias(f"{v}_{i + 1}") for v in values for i in range(k)]
    return lists.select(*(c for c in lists.columns if c != "near"), *cells)


def source_rank(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds rank in county and date: real values before filled ones, then by network, then by station."""
    w = Window.partitionBy("county", "date").orderBy("is_fill", S.rank_in("network", order), "skn")
    return df.withColumn("rank", F.row_number().over(w))


def drop_near(ranked: DataFrame, degrees: float = 0.00225) -> DataFrame:
    """Stations without an earlier-ranked one within `degrees` (C13). A dropped station still drops others.

    Stations meet only in the same or a neighbouring cell of a grid as wide as the limit.
    """
    cell = [F.floor(F.col(c) / degrees).alias(f"c{c}") for c in ("lon", "lat")]
    rows = ranked.select("*", *cell)
    other = ranked.select("county", "date", *(F.col(c).alias(f"{c}_b") for c in ("rank", "lon", "lat")))
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    other = other.select("*", F.inline(around))
    other = other.select(
        "county", "date", "rank_b", "lon_b", "lat_b",
        (F.floor(F.col("lon_b") / degrees) + F.col("i")).alias("clon"),
        (F.floor(F.col("lat_b") / degrees) + F.col("j")).alias("clat"),
    )
    near = S.planar(F.col("lon"), F.col("lat"), F.col("lon_b"), F.col("lat_b")) <= degrees
    keys = [rows[c] == other[c] for c in ("county", "date", "clon", "clat")]
    return rows.join(other, [*keys, (F.col("rank_b") < F.col("rank")) & near], "left_anti").drop("clon", "clat")


def cell_of(df: DataFrame, west: float, north: float, step: float) -> DataFrame:
    """Adds row and col of the grid cell that holds (lon, lat)."""
    return df.withColumn("row", F.floor((north - F.col("lat")) / step)).withColumn("col", F.floor((F.col("lon") - west) / step))


def extract(points: DataFrame, grid: DataFrame, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Points with the value of their cell; points off the grid or on empty cells go (C14)."""
    return points.join(grid.filter("value is not null"), list(keys))


def mosaic(cells: DataFrame, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """The largest value where grids overlap."""
    return cells.groupBy(*keys).agg(F.max("value").alias("value"))


def terrain(grid: DataFrame, dx: float, dy: float, keys: tuple[str, ...] = ("tile",), carry: tuple[str, ...] = (), block: int = 64) -> DataFrame:
    """keys, row, col, value, `carry`, slope (degrees, Horn), roughness, tri and curvature (slope of the slope) of every cell
    that has a value and eight neighbours with one; curvature is null where a neighbour has no slope (E16).

    A grid goes in blocks of block x block cells, each with a border of two cells from the blocks around it, so a cell is
    shuffled once, and a second time only if it is that near to another block. Further columns of cells (`carry`) travel
    along. Where a cell is given twice the larger value counts.
    """
    rim = 2
    around = [
        F.struct(F.floor((F.col("row") + i) / block).cast("long").alias("_br"), F.floor((F.col("col") + j) / block).cast("long").alias("_bc"))
        for i in (0, -rim, rim)
        for j in (0, -rim, rim)
    ]
    rows = grid.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"), *carry)
    sent = rows.filter("value is not null").select("*", F.inline(F.array_distinct(F.array(*around))))
    kinds = dict(rows.dtypes)
    names = ("slope", "roughness", "tri", "curvature")
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*keys, "row", "col", "value", *carry)) + "".join(f", {c} double" for c in names)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("value", "ascending")])
        top, left = (block * table[c][0].as_py() - rim for c in ("_br", "_bc"))
        at = table["row"].to_numpy() - top, table["col"].to_numpy() - left
        v = np.full((block + 2 * rim, block + 2 * rim), np.nan)
        place = np.full(v.shape, -1)
        v[at] = table["value"].to_numpy()  # of equal places the last, which is the largest value
        place[at] = np.arange(table.num_rows)
        found = kernels.shapes(v, dx, dy)
        inside = np.nonzero(~np.isnan(found[0]))
        out = table.select([*keys, "row", "col", "value", *carry]).take(pa.array(place[rim:-rim, rim:-rim][inside]))
        for name, x in zip(names, found, strict=True):
            out = out.append_column(name, pa.array(x[inside], mask=np.isnan(x[inside])))
        return out

    by = [*keys, "_br", "_bc"]
    return spread(sent, *by).groupBy(*by).applyInArrow(run, schema)


def nearest_distance(
    grid: DataFrame, points: DataFrame, keys: tuple[str, ...] = ("county",), cell: tuple[str, ...] = ("row", "col"), carry: tuple[str, ...] = ()
) -> DataFrame:
    """keys, cell, `carry` and dist, the metres from every cell to the nearest point of its group.

    The points of a group are the stations of a network, a bounded list, and travel as one array to blocks of cells. A block has
    cells of near places, and these are looked up among the points by cubes, each place once; cells x points rows never exist.
    """
    rows = grid.select(*keys, *cell, *carry, F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*keys, *cell, *carry)) + ", dist double"
    blocks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, "_block"]
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_lon", "_lat"), F.lit(blocks)).cast("int"))
    sent = points.select(*keys, F.col("lon").alias("_x"), F.col("lat").alias("_y")).distinct()
    sent = sent.join(rows.select(*keys, (F.col("_block") + 0).alias("_block")).distinct(), list(keys))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at = np.stack([left[c].to_numpy() for c in ("_lon", "_lat")], 1)
        lon, lat = (right[c].to_numpy() for c in ("_x", "_y"))
        if not len(at) or not len(lon):
            return left.slice(0, 0).select([*keys, *cell, *carry]).append_column("dist", pa.array([], pa.float64()))
        places, number = np.unique(at, axis=0, return_inverse=True)
        dist = kernels.nearest_metres(places[:, 0], places[:, 1], lon, lat)
        return left.select([*keys, *cell, *carry]).append_column("dist", pa.array(dist[number.ravel()]))

    return spread(rows, *by).groupBy(*by).cogroup(spread(sent, *by).groupBy(*by)).applyInArrow(run, schema)
