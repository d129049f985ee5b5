"""Maps from stations: inverse distances, variograms, ordinary kriging and leave-one-out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainspark.functions import kernels
from rainspark.functions import scalars as S
from rainspark.operators import metrics
from rainspark.operators.util import by_block, matrices, spread
from rainspark.sources.tables import written

#: Constants added to the climate mean in the candidate sweep; -1 stands for no climate aid (fixed values).
ADDED = (-1, 0, 1, 10, 100, 1000, 10000)


def flag_real(every: DataFrame, raw: DataFrame) -> DataFrame:
    """Adds is_fill: whether a station-day is not in the raw table."""
    real = raw.select("skn", "date").distinct().withColumn("_real", F.lit(True))
    return every.join(real, ["skn", "date"], "left").withColumn("is_fill", F.col("_real").isNull()).drop("_real")


CELL = ("row", "col")
#: Largest grid that is broadcast.
BROADCAST_CELLS = 1_000_000
#: Tiles of a larger grid that one task holds beside a block of times.
SPAN_TILES = 64


def _meet(cells: DataFrame, rows: DataFrame, group: list[str], time: list[str], cell: tuple[str, ...], carry: tuple[str, ...], block_cells: int) -> DataFrame:
    """rows (one for each group and time) with `cells`, an array of about block_cells cells of the group: a row for each tile.

    The cells of each group are counted first. A grid of at most BROADCAST_CELLS cells (some 40 MB) goes to all tasks, so
    that times stay spread. Of a larger one tiles are dealt by span and block of times: every span of tiles goes to all
    blocks of times and every row to all spans of its group, so a task has a bounded part of both and no key is a group alone.
    """
    spark = cells.sparkSession
    counted = [(*(r[c] for c in group), r["count"]) for r in cells.groupBy(*group).count().collect()]  # a row for each group
    total = sum(r[-1] for r in counted)
    kinds = dict(cells.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in group) + ", _blocks long, _spans long"
    sized = [(*r[:-1], -(-r[-1] // block_cells), -(-r[-1] // (block_cells * SPAN_TILES))) for r in counted]
    sizes = F.broadcast(spark.createDataFrame(sized, schema))
    blocked = cells.join(sizes, group).withColumn("_block", F.pmod(F.xxhash64(*cell), F.col("_blocks")))
    at = F.struct(*cell, "lon", "lat", *(F.col(c).cast("double").alias(c) for c in carry))
    tiles = blocked.groupBy(*group, "_block").agg(F.collect_list(at).alias("cells"))
    if total <= BROADCAST_CELLS:
        return F.broadcast(tiles.drop("_block")).join(rows, group)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = max(1, -(-wanted // max(sum(r[-1] for r in sized), 1)))
    tiles = tiles.join(sizes, group).withColumn("_span", F.pmod(F.col("_block"), F.col("_spans"))).drop("_block", "_blocks", "_spans")
    tiles = tiles.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(days - 1).cast("long"))).alias("_days"))
    rows = rows.join(sizes, group).withColumn("_days", F.pmod(F.xxhash64(*time), F.lit(days)))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_spans") - 1)).alias("_span")).drop("_blocks", "_spans")
    return tiles.join(rows, [*group, "_span", "_days"]).drop("_span", "_days")


#: Cells of a place on average from which on maps are worked out by place.
COPIES = 4


def _by_place(cells: DataFrame, group: list[str], time: list[str], cell: tuple[str, ...], carry: tuple[str, ...], make: Callable) -> DataFrame | None:
    """The maps of `make` (cells, columns of a cell -> group, time, cell and values) worked out once for each place, where many
    cells lie at one (layers of a grid); each cell then takes its place's values. None where cells have places of their own."""
    counted = cells.groupBy(*group).agg(F.count("*").alias("n"), F.count_distinct("lon", "lat").alias("places"))
    n, places = counted.agg(F.sum("n"), F.sum("places")).first()
    if not n or n < COPIES * places:
        return None
    places = cells.select(*group, "lon", "lat").distinct().withColumn("_place", F.monotonically_increasing_id())
    places = written(places, "places")
    maps = make(places, ("_place",))
    values = [c for c in maps.columns if c not in (*group, *time, "_place")]
    listed = maps.groupBy(*group, "_place").agg(F.collect_list(F.struct(*time, *values)).alias("_maps"))
    on = cells.select(*group, *(F.col(c).cast("long").alias(c) for c in cell), *(F.col(c).cast("double").alias(c) for c in carry), "lon", "lat")
    on = on.join(places, [*group, "lon", "lat"]).drop("lon", "lat").join(listed, [*group, "_place"])
    return on.select(*group, *cell, *carry, F.inline("_maps")).select(*group, *time, *cell, *carry, *values)


def _fields(column: pa.ChunkedArray, i: int) -> dict[str, np.ndarray]:
    """The fields of the structs in row i of a list column."""
    items = column[i].values
    return {f.name: items.field(f.name).to_numpy(zero_copy_only=False) for f in items.type}


def idw(
    cells: DataFrame,
    stations: DataFrame,
    group: list[str],
    time: list[str],
    power: float = 2.0,
    cell: tuple[str, ...] = CELL,
    block_cells: int = 2048,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Inverse-distance map of stations (group, time, lon, lat, rf) on the cells (group, cell, lon, lat).

    Cells meet the stations of their own group only: the stations of each (group, time) travel as one array to the tiles
    of the group, and a tile is one matrix product. Stations x cells rows never exist. `cell` names the columns (integers)
    that tell cells apart, `carry` further columns (numbers) of cells that the map shall have.
    """
    by_place = _by_place(cells, group, time, cell, carry, lambda places, at: idw(places, stations, group, time, power, at, block_cells))
    if by_place is not None:
        return by_place
    listed = spread(stations.filter("rf is not null"), *group, *time).groupBy(*group, *time)
    listed = listed.agg(F.collect_list(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"), F.col("rf").cast("double").alias("z"))).alias("points"))
    kinds = dict(listed.dtypes)
    keys = [*group, *time]
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + "".join(f", {c} long" for c in cell) + "".join(f", {c} double" for c in carry) + ", value double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, p = _fields(batch["cells"], i), _fields(batch["points"], i)
                d = kernels.distances(np.stack([at["lon"], at["lat"]], 1), np.stack([p["x"], p["y"]], 1))
                same = [pa.array([batch[c][i].as_py()] * len(d), batch[c].type) for c in keys]
                value = kernels.inverse_distance(d, p["z"], power)
                own = [*(pa.array(at[c].astype(np.int64)) for c in cell), *(pa.array(at[c], from_pandas=True) for c in carry)]
                yield pa.RecordBatch.from_arrays([*same, *own, pa.array(value)], [*keys, *cell, *carry, "value"])

    return _meet(cells, listed, group, time, cell, carry, block_cells).select(*keys, "cells", "points").mapInArrow(predict, schema)


def idw_loo(stations: DataFrame, group: list[str], power: float = 2.0) -> DataFrame:
    """Every real station predicted from all others of its group (K7). stations: group, skn, lon, lat, rf, is_fill; the last column
    of the group is the time.

    A group is the stations of one county and time. A task has a block of times, whose distances go by in tiles, each worked
    out once for all of them; a matrix of all pairs never exists.
    """
    rows = stations.select(*group, "skn", "lon", "lat", F.col("rf").cast("double").alias("rf"), "is_fill")
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*group, "skn")) + ", obs double, pred double"
    rows, keys = by_block(rows, group)

    def run(table: pa.Table) -> pa.Table:
        rf, real = table["rf"].to_numpy(), ~table["is_fill"].to_numpy().astype(bool)
        parts = []
        for at, row, col, xy in matrices(table, group[-1]):
            z = np.full((len(xy), col.max() + 1), np.nan)
            z[row, col] = rf[at]
            pred = kernels.left_out_means(xy, z, power)[row, col]
            keep = real[at] & (np.bincount(col)[col] > 1)
            out = table.select([*group, "skn"]).take(pa.array(at[keep])).append_column("obs", pa.array(rf[at[keep]]))
            parts.append(out.append_column("pred", pa.array(pred[keep], pa.float64(), mask=np.isnan(pred[keep]))))
        return pa.concat_tables(parts)

    return rows.groupBy(*keys).applyInArrow(run, schema)


def methods(stations: DataFrame, group: list[str], least: int = 3, least_variance: float = 1e-10) -> DataFrame:
    """Which way each group is mapped: no_rain, too_few, flat or krige (K8, B16). A row of status, never an abort."""
    real = F.when(~F.col("is_fill"), F.col("rf"))
    got = stations.groupBy(*group).agg(
        F.count("*").alias("n"), F.max(real).alias("top_real"), F.max("rf").alias("top"), F.var_samp("rf").alias("variance")
    )
    status = (
        F.when((F.coalesce("top_real", F.lit(0.0)) == 0) | (F.col("top") == 0), "no_rain")
        .when(F.col("n") < least, "too_few")
        .when(F.coalesce("variance", F.lit(0.0)) < least_variance, "flat")
        .otherwise("krige")
    )
    return got.select(*group, "n", "top_real", status.alias("status"))


def no_rain(cells: DataFrame, groups: DataFrame, group: list[str], cell: tuple[str, ...] = CELL) -> DataFrame:
    """Zero grids, with -9999 for the standard error, of groups without rain (K8)."""
    return cells.join(groups.filter("status = 'no_rain'"), group).select(
        *[c for c in groups.columns if c not in ("n", "top_real", "status")], *cell, F.lit(0.0).alias("value"), F.lit(-9999.0).alias("se")
    )


def transform(stations: DataFrame, added: int | Column) -> DataFrame:
    """Adds the kriging target y and base of back-transformation m for a candidate (H9, K5).

    -1: y = log(rf + 1). Else m = mean + added and y = log((rf + m) / m). A mean of 0 counts as 0.001.
    """
    added = added if isinstance(added, Column) else F.lit(added)
    m = F.when(added < 0, 1.0).otherwise(S.guarded_mean(F.col("mean_mm")) + added)
    y = F.when(added < 0, S.log_plain(F.col("rf"))).otherwise(S.log_ratio(F.col("rf"), F.col("m")))
    return stations.withColumn("added", added).withColumn("m", m).withColumn("y", y)


def variogram(points: DataFrame, group: list[str], width: float, bins: int) -> DataFrame:
    """Experimental variogram: by distance bin the pairs, mean distance and semivariance (K1). points: group, skn, lon, lat, y; the
    last column of the group is the time.

    A group is the stations of one county and time. A task has a block of times, whose pairs go by in tiles, each worked out
    once for all of them.
    """
    rows = points.select(*group, "skn", "lon", "lat", F.col("y").cast("double").alias("y"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in group) + ", bin long, n_pairs long, h double, gamma double"
    rows, keys = by_block(rows, group)

    def run(table: pa.Table) -> pa.Table:
        value, parts = table["y"].to_numpy(), []
        for at, row, col, xy in matrices(table, group[-1]):
            y = np.full((len(xy), col.max() + 1), np.nan)
            y[row, col] = value[at]
            pairs, far, gamma = kernels.semivariances_over_times(xy, y, width, bins)
            first = np.full(y.shape[1], -1)
            first[col] = at
            time, bin_ = np.nonzero(pairs)
            n = pairs[time, bin_]
            out = table.select(group).take(pa.array(first[time]))
            for name, x in (("bin", bin_), ("n_pairs", n.astype(np.int64)), ("h", far[time, bin_] / n), ("gamma", gamma[time, bin_] / n)):
                out = out.append_column(name, pa.array(x))
            parts.append(out)
        return pa.concat_tables(parts)

    return rows.groupBy(*keys).applyInArrow(run, schema)


def lookup_params(groups: DataFrame, params: DataFrame, keys: tuple[str, ...] = ("county", "month", "added")) -> DataFrame:
    """nugget, range and sill of each group by county, month of the year and added constant (C15); null where none is listed.

    params is a small table (counties x months x constants), which Spark broadcasts by its measured size.
    """
    return groups.join(params.select(*keys, "nugget", "range", "sill"), list(keys), "left")


def fit(bins: DataFrame, group: list[str], model: str = "exp", fixed: DataFrame | None = None) -> DataFrame:
    """Weighted least-squares variogram parameters of each group (K2). A group is a few bins, one row each.

    fixed: group and any of nugget, range, sill; a value that isn't null is kept and only the others are fitted, so a
    group with all three is not fitted at all.
    """
    kept = [c for c in ("nugget", "range", "sill") if fixed is not None and c in fixed.columns]
    if fixed is not None:
        bins = bins.join(fixed.select(*group, *(F.col(c).cast("double").alias(f"_{c}") for c in kept)), group)
    schema = ", ".join(f"{c} {dict(bins.dtypes)[c]}" for c in group) + ", nugget double, range double, sill double, sse double"

    def run(table: pa.Table) -> pa.Table:
        given = {{"nugget": "nugget", "range": "range_", "sill": "sill"}[c]: table[f"_{c}"][0].as_py() for c in kept}
        p = kernels.fit_variogram(*(table[c].to_numpy() for c in ("h", "gamma", "n_pairs")), model, **given)
        keys = [pa.array([table[c][0].as_py()], table[c].type) for c in group]
        return pa.Table.from_arrays([*keys, *(pa.array([x]) for x in p)], [*group, "nugget", "range", "sill", "sse"])

    return spread(bins, *group).groupBy(*group).applyInArrow(run, schema)


#: Numbers in the matrices of systems that are solved together, some 32 MB.
STACK = 1 << 22


def _stacks(batch: pa.RecordBatch, column: str, systems: int) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray | pa.Array]]]:
    """Rows of a batch whose lists of stations are equally long, in parts that STACK allows: the rows, and the fields of their
    stations as rows x stations, in ascending order of skn; skn itself comes as places in the flat array `_at`."""
    lists = batch.column(column)
    ends = lists.offsets.to_numpy()
    flat = lists.values
    number = flat.field("skn").to_numpy(zero_copy_only=False)
    values = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type if f.name != "skn"}
    sizes = np.diff(ends)
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        step = max(1, STACK // max(systems * (n + 1) ** 2, 1))
        for low in range(0, len(rows), step):
            part = rows[low : low + step]
            at = ends[part][:, None] + np.arange(n)
            at = np.take_along_axis(at, np.argsort(number[at], axis=1, kind="stable"), 1)
            yield part, {"_at": at} | {k: v[at] for k, v in values.items()}


def _apart(f: dict[str, np.ndarray]) -> np.ndarray:
    xy = np.stack([f["lon"], f["lat"]], -1)
    return np.sqrt(((xy[:, :, None] - xy[:, None, :]) ** 2).sum(-1))


def _listed(rows: DataFrame, group: list[str], *more: str) -> DataFrame:
    """A row for each group with its stations as an array; a group is one county and time."""
    kept = [c for c in rows.columns if c not in group and c not in more]
    return spread(rows, *group).groupBy(*group).agg(F.collect_list(F.struct(*kept)).alias("stations"), *(F.first(c).alias(c) for c in more))


def sweep(
    points: DataFrame, params: DataFrame, group: tuple[str, ...] = ("county", "date"), width: float = 0.5, bins: int = 6, model: str = "exp"
) -> DataFrame:
    """Leave-one-out predictions of the 14 candidates of every group: seven constants, each with the listed (fixed) and a
    fitted (free) variogram (K5, B16). Returns group, run, added, is_free, nugget, range, sill, skn, obs, pred.

    points: group, skn, lon, lat, rf, mean_mm, is_fill; all stations with rf predict, real ones are predicted. params: county,
    month, added, nugget, range, sill. A candidate whose target doesn't vary, whose parameters aren't listed or which
    has fewer than 3 stations is left out. Groups of equal size are worked out together, their fits as one search and
    their systems as one stack of inverses.
    """
    keys = list(group)
    listed = params.groupBy("county", "month").agg(F.collect_list(F.struct("added", "nugget", "range", "sill")).alias("listed"))
    rows = points.filter("rf is not null").select(*keys, "skn", "lon", "lat", F.col("rf").cast("double").alias("rf"), F.col("mean_mm").cast("double").alias("mean_mm"), F.col("is_fill").cast("int").alias("is_fill"))
    kinds = dict(rows.dtypes)
    rows = _listed(rows, keys).withColumn("month", F.month("date")).join(listed, ["county", "month"], "left").select(*keys, "stations", "listed")
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + ", run int, added int, is_free boolean, nugget double, range double, sill double"
    schema += f", skn {kinds['skn']}, obs double, pred double"
    names = [*keys, "run", "added", "is_free", "nugget", "range", "sill", "skn", "obs", "pred"]
    adds = np.array(ADDED, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = [{p["added"]: (p["nugget"], p["range"], p["sill"]) for p in x or []} for x in batch.column("listed").to_pylist()]
            skn = batch.column("stations").values.field("skn")
            for part, f in _stacks(batch, "stations", 2 * len(ADDED)):
                if f["rf"].shape[1] < 3:
                    continue
                d = _apart(f)
                base = np.where(adds[None, :, None] < 0, 1.0, np.where(f["mean_mm"] == 0, 0.001, f["mean_mm"])[:, None] + adds[None, :, None])
                y = np.log((f["rf"][:, None] + base) / base)
                n, h, gamma = kernels.stacked_semivariances(d, y, width, bins)
                shape = gamma.shape
                again = [np.broadcast_to(x[:, None], shape).reshape(-1, bins) for x in (h, n)]
                free = kernels.stacked_fits(again[0], gamma.reshape(-1, bins), again[1], model).reshape(shape[0], shape[1], 3)
                given = np.array([[fixed[r].get(a, (np.nan,) * 3) for a in ADDED] for r in part.tolist()], float)
                p = np.stack([given, free], 1)  # rows x (fixed, free) x constants x 3
                p[..., 2] = np.maximum(p[..., 2], 1e-4)
                varies = y.var(2, ddof=1) >= 1e-10
                row, kind, place = np.nonzero(varies[:, None] & np.isfinite(p).all(3))
                if not len(row):
                    continue
                chosen = p[row, kind, place]
                pred = kernels.stacked_leave_one_out(d[row], y[row, place], chosen, model)
                mm = np.maximum((np.exp(np.minimum(pred, 700.0)) - 1) * base[row, np.where(adds[place] < 0, 0, place)], 0.0)
                real = f["is_fill"][row] == 0
                size = real.sum(1)
                keys_at = pa.array(np.repeat(part[row], size))
                columns = [np.repeat(x, size) for x in (place + kind * len(ADDED), adds[place], kind, *chosen.T)]
                types = [pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(keys_at) for c in keys),
                        *(pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(columns, types, strict=True)),
                        skn.take(pa.array(f["_at"][row][real])),
                        pa.array(f["rf"][row][real]),
                        pa.array(mm[real]),
                    ],
                    names,
                )

    return rows.mapInArrow(run, schema)


def krige_loo(points: DataFrame, group: list[str], model: str = "exp") -> DataFrame:
    """Leave-one-out prediction of y at every station of a group, from one matrix inverse (K4; Dubrule, 1983); null alone.

    points: group, skn, lon, lat, y, nugget, range, sill. A group is the stations of one county and date; groups of equal size
    are solved as one stack.
    """
    rows = points.select(*group, "skn", "lon", "lat", F.col("y").cast("double").alias("y"), *(F.col(c).cast("double").alias(c) for c in ("nugget", "range", "sill")))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in group) + f", skn {kinds['skn']}, y double, y_pred double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            params = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("nugget", "range", "sill")], 1)
            skn = batch.column("stations").values.field("skn")
            for part, f in _stacks(batch, "stations", 1):
                n = f["y"].shape[1]
                pred = kernels.stacked_leave_one_out(_apart(f), f["y"], params[part], model) if n > 1 else np.full(f["y"].shape, np.nan)
                keys_at = pa.array(np.repeat(part, n))
                out = [*(batch.column(c).take(keys_at) for c in group), skn.take(pa.array(f["_at"].ravel())), pa.array(f["y"].ravel())]
                yield pa.RecordBatch.from_arrays([*out, pa.array(pred.ravel(), from_pandas=True)], [*group, "skn", "y", "y_pred"])

    return _listed(rows, list(group), "nugget", "range", "sill").mapInArrow(run, schema)


def krige(
    points: DataFrame,
    cells: DataFrame,
    group: list[str],
    time: list[str],
    model: str = "exp",
    cell: tuple[str, ...] = CELL,
    block_cells: int = 2048,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Ordinary kriging of y to the cells of a group: pred and var, beside the cells' own `carry` columns (K3).

    The system of each (group, time) is solved once into dual weights, which meet tiles of cells (see _meet); a tile's
    predictions are one matrix product. Stations x cells rows never exist.
    """
    by_place = _by_place(cells, group, time, cell, carry, lambda places, at: krige(points, places, group, time, model, at, block_cells))
    if by_place is not None:
        return by_place
    rows = points.select(*group, *time, "skn", "lon", "lat", "y", "nugget", "range", "sill")
    kinds = dict(rows.dtypes)
    keys = [*group, *time]
    arrays = ["xs", "ys", "weights", "inverse", "params"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + "".join(f", {c} array<double>" for c in arrays)

    def solve(table: pa.Table) -> pa.Table:
        params = [float(table[c][0].as_py()) for c in ("nugget", "range", "sill")]
        xy = np.stack([table["lon"].to_numpy(), table["lat"].to_numpy()], 1)
        weights, inverse = kernels.solve_kriging(xy, table["y"].to_numpy(), kernels.covariance(model, *params))
        row = [pa.array([x], pa.list_(pa.float64())) for x in (xy[:, 0], xy[:, 1], weights, inverse.ravel(), np.array(params))]
        return pa.Table.from_arrays([*(pa.array([table[c][0].as_py()], table[c].type) for c in keys), *row], [*keys, *arrays])

    solved = spread(rows, *keys).groupBy(*keys).applyInArrow(solve, schema)
    out_schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + "".join(f", {c} long" for c in cell) + "".join(f", {c} double" for c in carry) + ", pred double, var double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = _fields(batch["cells"], i)
                xs, ys, weights, inverse, params = (batch[c][i].values.to_numpy() for c in arrays)
                n = len(xs)
                pred, var = kernels.predict(
                    np.stack([xs, ys], 1), weights, inverse.reshape(n + 1, n + 1), np.stack([at["lon"], at["lat"]], 1), kernels.covariance(model, *params)
                )
                same = [pa.array([batch[c][i].as_py()] * len(pred), batch[c].type) for c in keys]
                own = [*(pa.array(at[c].astype(np.int64)) for c in cell), *(pa.array(at[c], from_pandas=True) for c in carry)]
                yield pa.RecordBatch.from_arrays([*same, *own, pa.array(pred), pa.array(var)], [*keys, *cell, *carry, "pred", "var"])

    return _meet(cells, solved, group, time, cell, carry, block_cells).select(*keys, "cells", *arrays).mapInArrow(predict, out_schema)


def daily_map(
    points: DataFrame, cells: DataFrame, params: DataFrame, cell: tuple[str, ...] = CELL, width: float = 0.5, bins: int = 6
) -> tuple[DataFrame, DataFrame]:
    """(validation, grid) of every county-day: no-rain, kriging by the best of 14 candidates, or inverse distances (K9).

    points: county, date, skn, lon, lat, rf, mean_mm, is_fill (C10). cells: county, cell, lon, lat, mean_mm (the mean of the
    cell). params: as for sweep. A group of too few stations gets a status row and no map; one that no candidate survives
    is mapped by inverse distances, with -9999 for the standard errors.

    validation: county, date, status, n, method, the chosen candidate and its scores. grid: county, date, cell, method,
    value (mm), anomaly, and se_backtransformed_var and se_anomaly, the back-transformed kriging variance.
    """
    keys = ["county", "date"]
    points = written(points, "points")
    ways = written(methods(points, keys), "ways")
    wet = points.join(ways.filter("status in ('krige', 'flat')").select(*keys), keys, "left_semi")
    swept = sweep(wet, params, ("county", "date"), width, bins)
    run_keys = [*keys, "run", "added", "is_free", "nugget", "range", "sill"]
    scored = metrics.scores(swept, run_keys).filter("mae is not null")
    best = written(metrics.best_run(scored, keys), "best")
    rest = ways.filter("status in ('krige', 'flat')").join(best.select(*keys), keys, "left_anti").select(*keys)
    idw_points = points.join(rest, keys, "left_semi")
    idw_scores = metrics.scores(idw_loo(idw_points, keys), keys)
    columns = ["n", "r2", "rmse", "mae", "bias", "nse", "kge"]
    chosen = best.select(*keys, F.lit("krige").alias("method"), "added", "is_free", "nugget", "range", "sill", *columns[1:])
    chosen = chosen.unionByName(idw_scores.select(*keys, F.lit("idw").alias("method"), *columns[1:]), allowMissingColumns=True)
    dry = ways.filter("status = 'no_rain'").select(*keys, F.lit("no_rain").alias("method"))
    validation = ways.join(chosen.unionByName(dry, allowMissingColumns=True), keys, "left").drop("top_real")

    target = transform(points.join(best.select(*keys, F.col("added").alias("_added"), "nugget", "range", "sill"), keys), F.col("_added"))
    raw = krige(target, cells, ["county"], ["date"], cell=cell, carry=("mean_mm",)).join(best.select(*keys, "added"), keys)
    mean = S.guarded_mean(F.col("mean_mm"))
    plain = F.col("added") < 0
    value = F.when(plain, S.back_plain(F.col("pred"))).otherwise(S.back_ratio(F.col("pred"), mean + F.col("added")))
    se = (F.exp(F.least(F.col("var"), F.lit(700.0))) - 1) * F.when(plain, mean).otherwise(mean + F.col("added"))
    names = [*keys, *cell]
    kriged = raw.select(*names, F.lit("krige").alias("method"), value.alias("value"), (value / mean).alias("anomaly"),
                        se.alias("se_backtransformed_var"), (se / mean).alias("se_anomaly"))
    none = [F.lit(-9999.0).alias("se_backtransformed_var"), F.lit(-9999.0).alias("se_anomaly")]
    by_distance = idw(cells, idw_points, ["county"], ["date"], cell=cell, carry=("mean_mm",))
    by_distance = by_distance.select(*names, F.lit("idw").alias("method"), "value", (F.col("value") / mean).alias("anomaly"), *none)
    zero = no_rain(cells, ways, ["county"], cell).select(*names, F.lit("no_rain").alias("method"), "value", F.lit(0.0).alias("anomaly"), *none)
    return validation, kriged.unionByName(by_distance).unionByName(zero)


def monthly_levels(points: DataFrame, params: DataFrame, group: list[str], width: float, bins: int, model: str = "matern32") -> DataFrame:
    """Variograms to try for each group (K2, K17): with the level's nugget fixed, with its range fixed, and with both fixed
    and a free sill; at the first level also with all free. params: county, level (0 low, 1 med, 2 high), nug, rng.

    Returns group, vario, level, nugget, range, sill.
    """
    experimental = written(variogram(points, group, width, bins), "variogram")
    kinds = ("free_all", "fix_nug", "fix_rng", "free_sil")  # names of runs (fixed values)
    tried = F.explode(F.when(F.col("level") == 0, F.array(*map(F.lit, kinds))).otherwise(F.array(*map(F.lit, kinds[1:])))).alias("kind")
    runs = experimental.select(*group).distinct().join(params, "county").select("*", tried)
    nugget = F.when(F.col("kind").isin("fix_nug", "free_sil"), F.col("nug")).alias("nugget")
    range_ = F.when(F.col("kind").isin("fix_rng", "free_sil"), F.col("rng")).alias("range")
    vario = F.when(F.col("kind") == "free_all", "vari_free_all").otherwise(F.concat(F.lit("vari_"), "kind", F.lit("_"), F.col("level").cast("string")))
    runs = runs.select(*group, vario.alias("vario"), "level", nugget, range_)
    keys = [*group, "vario", "level"]
    return fit(experimental.join(runs.select(*keys), group), keys, model, runs).withColumn("sill", F.greatest("sill", F.lit(1e-4))).drop("sse")


#: Added to a climate mean before it divides, so that a mean of zero gives no error (a fixed value).
TINY = 1e-8


def monthly_grids(points: DataFrame, runs: DataFrame, cells: DataFrame, cell: tuple[str, ...] = CELL, model: str = "matern32", carry: tuple[str, ...] = ()) -> DataFrame:
    """county, moy, month, vario, level, cell, `carry`, and four grids of every run of monthly_levels.

    value (mm) and se_backtransformed_var are back-transformed by the climate mean of the cell and month of the year;
    anomaly and se_anomaly are both divided by it. value isn't clamped, so that negative cells can be counted.
    points: county, moy, month, skn, lon, lat, y. cells: county, moy, cell, lon, lat, mean_mm and `carry`.
    """
    tried = points.join(runs, ["county", "month"])
    maps = krige(tried, cells, ["county", "moy"], ["month", "vario", "level"], model, cell, carry=("mean_mm", *carry))
    mean = F.col("mean_mm")

    def back_of(c: str) -> Column:
        return F.round((F.exp(F.least(F.col(c), F.lit(700.0))) - 1) * mean, 10)

    out = maps.select("county", "moy", "month", "vario", "level", *cell, "mean_mm", *carry, back_of("pred").alias("value"), back_of("var").alias("se_backtransformed_var"))
    return out.withColumns({"anomaly": F.col("value") / (mean + TINY), "se_anomaly": F.col("se_backtransformed_var") / (mean + TINY)}).drop("mean_mm")


def monthly_loo(points: DataFrame, runs: DataFrame, model: str = "matern32") -> DataFrame:
    """county, month, vario, level, skn, obs, pred, obs_anomaly, pred_anomaly and was_negative of every station, real or
    filled, left out in turn (K4, K17). The anomaly is of the prediction before it is clamped at zero."""
    keys = ["county", "month", "vario", "level"]
    loo = krige_loo(points.join(runs, ["county", "month"]), keys, model)
    loo = loo.join(points.select("county", "month", "skn", "mean_mm", F.col("rf").alias("obs")), ["county", "month", "skn"])
    pred = F.round((F.exp(F.least(F.col("y_pred"), F.lit(700.0))) - 1) * F.col("mean_mm"), 10)
    loo = loo.select(*keys, "skn", "obs", pred.alias("_pred"), (F.col("obs") / F.col("mean_mm")).alias("obs_anomaly"), (pred / (F.col("mean_mm") + TINY)).alias("pred_anomaly"))
    return loo.withColumns({"was_negative": F.col("_pred") < 0, "pred": F.greatest("_pred", F.lit(0.0))}).drop("_pred")


def monthly_points(stations: DataFrame, mean: str = "mean_mm") -> DataFrame:
    """Stations of a month (county, month, skn, lon, lat, rf and the climate mean at the station) with moy, the month of the
    year, and y = log(rf / mean + 1); a mean of 0 counts as 0.001 (H9, H10)."""
    rows = stations.withColumn("mean_mm", S.guarded_mean(F.col(mean)))
    return rows.withColumns({"moy": F.month("month"), "y": S.log_ratio(F.col("rf"), F.col("mean_mm"))})


def monthly_map(
    points: DataFrame,
    params: DataFrame,
    cells: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    cell: tuple[str, ...] = CELL,
    width: float = 0.5,
    bins: int = 6,
    model: str = "matern32",
    carry: tuple[str, ...] = (),
    least: int = 3,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grids, validation, left-out predictions) of every county and month.

    Levels are tried in turn: only county-months none of whose maps is good at a level go on to the next, so no map is made
    that can't be chosen. Then the best run is chosen, among all that were tried where none was good, and of the maps, which
    are written level by level, a semi-join keeps the chosen run's. A county-month of fewer than `least` stations has no map.

    grids: county, month, vario, cell, value (mm, negative ones as 0), se_backtransformed_var, anomaly, se_anomaly; a state
    map is spatial.mosaic of them. validation: a row for each run tried, with class, errors in mm and as anomalies, negative
    cells, and chosen. points: as monthly_points gives them. params: as for monthly_levels. classify(maps) gives county,
    month, vario, level, prob_ugly of maps with cell, value and `carry`.
    """
    group = ["county", "month"]
    keys = [*group, "vario", "level"]
    enough = points.groupBy(*group).count().filter(F.col("count") >= least).select(*group)
    points = written(points.join(enough, group, "left_semi"), "points")
    runs = written(monthly_levels(points, params, group, width, bins, model), "levels")
    left = points.select(*group).distinct()
    maps, checked, loos = [], [], []
    for level in sorted(r["level"] for r in params.select("level").distinct().collect()):  # low, medium, high
        here = runs.filter(F.col("level") == level).join(left, group, "left_semi")
        grids = written(monthly_grids(points, here, cells, cell, model, carry), "maps")
        loo = written(monthly_loo(points, here, model), "loo")
        scored = metrics.scores(loo, keys)
        anomalies = metrics.scores(loo, keys, "obs_anomaly", "pred_anomaly").select(*keys, *(F.col(c).alias(f"{c}_anomaly") for c in ("r2", "rmse", "mae", "bias")))
        negative = metrics.grid_negatives(grids, keys).withColumnRenamed("high", "rf_max").withColumnRenamed("low", "rf_min")
        every = here.join(scored, keys).join(anomalies, keys).join(loo.groupBy(*keys).agg(F.bool_or("was_negative").alias("negative_loo")), keys)
        every = written(every.join(negative, keys).join(classify(grids), keys), "checked")
        maps.append(grids)
        checked.append(every)
        loos.append(loo)
        good = every.filter("prob_ugly <= 0.5").select(*group).distinct()
        left = written(left.join(good, group, "left_anti"), "left")
        if left.isEmpty():
            break
    validation = written(reduce(DataFrame.unionByName, checked), "validation")
    best = written(metrics.best_variogram(validation, group).select(*keys), "best")
    chosen = reduce(DataFrame.unionByName, maps).join(F.broadcast(best) if best.count() <= BROADCAST_CELLS else best, keys, "left_semi")
    grids = chosen.select(*group, "vario", *cell, F.greatest("value", F.lit(0.0)).alias("value"), "se_backtransformed_var", "anomaly", "se_anomaly")
    validation = validation.join(best.withColumn("chosen", F.lit(True)), keys, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
    return grids, validation, reduce(DataFrame.unionByName, loos).join(best, keys, "left_semi")


def back(df: DataFrame, y: str = "y_pred") -> DataFrame:
    """Adds pred in mm from a prediction of y, by the candidate's base m."""
    return df.withColumn("pred", F.when(F.col("added") < 0, S.back_plain(F.col(y))).otherwise(S.back_ratio(F.col(y), F.col("m"))))
