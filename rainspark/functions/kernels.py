"""Small NumPy kernels for one group of stations; Spark groups the rows and calls these once per group or block."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from rainspark.functions.scalars import EARTH_RADIUS_M


#: Correlation by distance in ranges. Matern models have smoothness 1/2 (exp), 3/2 or 5/2.
SHAPES = {
    "exp": lambda u: np.exp(-u),
    "matern32": lambda u: (1 + u) * np.exp(-u),
    "matern52": lambda u: (1 + u + u * u / 3) * np.exp(-u),
}


def covariance(model: str, nugget: float, range_: float, sill: float) -> Callable[[np.ndarray], np.ndarray]:
    """Covariance by distance; `sill` is the total."""
    part = max(sill - nugget, 0.0)
    shape = SHAPES[model]

    def at(h: np.ndarray) -> np.ndarray:
        return np.where(h == 0, part + nugget, part * shape(h / max(range_, 1e-12)))

    return at


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1))


def great_circle(lon: np.ndarray, lat: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Metres between each first and each second place, on a sphere."""
    x, y, x2, y2 = (np.radians(v) for v in (lon[:, None], lat[:, None], lon2[None, :], lat2[None, :]))
    a = np.sin((y2 - y) / 2) ** 2 + np.cos(y) * np.cos(y2) * np.sin((x2 - x) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


def _unit(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    x, y = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)], 1)


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared chords between each first and each second point of the unit sphere."""
    out = np.zeros((len(a), len(b)))
    for i in range(3):
        d = a[:, i, None] - b[None, :, i]
        d *= d
        out += d
    return out


def near_points(q: np.ndarray, u: np.ndarray, k: int, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """The places in u of the k points of the unit sphere nearest to each q, in no order, and their squared chords.

    Points are sorted into cubes; a cube and its 26 neighbours hold all points nearer than a cube's width. Where these are fewer
    than k the cubes are made twice as wide, until one holds everything.
    """
    m, n = len(q), len(u)
    k = min(k, n)
    at, chord = np.empty((m, k), np.int64), np.empty((m, k))
    sides = np.sort(u.max(0) - u.min(0)) if n else np.zeros(3)
    width = max(float(np.sqrt(sides[2] * sides[1] * (k + 3 * np.sqrt(k)) / (np.pi * max(n, 1)))), 1e-6)
    todo = np.arange(m)
    while len(todo):
        side = int(2 / width) + 4
        everything = width >= 2 or n <= 4 * k

        def cube(points: np.ndarray, width: float = width, side: int = side) -> np.ndarray:
            return ((np.floor((points + 1) / width).astype(np.int64) + 1) * [side * side, side, 1]).sum(1)

        key = np.zeros(n, np.int64) if everything else cube(u)
        own = np.zeros(len(todo), np.int64) if everything else cube(q[todo])
        order = np.argsort(key, kind="stable")
        key, sorted_u = key[order], u[order]
        todo = todo[np.argsort(own, kind="stable")]
        cubes, first = np.unique(np.sort(own), return_index=True)
        ends = np.append(first[1:], len(todo))
        column = cubes[:, None] + np.array([i * side * side + j * side for i in (-1, 0, 1) for j in (-1, 0, 1)] if not everything else [0])
        starts, stops = np.searchsorted(key, column - 1), np.searchsorted(key, column + 1, "right")
        short = []
        for c in range(len(cubes)):
            spans = [np.arange(x, y) for x, y in zip(starts[c].tolist(), stops[c].tolist(), strict=True) if y > x]
            who = np.concatenate(spans) if spans else np.empty(0, np.int64)
            for low in range(first[c], ends[c], step):
                rows = todo[low : min(low + step, ends[c])]
                if len(who) < k:
                    short.append(rows)
                    continue
                far = _chords(q[rows], sorted_u[who])
                best = np.argpartition(far, k - 1, axis=1)[:, :k] if len(who) > k else np.broadcast_to(np.arange(k), far.shape)
                found = np.take_along_axis(far, best, 1)
                whole = np.full(len(rows), True) if everything else found.max(1) <= (width * (1 - 1e-9)) ** 2
                at[rows[whole]], chord[rows[whole]] = order[who[best[whole]]], found[whole]
                short.append(rows[~whole])
        todo = np.concatenate(short)
        width *= 2
    return at, chord


def _pairs(lon: np.ndarray, lat: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Metres between places, elementwise (great_circle on arrays of one shape)."""
    x, y, x2, y2 = (np.radians(v) for v in (lon, lat, lon2, lat2))
    a = np.sin((y2 - y) / 2) ** 2 + np.cos(y) * np.cos(y2) * np.sin((x2 - x) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


def nearest_metres(lon: np.ndarray, lat: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Metres from each first place to the nearest of the second ones."""
    near = near_points(_unit(lon, lat), _unit(lon2, lat2), min(4, len(lon2)))[0]
    return _pairs(lon[:, None], lat[:, None], lon2[near], lat2[near]).min(1)


def neighbours(lon: np.ndarray, lat: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each station's nearest others, about k, and their distances in metres, rounded to `digits`; of equally far
    ones the lesser place is nearer. A list that would end among equally far stations ends before them; -1 fills it up."""
    n = len(lon)
    u = _unit(lon, lat)
    most = min(k + 9, n)
    at, dist = np.sort(near_points(u, u, most)[0], 1), np.empty((n, most))
    for low in range(0, n, 4096):
        rows, near = np.arange(low, min(low + 4096, n)), at[low : low + 4096]
        d = np.round(_pairs(lon[rows, None], lat[rows, None], lon[near], lat[near]), digits)
        last = d.max(1, keepdims=True) if most < n else np.inf
        d[(near == rows[:, None]) | (d >= last)] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        dist[rows] = np.take_along_axis(d, order, 1)
        at[rows] = np.where(np.isfinite(dist[rows]), np.take_along_axis(near, order, 1), -1)
    return at, dist


@lru_cache(maxsize=4)
def _kept_neighbours(lon: bytes, lat: bytes, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    return neighbours(np.frombuffer(lon), np.frombuffer(lat), k, digits)


def lists_of(lon: np.ndarray, lat: np.ndarray, share: float, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """neighbours() long enough for most stations to find k present ones at a time when `share` of all are present. The lists of the
    last networks are kept: blocks of times that a process works on mostly have the same stations."""
    longest = min(int((k + 3 * np.sqrt(k)) / share) // 16 * 16 + 16, 512)
    return _kept_neighbours(lon.astype(np.float64).tobytes(), lat.astype(np.float64).tobytes(), longest, digits)


def _all_nearest(rows: np.ndarray, lon: np.ndarray, lat: np.ndarray, k: int, digits: int, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest others of some stations, by the distances to all."""
    at, dist = np.empty((len(rows), k), np.int64), np.empty((len(rows), k))
    for a in range(0, len(rows), step):
        part = rows[a : a + step]
        d = np.round(great_circle(lon[part], lat[part], lon, lat), digits)
        d[np.arange(len(part)), part] = np.inf
        at[a : a + step] = np.argsort(d, axis=1, kind="stable")[:, :k]
        dist[a : a + step] = np.take_along_axis(d, at[a : a + step], 1)
    return at, dist


#: Stations of a group from which on neighbours are looked up by cubes.
MANY = 512


def nearest(skn: np.ndarray, lon: np.ndarray, lat: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """For stations in ascending order of skn: the places of each one's k nearest others, and their distances in metres,
    rounded to `digits`; of equally far ones the lesser skn is nearer."""
    n = len(skn)
    k = min(k, n - 1)
    if n < MANY:
        return _all_nearest(np.arange(n), lon, lat, k, digits)
    at, dist = neighbours(lon, lat, k, digits)
    at, dist = at[:, :k], dist[:, :k]
    short = np.flatnonzero(at[:, -1] < 0)
    at[short], dist[short] = _all_nearest(short, lon, lat, k, digits)
    return at, dist


def nearest_present(lists: tuple[np.ndarray, np.ndarray], present: np.ndarray, lon: np.ndarray, lat: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, ...]:
    """Of the stations present (places in ascending order) the k nearest others that are present: where each one's list begins
    (and the end), the places of neighbours and their distances. lists: neighbours() of all stations."""
    n = len(present)
    k = min(k, n - 1)
    if n < MANY:  # few are found sooner by all distances
        few, dist = _all_nearest(np.arange(n), lon[present], lat[present], k, digits)
        return np.arange(n + 1) * k, present[few].ravel(), dist.ravel()
    here = np.zeros(len(lon) + 1, bool)  # the last one stands for -1
    here[present] = True
    wide = lists[0].shape[1]
    have = here.take(lists[0].take(present, 0), mode="wrap")
    used = have & (np.cumsum(have, axis=1, dtype=np.int16) <= k)
    found = used.sum(1)
    short = np.flatnonzero(found < k)
    pick = np.flatnonzero(used)
    pick = present[pick // wide] * wide + pick % wide
    place, dist = lists[0].ravel().take(pick), lists[1].ravel().take(pick)
    if len(short) == 0:
        return np.arange(n + 1) * k, place, dist
    whole = np.ones(n, bool)
    whole[short] = False
    places, dists = np.empty((n, k), np.int64), np.empty((n, k))
    keep = np.repeat(whole, found)
    places[whole], dists[whole] = place[keep].reshape(-1, k), dist[keep].reshape(-1, k)
    few, dists[short] = _all_nearest(short, lon[present], lat[present], k, digits)
    places[short] = present[few]
    return np.arange(n + 1) * k, places.ravel(), dists.ravel()


def inverse_distance(d: np.ndarray, z: np.ndarray, power: float) -> np.ndarray:
    """Mean of z weighted by d ** -power for each row of d; a distance of 0 gives that point's own value (the least one)."""
    hit = d == 0
    w = np.power(d, -power, where=~hit, out=np.zeros_like(d))
    total = w.sum(1)
    mean = np.divide(w @ z, total, out=np.full(len(d), np.nan), where=total > 0)
    exact = np.where(hit, z[None, :], np.inf).min(1)
    return np.where(hit.any(1), exact, mean)


#: Stations of a tile of distances: rows, and columns. A tile of doubles is 2 MB, so that it stays in a core's cache.
TILE = (64, 4096)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out, y = np.empty((len(a), len(b))), np.empty((len(a), len(b)))
    for x, i in ((out, 0), (y, 1)):
        np.subtract(np.ascontiguousarray(a[:, i])[:, None], np.ascontiguousarray(b[:, i]), out=x)
        np.multiply(x, x, out=x)
    return np.add(out, y, out=out)


def left_out_means(xy: np.ndarray, z: np.ndarray, power: float) -> np.ndarray:
    """Inverse-distance means of every station from all others, at many times at once.

    z: stations x times, NaN where a station is absent at a time. Distances go by in tiles, each worked out once for all times.
    A station at the place of others that are present takes the least of their values.
    """
    n, times = z.shape
    here = ~np.isnan(z)
    right = np.concatenate([np.where(here, z, 0.0), here], 1)
    out = np.full(z.shape, np.nan)
    for a in range(0, n, TILE[0]):
        rows = slice(a, min(a + TILE[0], n))
        total, same = np.zeros((rows.stop - a, 2 * times)), []
        for b in range(0, n, TILE[1]):
            w = _squared(xy[rows], xy[b : b + TILE[1]])
            own = np.arange(max(a, b), min(rows.stop, b + w.shape[1]))
            w[own - a, own - b] = np.inf
            if w.min() == 0:
                i, j = np.nonzero(w == 0)
                same.append(np.stack([a + i, b + j]))
                w[i, j] = np.inf
            np.divide(1.0, w if power == 2 else w ** (power / 2), out=w)
            total += w @ right[b : b + TILE[1]]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[rows] = np.where(total[:, times:] > 0, total[:, :times] / total[:, times:], np.nan)
        i, j = np.concatenate(same, 1) if same else np.empty((2, 0), int)
        for k in np.unique(i).tolist():
            least = np.where(here[j[i == k]], z[j[i == k]], np.inf).min(0)
            out[k] = np.where(np.isfinite(least), least, out[k])
    return out


def semivariances(xy: np.ndarray, y: np.ndarray, width: float, bins: int) -> tuple[np.ndarray, ...]:
    """bin, pairs, mean distance and semivariance of all pairs nearer than bins * width, by bins of `width`."""
    i, j = np.triu_indices(len(y), 1)
    h = np.sqrt(((xy[i] - xy[j]) ** 2).sum(1))
    which = np.floor(h / width).astype(np.int64)
    near = which < bins
    which, h, g = which[near], h[near], 0.5 * (y[i] - y[j])[near] ** 2
    n = np.bincount(which, minlength=bins)
    some = np.flatnonzero(n)
    return some, n[some], np.bincount(which, h, bins)[some] / n[some], np.bincount(which, g, bins)[some] / n[some]


def _morton(xy: np.ndarray) -> np.ndarray:
    """Order of places along a curve that keeps near ones together."""
    low = xy.min(0)
    at = ((xy - low) / np.maximum((xy.max(0) - low).max(), 1e-300) * 65535).astype(np.uint64)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        at = (at | (at << np.uint64(shift))) & np.uint64(mask)
    return np.argsort(at[:, 0] | (at[:, 1] << np.uint64(1)), kind="stable")


def semivariances_over_times(xy: np.ndarray, y: np.ndarray, width: float, bins: int, tile: tuple[int, int] = (256, 512)) -> tuple[np.ndarray, ...]:
    """pairs, sum of distances and sum of semivariances (each times x bins) of stations at many times at once.

    y: stations x times, NaN where a station is absent at a time. Tiles of pairs are worked out once for all times: stations of a
    tile lie near one another, so it has pairs of few bins, and what it adds to a bin comes from products with a matrix of 0 and 1.
    """
    order = _morton(xy)
    xy, y = xy[order], y[order]
    n, times = y.shape
    here = (~np.isnan(y)).astype(np.float64)
    y = np.where(here > 0, y, 0.0)
    y = (y - y.sum(0) / np.maximum(here.sum(0), 1)) * here  # semivariances don't depend on the mean; sums lose less without it
    right = np.concatenate([here, y, y * y], 1)
    pairs, far, gamma = (np.zeros((times, bins)) for _ in range(3))
    for b in range(0, n, tile[1]):
        cols = slice(b, min(b + tile[1], n))
        for a in range(0, cols.stop, tile[0]):
            rows = slice(a, min(a + tile[0], n))
            h = np.sqrt(_squared(xy[rows], xy[cols]))
            which = h / width
            if rows.stop > b:  # each pair once
                twice = np.arange(a, rows.stop)[:, None] >= np.arange(b, cols.stop)
                which[twice], h[twice] = np.inf, 0.0
            low, top = int(min(which.min(), bins)), int(min(which.max(), bins))
            if low == bins:
                continue
            here_a, y_a, yy_a = (right[rows, k * times : (k + 1) * times] for k in range(3))
            ones, own, squares = np.split(right[cols].sum(0), 3)
            found = [(here_a.sum(0) * ones, (here_a * (h @ right[cols, :times])).sum(0), yy_a.sum(0) * ones + here_a.sum(0) * squares - 2 * y_a.sum(0) * own)]
            for k in range(low + 1, top + 1):  # pairs of bin k and beyond
                beyond = (which >= k).astype(np.float64)
                one, two, three = np.split(beyond @ right[cols], 3, 1)
                beyond *= h
                found.append(((here_a * one).sum(0), (here_a * (beyond @ right[cols, :times])).sum(0), (yy_a * one + here_a * three - 2 * y_a * two).sum(0)))
            found = np.array(found)
            found[:-1] -= found[1:]
            for k in range(low, min(top + 1, bins)):
                some = found[k - low, 0] > 0.5
                pairs[:, k] += np.where(some, found[k - low, 0], 0)
                far[:, k] += np.where(some, found[k - low, 1], 0)
                gamma[:, k] += np.where(some, 0.5 * found[k - low, 2], 0)
    return pairs, far, np.maximum(gamma, 0.0)


def _system(xy: np.ndarray, cov: Callable) -> np.ndarray:
    """Inverse of the ordinary kriging system; the pseudo-inverse only where it is singular."""
    n = len(xy)
    k = np.ones((n + 1, n + 1))
    k[:n, :n] = cov(distances(xy, xy)) + 1e-9 * np.eye(n)
    k[n, n] = 0
    try:
        inverse = np.linalg.inv(k)
        if np.isfinite(inverse).all() and abs(k[0] @ inverse[:, 0] - 1) < 1e-6:
            return inverse
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(k)


def solve_kriging(xy: np.ndarray, y: np.ndarray, cov: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Dual weights (n + 1) and the inverse of the ordinary kriging system."""
    inverse = _system(xy, cov)
    return inverse @ np.append(y, 0.0), inverse


def predict(xy, weights, inverse, cells, cov) -> tuple[np.ndarray, np.ndarray]:
    """Prediction and kriging variance at cells."""
    right = np.ones((len(cells), len(xy) + 1))
    right[:, :-1] = cov(distances(cells, xy))
    var = cov(np.zeros(1))[0] - ((right @ inverse) * right).sum(1)
    return right @ weights, np.maximum(var, 0)


def leave_one_out(xy: np.ndarray, y: np.ndarray, cov: Callable) -> np.ndarray:
    """y less its residual (K^-1 y)_i / (K^-1)_ii; null for a group of one."""
    if len(y) < 2:
        return np.full(len(y), np.nan)
    weights, inverse = solve_kriging(xy, y, cov)
    return y - weights[:-1] / np.diag(inverse)[:-1]


def stacked_leave_one_out(d: np.ndarray, y: np.ndarray, params: np.ndarray, model: str) -> np.ndarray:
    """leave_one_out for many systems of one size at once: distances (systems x n x n), values (systems x n), and nugget, range
    and sill of each (systems x 3). All inverses are one call; systems that are singular get a pseudo-inverse."""
    s, n = y.shape
    nugget, range_, sill = (params[:, k, None, None] for k in range(3))
    part = np.maximum(sill - nugget, 0.0)
    k = np.ones((s, n + 1, n + 1))
    k[:, :n, :n] = np.where(d == 0, part + nugget, part * SHAPES[model](d / np.maximum(range_, 1e-12))) + 1e-9 * np.eye(n)
    k[:, n, n] = 0
    try:
        inverse = np.linalg.inv(k)
    except np.linalg.LinAlgError:  # one of them is exactly singular
        inverse = np.full_like(k, np.nan)
    with np.errstate(invalid="ignore"):
        good = np.isfinite(inverse).all((1, 2)) & (np.abs((k[:, 0] * inverse[:, :, 0]).sum(1) - 1) < 1e-6)
    for i in np.flatnonzero(~good).tolist():
        try:
            inverse[i] = np.linalg.inv(k[i])
            if np.isfinite(inverse[i]).all() and abs(k[i, 0] @ inverse[i, :, 0] - 1) < 1e-6:
                continue
        except np.linalg.LinAlgError:
            pass
        inverse[i] = np.linalg.pinv(k[i])
    weights = (inverse[:, :n, :n] @ y[:, :, None])[:, :, 0]
    return y - weights / np.diagonal(inverse, axis1=1, axis2=2)[:, :n]


def stacked_semivariances(d: np.ndarray, y: np.ndarray, width: float, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """pairs and mean distance (groups x bins) and semivariances (groups x targets x bins) of groups of one size.

    d: groups x n x n, y: groups x targets x n. Bins without pairs have zeros.
    """
    i, j = np.triu_indices(y.shape[2], 1)
    h = d[:, i, j]
    which = np.floor(h / width).astype(np.int64)
    inside = (which[:, :, None] == np.arange(bins)).astype(np.float64)
    n = inside.sum(1)
    mean = np.divide((h[:, None, :] @ inside)[:, 0], n, out=np.zeros_like(n), where=n > 0)
    g = (0.5 * (y[:, :, i] - y[:, :, j]) ** 2) @ inside
    return n, mean, np.divide(g, n[:, None], out=np.zeros_like(g), where=n[:, None] > 0)


def stacked_fits(h: np.ndarray, gamma: np.ndarray, n: np.ndarray, model: str) -> np.ndarray:
    """nugget, range and sill of many free fits at once (fits x 3): fit_variogram() with nothing fixed, on fits x bins.

    Bins without pairs (n = 0) have no weight. A fit without any bin is NaN.
    """
    w = np.where(n > 0, n / np.maximum(h, 1e-9) ** 2, 0.0)
    own = np.arange(len(h))
    sw, sg = w.sum(1)[:, None], (w * gamma).sum(1)[:, None]

    def linear(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f = 1 - SHAPES[model](h[:, None, :] / np.maximum(ranges[:, :, None], 1e-12))
        wf = f * w[:, None, :]
        sf, sff, sfg = wf.sum(2), (wf * f).sum(2), (wf * gamma[:, None, :]).sum(2)
        zero = np.zeros_like(sf)
        rising = np.maximum(sfg / np.maximum(sff, 1e-300), 0)
        det = sw * sff - sf * sf
        with np.errstate(divide="ignore", invalid="ignore"):
            flat = np.broadcast_to(sg / sw, sf.shape)
            c0, c1 = (sff * sg - sf * sfg) / det, (sw * sfg - sf * sg) / det
        inside = (det > 1e-12 * sw * sff) & (c0 >= 0) & (c1 >= 0)
        c0s, c1s = np.stack([zero, flat, np.where(inside, c0, zero)]), np.stack([rising, zero, np.where(inside, c1, rising)])
        errors = (((c0s[..., None] + c1s[..., None] * f - gamma[:, None, :]) ** 2) * w[:, None, :]).sum(3)
        best = errors.argmin(0)[None]
        return tuple(np.take_along_axis(x, best, 0)[0] for x in (errors, c0s, c1s))

    top = np.where(n > 0, h, 0).max(1)
    low, high = np.maximum(top / 100, 1e-6), top * 3 + 1e-6
    for turn in range(3):
        grid = np.exp(np.log(low)[:, None] + np.linspace(0, 1, 25) * np.log(high / low)[:, None])
        sse, c0, c1 = linear(grid)
        best = sse.argmin(1)
        if turn < 2:
            low, high = grid[own, np.maximum(best - 1, 0)], grid[own, np.minimum(best + 1, 24)]
    out = np.stack([c0[own, best], grid[own, best], c0[own, best] + c1[own, best]], 1)
    return np.where((n > 0).any(1)[:, None], out, np.nan)


def fit_variogram(h, gamma, n, model: str = "exp", nugget=None, range_=None, sill=None) -> tuple[float, float, float, float]:
    """nugget, range, sill (total) and weighted squared error, weights n / h^2. A value that is given stays fixed.

    For a given range the model is linear in nugget and partial sill, which are found by least squares with both kept
    non-negative; a free range is searched on a grid that narrows twice. With all three given nothing is fitted.
    """
    h, gamma, n = (np.asarray(x, float) for x in (h, gamma, n))
    nugget, range_, sill = (None if x is None or not np.isfinite(x) else float(x) for x in (nugget, range_, sill))
    if not len(h):
        found = (nugget or 0.0, 1.0 if range_ is None else range_, sill if sill is not None else nugget or 0.0)
        return *found, 0.0
    w = n / np.maximum(h, 1e-9) ** 2
    unit = covariance(model, 0.0, 1.0, 1.0)

    def linear(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least error, nugget and partial sill of each range."""
        f = np.where(ranges[:, None] > 0, 1 - unit(h / np.maximum(ranges[:, None], 1e-12)), 1.0)
        sw, sf, sff = w.sum(), f @ w, (f * f) @ w
        sg, sfg = (w * gamma).sum(), f @ (w * gamma)
        flat = np.full(len(ranges), 1.0)
        if nugget is not None and sill is not None:
            options = [(nugget * flat, max(sill - nugget, 0.0) * flat)]
        elif nugget is not None:
            options = [(nugget * flat, np.maximum((sfg - nugget * sf) / np.maximum(sff, 1e-300), 0))]
        elif sill is not None:  # nugget + partial = sill: one unknown in [0, sill]
            u = f - 1
            part = ((u * (gamma - sill)) @ w) / np.maximum((u * u) @ w, 1e-300)
            part = np.clip(part, 0, sill)
            options = [(sill - part, part)]
        else:
            options = [(0 * flat, np.maximum(sfg / np.maximum(sff, 1e-300), 0)), (sg / sw * flat, 0 * flat)]
            det = sw * sff - sf * sf
            good = det > 1e-12 * sw * sff
            c0 = np.divide(sff * sg - sf * sfg, det, out=-flat, where=good)
            c1 = np.divide(sw * sfg - sf * sg, det, out=-flat, where=good)
            inside = (c0 >= 0) & (c1 >= 0)
            options.append((np.where(inside, c0, options[0][0]), np.where(inside, c1, options[0][1])))
        errors = np.stack([((a[:, None] + b[:, None] * f - gamma) ** 2) @ w for a, b in options])
        best, at = errors.argmin(0), np.arange(len(ranges))
        return errors[best, at], np.stack([a for a, _ in options])[best, at], np.stack([b for _, b in options])[best, at]

    if range_ is not None:
        grid = np.array([range_])
    else:
        low, high = max(h.max() / 100, 1e-6), h.max() * 3 + 1e-6
        for _ in range(2):
            grid = np.geomspace(low, high, 25)
            best = int(linear(grid)[0].argmin())
            low, high = grid[max(best - 1, 0)], grid[min(best + 1, 24)]
        grid = np.geomspace(low, high, 25)
    sse, c0, c1 = linear(grid)
    best = int(sse.argmin())
    return float(c0[best]), float(grid[best]), float(c0[best] + c1[best]), float(sse[best])


def value_numbers(rows: np.ndarray) -> list[np.ndarray]:
    """Each row's values as their numbers in ascending order of distinct values; what stands for NaN isn't used."""
    return [np.unique(r, return_inverse=True)[1] for r in rows]


def average_ranks(numbers: np.ndarray) -> np.ndarray:
    """Ranks from 1 of values that are given by value_numbers, ties at their average. No sort."""
    times = np.bincount(numbers)
    return (np.cumsum(times) - (times - 1) / 2)[numbers]


def rank_relations(
    a: np.ndarray, b: np.ndarray, same: bool, least_overlap: int, ratio: tuple[float, float]
) -> Iterator[tuple[int, int, int, float, float, float]]:
    """(row of a, row of b, common days, Spearman, sum of a, sum of b on these days) of pairs of stations.

    a and b: stations x days with NaN for missing. Overlaps and sums of all pairs come from products of the matrices;
    only pairs with enough days and a sum ratio that fits one way or the other are ranked. same: b is a, each pair once.
    """
    here, there = ~np.isnan(a), ~np.isnan(b)
    n = here.astype(np.float64) @ there.T.astype(np.float64)
    sum_a = np.where(here, a, 0.0) @ there.T.astype(np.float64)
    sum_b = here.astype(np.float64) @ np.where(there, b, 0.0).T
    with np.errstate(divide="ignore", invalid="ignore"):
        forth, back = sum_a / sum_b, sum_b / sum_a
    good = (n >= max(least_overlap, 1)) & (((forth > ratio[0]) & (forth < ratio[1])) | ((back > ratio[0]) & (back < ratio[1])))
    if same:
        good &= np.triu(np.ones_like(good), 1)
    left, right = value_numbers(a), value_numbers(b)
    for i, j in np.argwhere(good).tolist():
        both = np.flatnonzero(here[i] & there[j])
        middle = (len(both) + 1) / 2
        x, y = average_ranks(left[i][both]) - middle, average_ranks(right[j][both]) - middle
        spread = np.sqrt((x @ x) * (y @ y))
        if spread > 0:
            yield i, j, int(n[i, j]), float(x @ y / spread), float(sum_a[i, j]), float(sum_b[i, j])


def best_estimates(rain: np.ndarray, order: np.ndarray, ratio: np.ndarray, holes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the first k reporting predictors' rain x ratio on the days `holes`, and how many there were.

    rain: stations x days, NaN for missing; order: the predictors' rows, best first; ratio: theirs in the same order.
    """
    value = rain[np.ix_(order, holes)] * ratio[:, None]
    have = ~np.isnan(value)
    used = have & (np.cumsum(have, axis=0) <= k)
    n = used.sum(0)
    total = np.where(used, value, 0.0).sum(0)
    return np.divide(total, n, out=np.full(len(holes), np.nan), where=n > 0), n


def _horn(v: np.ndarray, dx: float, dy: float) -> np.ndarray:
    """Degrees of the steepest slope at all cells but the outermost; NaN where any of the nine cells is."""
    a, b, c = v[:, :-2], v[:, 1:-1], v[:, 2:]
    east = (c[:-2] + 2 * c[1:-1] + c[2:] - a[:-2] - 2 * a[1:-1] - a[2:]) / (8 * dx)
    row = a + 2 * b + c
    south = (row[2:] - row[:-2]) / (8 * dy)
    return np.degrees(np.arctan(np.sqrt(east * east + south * south))) + 0 * b[1:-1]


def shapes(v: np.ndarray, dx: float, dy: float) -> tuple[np.ndarray, ...]:
    """slope, roughness, tri and curvature (slope of the slope) of a block of cells that comes with two more cells on all sides.

    NaN stands for no value, and comes out where a cell that is needed has none.
    """
    slope = _horn(v, dx, dy)
    inner = v[1:-1, 1:-1]
    rows, cols = inner.shape[0] - 2, inner.shape[1] - 2
    own = inner[1:-1, 1:-1]
    low, high, tri = own.copy(), own.copy(), np.zeros((rows, cols))
    for i in range(3):
        for j in range(3):
            other = inner[i : i + rows, j : j + cols]
            low, high = np.minimum(low, other), np.maximum(high, other)
            tri += np.abs(other - own)
    return slope[1:-1, 1:-1], high - low, tri / 8, _horn(slope, dx, dy)


@dataclass
class Forest:
    """Decision trees one after another: the feature and threshold of every node (feature -1 for a leaf), where its children
    are, the share of bad rows in a leaf, and where trees begin."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    roots: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Mean share over the trees for each row of x; all rows go down one level of all trees at a time."""
        node = np.repeat(self.roots[None, :], len(x), 0)
        own = np.arange(len(x))[:, None]
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return self.share[node].mean(1)
            down = np.where(x[own, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
            node = np.where(inner, down, node)


def screen_group(
    skn: np.ndarray, lon: np.ndarray, lat: np.ndarray, values: np.ndarray, score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    k: int, least: int, digits: int, spare: int = 30,
) -> tuple[np.ndarray, np.ndarray]:
    """(round of removal or -1, last probability) of the stations of one day, in ascending order of skn.

    The worst flagged station goes, round by round, while more than `least` are left. Every station has a list of its
    k + spare nearest ones; when one of them goes, only stations that had it among their k nearest get the next on their
    list and are scored anew. A list that runs out is made again from those left.
    score(rows, features): rows are places of stations, features their own values, then distances and each value of the k nearest.
    """
    n = len(skn)
    gone, prob, alive = np.full(n, -1), np.zeros(n), np.ones(n, bool)
    if n <= least:
        return gone, prob
    listed, far = nearest(skn, lon, lat, k + spare, digits)
    listed, far = list(listed), list(far)

    def near(i: int) -> tuple[np.ndarray, np.ndarray]:
        keep = alive[listed[i]]
        if keep.sum() < min(k, alive.sum() - 1):  # the list has run out
            others = np.flatnonzero(alive & (np.arange(n) != i))
            d = np.round(great_circle(lon[i : i + 1], lat[i : i + 1], lon[others], lat[others])[0], digits)
            order = np.argsort(d, kind="stable")[: k + spare]
            listed[i], far[i] = others[order], d[order]
            keep = np.ones(len(order), bool)
        return listed[i][keep][:k], far[i][keep][:k]

    around = np.full((n, k), -1)
    dist = np.full((n, k), -1.0)

    def renew(rows: np.ndarray) -> None:
        for i in rows.tolist():
            at, d = near(i)
            around[i], dist[i] = -1, -1.0
            around[i, : len(at)], dist[i, : len(at)] = at, d
        others = np.where(around[rows][:, :, None] >= 0, values[around[rows]], -1.0)  # -1 stands for a missing neighbour
        prob[rows] = score(rows, np.concatenate([values[rows], dist[rows], *(others[:, :, v] for v in range(values.shape[1]))], axis=1))

    renew(np.arange(n))
    for turn in range(n - least):
        flagged = np.flatnonzero(alive & (prob > 0.5))
        if not len(flagged):
            break
        worst = flagged[np.argmax(prob[flagged])]
        alive[worst] = False
        gone[worst] = turn
        if turn + 1 == n - least:
            break
        renew(np.flatnonzero(alive & (around == worst).any(1)))
    return gone, prob
