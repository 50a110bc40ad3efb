"""Exact k-nearest-neighbour vote (L6 / J5) as a pivot-cell join with distance bounds, for Minkowski distances of any order p > 0.

1. At most ``MAX_PIVOTS`` reference rows, in hash order, are pivots; every row belongs to the cell of its nearest pivot.
2. One pass over the reference rows keeps, per cell, the k smallest distances to the pivot (of rows with different keys); one pass over the
   queries keeps each cell's number of queries and its radius u.
3. From these summaries alone follows, per query cell i, a distance theta_i within which every query of the cell has k neighbours:
   the k-th smallest ``u_i + d(pivot_i, pivot_j) + d(pivot_j, row)``.
4. Cells that lie side by side are packed into groups of about ``block_rows`` queries. A reference row is copied to a group only if, for one
   of its cells, ``d(row, pivot_i) <= u_i + theta_i``: by the triangle inequality no other row can be among the k nearest.
5. Large groups are cut into blocks of queries and of rows; one cogrouped task per pair of blocks emits its k best neighbours per query, and a
   last bounded step (k * blocks candidates per query) keeps the overall k best. In a task all pairs get a single-precision value (order 2: one
   matrix product); those that may lie within the query's k-th smallest distance so far get their exact sum in double precision.

A row goes to as many groups as the bounds ask and never to more than there are; on data without clusters in many dimensions that can be all of
them, as in a plain block join; then blocks are large (an eighth of the rows, within 16 MB), so that few copies are made. Nothing is dropped before a bound or its exact distance excludes it, and no pair row is emitted. For p < 1 the
distance itself breaks the triangle inequality, but its p-th power keeps it, so the bounds work on that.

Defined results: rows with a null, NaN or infinite feature take no part; ties go to the smaller reference key; repeated query rows get a list
each; repeated reference rows are neighbours of their own; with ``exclude_self`` all reference rows with the query's key go (a null key equals
none); with fewer than k rows all are returned; empty inputs give an empty result. Columns other than key, label and features are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.session import cut_lineage

#: Pivots at most: bounds the driver's table of pivot distances (128 MB) and what tasks carry, whatever the number of rows.
MAX_PIVOTS = 4096
#: Bounds are widened by this share, against rounding.
SLACK = 1e-9
#: Copies that leave a task in one Arrow batch.
_OUT_ROWS = 16384
#: Copies of a reference row up to which small blocks are kept.
MAX_COPIES = 8
#: Bytes of a block's features.
BLOCK_BYTES = 16 << 20


@dataclass
class KnnPlan:
    """What the summaries decide: group of every pivot, its reach, and the blocks of every group."""

    cells: np.ndarray          # all pivots
    group_of: np.ndarray       # group of each of them; -1 where it has no queries
    pivots: np.ndarray         # those with queries, ordered so that a group's pivots stand together
    reach: np.ndarray          # of each of these
    starts: np.ndarray         # first pivot of each group
    query_blocks: np.ndarray   # per group
    row_blocks: np.ndarray     # per group
    rows: int = 0
    copies: int = 0            # reference rows sent to tasks, all copies counted

    @property
    def tasks(self) -> int:
        return int((self.query_blocks * self.row_blocks).sum())

    @property
    def copies_per_row(self) -> float:
        return self.copies / max(1, self.rows)


def _sums(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Sums of |a_i - b_j| ** p, added up feature by feature."""
    acc, diff = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
    for d in range(a.shape[1]):
        np.subtract(a[:, d][:, None], b[:, d][None, :], out=diff)
        if p == 2:
            np.multiply(diff, diff, out=diff)  # squaring needs no abs (same bits either sign)
        else:
            np.abs(diff, out=diff)
            if p != 1:
                np.power(diff, p, out=diff)
        acc += diff
    return acc


def _metric(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """A distance that keeps the triangle inequality and the order of the Minkowski distance."""
    s = _sums(a, b, p)
    return s ** (1.0 / p) if p > 1 else s


def _features(batch: pa.RecordBatch | pa.Table, width: int) -> np.ndarray:
    column = batch.column("_x")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _pieces(batch: pa.RecordBatch, width: int, others: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch whose distances to ``others`` rows fit 1 MB, so they stay in the processor's cache."""
    step = max(1, 131_072 // max(1, others))
    for s in range(0, batch.num_rows, step):
        part = batch.slice(s, step)
        yield part, _features(part, width)


def _rows(df: DataFrame, key: str, key_type: str, features: Sequence[str], *more) -> DataFrame:
    """``(_key, ..., _x, _row)`` of the rows that take part, written once."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    whole = F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    written = cut_lineage(df.select(F.col(key).cast(key_type).alias("_key"), *more, x.alias("_x")))
    # filtered after the write: a filter on an array of many aliased columns makes the optimiser try every mixture of their names
    return written.where(whole).withColumn("_row", F.monotonically_increasing_id())


def _near_lists(r: DataFrame, pivots: np.ndarray, p: float, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cell the ``size`` smallest distances of rows with different keys: (cell, distance, key hash), at most pivots x size rows."""
    width = pivots.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[int, float]] = {}
        for batch in batches:
            for part, x in _pieces(batch, width, len(pivots)):
                dist = _metric(x, pivots, p)
                cell = dist.argmin(1)
                near = dist[np.arange(len(cell)), cell]
                keys = part.column("_hash").to_numpy(zero_copy_only=False)
                order = np.lexsort((near, cell))
                place = np.arange(len(order)) - np.searchsorted(cell[order], cell[order])
                # repeated keys may hide others behind them: those beyond the first places count only where no list is full
                for i in order[place < 4 * size]:
                    lst = kept.setdefault(int(cell[i]), {})
                    h, d = int(keys[i]), float(near[i])
                    if d < lst.get(h, math.inf):
                        lst[h] = d
                        if len(lst) > size:
                            del lst[max(lst, key=lst.get)]
        rows = [(c, h, d) for c, lst in kept.items() for h, d in lst.items()]
        cols = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["cell", "h", "d"])

    cells = r.select(F.xxhash64("_key").alias("_hash"), "_x").mapInArrow(local, "cell int, h long, d double")
    best = cells.groupBy("cell", "h").agg(F.min("d").alias("d"))
    top = best.withColumn("_n", F.row_number().over(Window.partitionBy("cell").orderBy("d", "h"))).where(F.col("_n") <= size)
    t = top.select("cell", "d", "h").toPandas()
    return t["cell"].to_numpy(dtype=int), t["d"].to_numpy(dtype=float), t["h"].to_numpy(dtype=np.int64)


def _query_cells(q: DataFrame, pivots: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of queries and radius of every cell."""
    width, m = pivots.shape[1], len(pivots)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, u = np.zeros(m, dtype=np.int64), np.zeros(m)
        for batch in batches:
            for _, x in _pieces(batch, width, m):
                dist = _metric(x, pivots, p)
                cell = dist.argmin(1)
                n += np.bincount(cell, minlength=m)
                np.maximum.at(u, cell, dist[np.arange(len(cell)), cell])
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at]), pa.array(u[at])], ["cell", "n", "u"])

    t = q.select("_x").mapInArrow(local, "cell int, n long, u double").groupBy("cell").agg(F.sum("n").alias("n"), F.max("u").alias("u")).toPandas()
    n, u = np.zeros(m, dtype=np.int64), np.zeros(m)
    n[t["cell"].to_numpy(dtype=int)] = t["n"]
    u[t["cell"].to_numpy(dtype=int)] = t["u"]
    return n, u


def _bounds(between: np.ndarray, n: np.ndarray, u: np.ndarray, near: tuple[np.ndarray, np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """Reach ``u_i + theta_i`` of every cell with queries, -1 for the others."""
    cell, dist, keys = near
    reach = np.full(len(n), -1.0)
    for i in np.flatnonzero(n):
        upper = between[i][cell] + dist
        order = np.argsort(upper, kind="stable")
        _, first = np.unique(keys[order], return_index=True)  # places of the first row of every key
        theta = u[i] + upper[order[np.sort(first)[size - 1]]] if len(first) >= size else math.inf
        reach[i] = (u[i] + theta) * (1 + SLACK)
    return reach


def _chain(between: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Pivots that have queries, each followed by the nearest one left."""
    left = n > 0
    order = []
    at = int(np.argmax(left))
    while left.any():
        at = int(np.argmin(np.where(left, between[at], np.inf))) if order else at
        if not left[at]:
            at = int(np.argmax(left))  # distances beyond the number range
        left[at] = False
        order.append(at)
    return np.array(order, dtype=int)


def _groups(n: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First pivot of every group, and its number of queries, for pivots in chain order."""
    starts, sizes = [], []
    for i, c in enumerate(n):
        if not starts or sizes[-1] + c > block_rows:
            starts.append(i)
            sizes.append(0)
        sizes[-1] += int(c)
    return np.array(starts, dtype=int), np.array(sizes, dtype=np.int64)


def _reached(x: np.ndarray, plan: KnnPlan, p: float) -> np.ndarray:
    """rows x groups: does the row have to be compared with the group's queries?"""
    return np.logical_or.reduceat(_metric(x, plan.pivots, p) <= plan.reach, plan.starts, axis=1)


def _reached_counts(r: DataFrame, plan: KnnPlan, p: float) -> np.ndarray:
    width, g = plan.pivots.shape[1], len(plan.starts)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(g, dtype=np.int64)
        for batch in batches:
            for _, x in _pieces(batch, width, len(plan.pivots)):
                n += _reached(x, plan, p).sum(0)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["g", "n"])

    out = np.zeros(g, dtype=np.int64)
    for row in r.select("_x").mapInArrow(local, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        out[row["g"]] = row["n"]
    return out


def plan_join(q: DataFrame, r: DataFrame, k: int, p: float, exclude_self: bool, block_rows: int, max_pivots: int = MAX_PIVOTS) -> KnnPlan | None:
    """Pivots, bounds and blocks of the join of prepared queries and rows; None if a side is empty."""
    rows = r.count()
    if not rows:
        return None
    m = min(max_pivots, max(1, math.ceil(math.sqrt(rows))))
    drawn = r.select("_x").orderBy(F.xxhash64("_x", "_key"), "_x").limit(m).collect()
    pivots = np.unique(np.array([row["_x"] for row in drawn], dtype=float), axis=0)
    n, u = _query_cells(q, pivots, p)
    if not n.any():
        return None
    between = _metric(pivots, pivots, p)
    size = k + int(exclude_self)
    reach = _bounds(between, n, u, _near_lists(r, pivots, p, size), size)
    order = _chain(between, n)
    starts, sizes = _groups(n[order], block_rows)
    group_of = np.full(len(pivots), -1)
    group_of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    plan = KnnPlan(pivots, group_of, pivots[order], reach[order], starts, -(-sizes // block_rows), np.ones(len(starts), dtype=np.int64), rows)
    reached = _reached_counts(r, plan, p)
    plan.row_blocks = np.maximum(1, -(-reached // block_rows))
    plan.copies = int((reached * plan.query_blocks).sum())
    return plan


def _deal(df: DataFrame, plan: KnnPlan, p: float, is_query: bool) -> DataFrame:
    """Copies of the rows with the group ``_g``, the query block ``_i`` and the row block ``_j`` they are compared in."""
    width = plan.cells.shape[1]
    own, other = (plan.query_blocks, plan.row_blocks) if is_query else (plan.row_blocks, plan.query_blocks)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _pieces(batch, width, len(plan.cells)):
                if is_query:
                    at, g = np.arange(len(x)), plan.group_of[_metric(x, plan.cells, p).argmin(1)]
                else:
                    at, g = np.nonzero(_reached(x, plan, p))
                ends = np.cumsum(other[g])
                ids = part.column("_row").to_numpy(zero_copy_only=False)
                for s in range(0, int(ends[-1]) if len(ends) else 0, _OUT_ROWS):
                    out = np.arange(s, min(s + _OUT_ROWS, ends[-1]))
                    w = np.searchsorted(ends, out, side="right")
                    across = out - (ends[w] - other[g[w]])
                    mine = ids[at[w]] % own[g[w]]
                    i, j = (mine, across) if is_query else (across, mine)
                    yield pa.RecordBatch.from_arrays([pa.array(g[w], pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), *part.take(pa.array(at[w])).columns],
                                                     ["_g", "_i", "_j", *part.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(local, f"_g int, _i int, _j int, {fields}")


def _screen(qx: np.ndarray, rx: np.ndarray, p: float) -> tuple[Callable, Callable, int]:
    """(matrix of single-precision values of queries lo..hi x rows s..t, the value above which a pair's sum surely exceeds a bound, queries at once).

    Rows are centred and scaled to [-1, 1]; limits are widened by more than all roundings can come to, so nothing within the bound is missed.
    Order 2 is one matrix product; where single precision doesn't serve, the values are the exact sums.
    """
    width = qx.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        centre = rx.mean(0)
        q, r = qx - centre, rx - centre
        top = max(float(np.abs(q).max()), float(np.abs(r).max()))
        power = top ** p if top > 0 else 1.0
    if p not in (1, 2, 3, 4) or not math.isfinite(top) or not 1e-250 < power < 1e250:
        return lambda lo, hi, s, t: _sums(qx[lo:hi], rx[s:t], p), lambda bound, lo, hi: bound, 64
    scale = top or 1.0
    shift = 2.0 ** -52 * max(float(np.abs(qx).max()), float(np.abs(rx).max())) / scale  # by centring, per component
    q, r = (q / scale).astype(np.float32), np.ascontiguousarray((r / scale).T, np.float32)
    if p == 2:
        share = (width + 32) * 2.0 ** -23
        own, other = ((x.astype(float) ** 2).sum(axis) * (1 - share) for x, axis in ((q, 1), (r, 0)))
        a, b = np.hstack([-2 * q, np.ones((len(q), 1), np.float32)]), np.vstack([r, other.astype(np.float32)[None, :]])
        slack = 16 * width * shift + 1e-30

        def product(lo: int, hi: int, s: int, t: int) -> np.ndarray:
            return a[lo:hi] @ b[:, s:t]

        return product, lambda bound, lo, hi: np.nextafter((bound / power * (1 + SLACK) - own[lo:hi] + slack).astype(np.float32), np.float32(np.inf)), 256
    slack = width * 2.0 ** p * ((4 * p + width) * 2.0 ** -23 + 4 * p * shift) + 1e-30

    def sums(lo: int, hi: int, s: int, t: int) -> np.ndarray:
        acc, diff = np.zeros((hi - lo, t - s), np.float32), np.empty((hi - lo, t - s), np.float32)
        for d in range(width):
            np.subtract(q[lo:hi, d, None], r[d, None, s:t], out=diff)
            np.abs(diff, out=diff)
            if p > 1:
                cube = diff * diff
                diff = cube * diff if p == 3 else cube * cube
            acc += diff
        return acc

    return sums, lambda bound, lo, hi: np.nextafter((bound / power * (1 + SLACK) + slack).astype(np.float32), np.float32(np.inf)), 64


def _pair_sums(qx: np.ndarray, rx: np.ndarray, i: np.ndarray, j: np.ndarray, p: float) -> np.ndarray:
    """``_sums`` of single pairs, bit by bit."""
    acc = np.zeros(len(i))
    for s in range(0, len(i), 65536):
        diff = np.ascontiguousarray((qx[i[s:s + 65536]] - rx[j[s:s + 65536]]).T)
        diff = diff * diff if p == 2 else np.abs(diff) ** p
        for row in diff:
            acc[s:s + 65536] += row
    return acc


def _merge(best: np.ndarray, at: np.ndarray, i: np.ndarray, dist: np.ndarray, j: np.ndarray) -> None:
    """Put candidates (query i, row j) into the queries' lists, ties to the earlier place."""
    k, rows = best.shape[1], np.unique(i)
    ii, dd, jj = np.concatenate([np.repeat(rows, k), i]), np.concatenate([best[rows].ravel(), dist]), np.concatenate([at[rows].ravel(), j])
    order = np.lexsort((jj, dd, ii))
    sorted_i = ii[order]
    keep = order[np.arange(len(order)) - np.searchsorted(sorted_i, sorted_i) < k]
    best[rows], at[rows] = dd[keep].reshape(-1, k), jj[keep].reshape(-1, k)


def _k_nearest(qx: np.ndarray, rx: np.ndarray, k: int, p: float, codes: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and places of each query's k nearest rows (infinity and -1 where there are fewer), ties to the earlier place.

    Rows come in tiles; a pair gets its exact sum if its single-precision value doesn't exceed the query's k-th smallest sum so far.
    Pairs of equal ``codes`` (of queries and rows) from 0 on don't count.
    """
    best, at = np.full((len(qx), k), np.inf), np.full((len(qx), k), -1)
    if not len(qx) or not len(rx):
        return best, at
    value, limit, step = _screen(qx, rx, p)

    def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        dist = _pair_sums(qx, rx, i, j, p)
        if codes is not None:
            mine = codes[0][i]
            dist[(mine == codes[1][j]) & (mine >= 0)] = np.inf
        return dist

    for lo in range(0, len(qx), step):
        hi = min(lo + step, len(qx))
        s, tile, bound = 0, 256, np.full(hi - lo, np.inf)
        while s < len(rx):
            t = min(s + tile, len(rx))
            found = value(lo, hi, s, t)
            m = k + (codes is not None)
            if s == 0 and m < t:  # any k rows bound the k-th smallest sum
                some = np.argpartition(found, m - 1, axis=1)[:, :m]
                first = exact(np.repeat(np.arange(lo, hi), m), some.ravel()).reshape(-1, m)
                bound = np.partition(first, k - 1, axis=1)[:, k - 1]
            i, j = np.divmod(np.flatnonzero(found <= limit(bound, lo, hi)[:, None]), t - s)
            i, j = i + lo, j + s
            dist = exact(i, j)
            ok = (dist <= bound[i - lo]) & (dist < np.inf)
            if ok.any():
                _merge(best, at, i[ok], dist[ok], j[ok])
                bound = np.minimum(bound, best[lo:hi, -1])
            s, tile = t, min(2 * tile, 2048)
    return best, at


def _needed(dist: np.ndarray, part: np.ndarray, parts: Sequence[int], k: int) -> np.ndarray:
    """Which of the sorted candidates of each query are among its k nearest when some part, not their own, is left out."""
    place = np.arange(dist.shape[1])
    need = np.broadcast_to(place < k, dist.shape).copy()
    for v in parts:
        own = part == v
        need |= ~own & (place[None, :] - (np.cumsum(own, axis=1) - own) < k)
    return need & np.isfinite(dist)


def _sides(rows: int, width: int) -> int:
    """Rows of a block: an eighth of all, within 2,048 and what 16 MB hold."""
    return int(min(max(2048, -(-rows // 8)), max(2048, BLOCK_BYTES // (8 * max(1, width)))))


def _plan(q: DataFrame, r: DataFrame, k: int, p: float, exclude_self: bool, block_rows: int | None, max_pivots: int, width: int) -> KnnPlan | None:
    """The plan with blocks of ``block_rows``; by default small ones, or large ones where the bounds exclude little and copies would pile up."""
    if block_rows is not None:
        return plan_join(q, r, k, p, exclude_self, block_rows, max_pivots)
    plan = plan_join(q, r, k, p, exclude_self, 2048, max_pivots)
    if plan is not None and plan.copies_per_row > MAX_COPIES:
        return plan_join(q, r, k, p, exclude_self, _sides(plan.rows, width), max_pivots)
    return plan


def _joined(queries: DataFrame, reference: DataFrame, key: str, features: Sequence[str], label: str, k: int, p: float, exclude_self: bool, block_rows: int | None,
            max_pivots: int, part: str | None, parts: Sequence[int]) -> tuple[DataFrame | None, str]:
    """``(_q, q_key, r_key, dist, r_label, r_part)``: per pair of blocks the neighbours that can be among the k nearest (None if a side is empty), and the key's type."""
    if not 0 < p < math.inf:
        raise ValueError(f"order p must be positive and finite: {p}")
    width = len(features)
    key_type = queries.schema[key].dataType.simpleString()
    group = F.lit(None).cast("int") if part is None else F.col(part).cast("int")
    r = _rows(reference, key, key_type, features, F.col(label).cast("double").alias("_label"), group.alias("_part"))
    q = r.drop("_label", "_part") if queries is reference else _rows(queries, key, key_type, features)
    # a list that lacks any one part is as long as the lists of the rest: bounds must hold for the k nearest of these
    plan = _plan(q, r, k, p, exclude_self, block_rows, max_pivots, width) if part is None else _plan_without(q, r, k, p, exclude_self, block_rows, max_pivots, width, parts)
    if plan is None:
        return None, key_type

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["_q", "q_key", "r_key", "dist", "r_label", "r_part"]
        right = right.take(pc.sort_indices(right, sort_keys=[("_key", "ascending"), ("_row", "ascending")]))  # ties to the smaller key
        codes = None
        if exclude_self:
            both = pa.chunked_array(left.column("_key").chunks + right.column("_key").chunks, left.column("_key").type).combine_chunks().dictionary_encode().indices
            both = both.fill_null(-1).to_numpy(zero_copy_only=False)
            codes = both[:left.num_rows], both[left.num_rows:]
        qx, rx = _features(left, width), _features(right, width)
        if part is None:
            best, at = _k_nearest(qx, rx, k, p, codes)
            need = np.isfinite(best)
        else:
            member = right.column("_part").combine_chunks().fill_null(min([0, *parts]) - 1).to_numpy(zero_copy_only=False)
            lists = []
            for v in np.unique(member):
                here = np.flatnonzero(member == v)
                found, j = _k_nearest(qx, rx[here], k, p, codes and (codes[0], codes[1][here]))
                lists.append((found, np.where(j >= 0, here[j], -1)))
            best, at = (np.concatenate([x[n] for x in lists], axis=1) if lists else np.zeros((len(qx), 0), t) for n, t in ((0, float), (1, int)))
            order = np.lexsort((at, best), axis=1)
            best, at = np.take_along_axis(best, order, 1), np.take_along_axis(at, order, 1)
            need = _needed(best, member[at] if len(member) else at, parts, k)
        rows, cols = np.nonzero(need)
        i, j = pa.array(rows), pa.array(at[rows, cols])
        return pa.table([left.column("_row").take(i), left.column("_key").take(i), right.column("_key").take(j), pa.array(best[rows, cols] ** (1.0 / p)), right.column("_label").take(j),
                         right.column("_part").take(j)], names=names)

    cells = ["_g", "_i", "_j"]
    schema = f"_q long, q_key {key_type}, r_key {key_type}, dist double, r_label double, r_part int"
    return _deal(q, plan, p, True).groupBy(*cells).cogroup(_deal(r, plan, p, False).groupBy(*cells)).applyInArrow(block, schema), key_type


def _plan_without(q: DataFrame, r: DataFrame, k: int, p: float, exclude_self: bool, block_rows: int | None, max_pivots: int, width: int, parts: Sequence[int]) -> KnnPlan | None:
    """The plan whose bounds hold whichever part is left out: the widest reach of all."""
    plan = _plan(q, r, k, p, exclude_self, block_rows, max_pivots, width)
    if plan is None or (len(plan.starts) == 1 and plan.row_blocks[0] * plan.query_blocks[0] == 1):
        return plan
    between = _metric(plan.cells, plan.cells, p)
    n, u = _query_cells(q, plan.cells, p)
    size = k + int(exclude_self)
    reach = np.full(len(plan.cells), -1.0)
    for v in parts:
        rest = r.where(~F.col("_part").eqNullSafe(F.lit(int(v))))
        reach = np.maximum(reach, _bounds(between, n, u, _near_lists(rest, plan.cells, p, size), size))
    used = {tuple(x): i for i, x in enumerate(plan.cells)}
    order = np.array([used[tuple(x)] for x in plan.pivots])
    plan.reach = np.maximum(plan.reach, reach[order])
    reached = _reached_counts(r, plan, p)
    side = block_rows or (2048 if plan.copies_per_row <= MAX_COPIES and len(plan.starts) > 1 else _sides(plan.rows, width))
    plan.row_blocks = np.maximum(1, -(-reached // side))
    plan.copies = int((reached * plan.query_blocks).sum())
    return plan


def knn_neighbours(queries: DataFrame, reference: DataFrame, key: str, features: Sequence[str], label: str,
                   k: int = 5, p: float = 2.0, exclude_self: bool = False, block_rows: int | None = None, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``(q_key, r_key, dist, r_label, rank)``: the k nearest reference rows of every query
    (Minkowski distance of order p, ties broken by reference key)."""
    near, key_type = _joined(queries, reference, key, features, label, k, p, exclude_self, block_rows, max_pivots, None, ())
    if near is None:
        return queries.sparkSession.createDataFrame([], f"q_key {key_type}, r_key {key_type}, dist double, r_label double, rank int")
    w = Window.partitionBy("_q").orderBy("dist", F.col("r_key").asc_nulls_last())  # at most k candidates a block of rows
    return near.drop("r_part").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("_q")


def knn_neighbours_without(queries: DataFrame, reference: DataFrame, key: str, features: Sequence[str], label: str, part: str, parts: Sequence[int],
                           k: int = 5, p: float = 2.0, exclude_self: bool = False, block_rows: int | None = None, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``(without, q_key, r_key, dist, r_label, rank)``: the k nearest of all reference rows (``without`` is null) and of those outside each of ``parts``.

    All lists come from one join: a neighbour outside a part is among the k nearest of its own part.
    """
    near, key_type = _joined(queries, reference, key, features, label, k, p, exclude_self, block_rows, max_pivots, part, [int(v) for v in parts])
    if near is None:
        return queries.sparkSession.createDataFrame([], f"without int, q_key {key_type}, r_key {key_type}, dist double, r_label double, rank int")
    found = F.sort_array(F.collect_list(F.struct("dist", F.col("r_key").isNull().alias("_last"), "r_key", "r_label", "r_part")))
    lists = near.groupBy("_q").agg(F.first("q_key").alias("q_key"), found.alias("_near"))
    each = F.array(F.lit(None).cast("int"), *[F.lit(int(v)) for v in parts])
    lists = lists.select("q_key", "_near", F.explode(each).alias("without"))
    left = F.filter("_near", lambda x: F.col("without").isNull() | ~x["r_part"].eqNullSafe(F.col("without")))
    rows = lists.select("without", "q_key", F.posexplode(F.slice(left, 1, k)).alias("_n", "_r"))
    return rows.select("without", "q_key", "_r.r_key", "_r.dist", "_r.r_label", (F.col("_n") + 1).alias("rank"))


def knn_vote(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """``(q_key, pred)``: majority (or 1/distance weighted) vote; ties to the smaller label.
    With distance weights an exact match (distance 0) outvotes everything else."""
    if weights == "uniform":
        w = F.lit(1.0)
    elif weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("q_key"))
        w = F.when(has_zero == 1, (F.col("dist") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("dist"))
    else:
        raise ValueError(weights)
    votes = neighbours.withColumn("_w", w).groupBy("q_key", "r_label").agg(F.sum("_w").alias("_score"))
    best = votes.groupBy("q_key").agg(F.max(F.struct(F.col("_score").alias("s"), (-F.col("r_label")).alias("nl"))).alias("_b"))
    return best.select("q_key", (-F.col("_b")["nl"]).cast("int").alias("pred"))
