"""Hard negatives by shared candidate lists of anchor clusters (the MAXIMUS search).

An anchor's positives are the best rows of its own label; the hard negatives of a positive are the best rows of other labels
whose score lies between ``low`` and ``high`` per cent of the positive's score. Scores are integer inner products of
``floor(scale * x)``.

1. Anchors are clustered by angle around pivots, a bounded hash sample of them. A cluster's cone is the largest angle of a member.
2. For a cluster with pivot p and cone t, a candidate x at the angle f from p scores at most |a| |x| cos(max(0, f - t)) with any
   member a. The bound without |a| is the same for all members, so candidates are sorted by it once, for the whole cluster.
3. Seeds: the first candidates of each list with a member's label give the member a lower bound of its last positive's score, and
   with ``low`` one of its negatives' scores. A list is kept as far as some member may have to walk.
4. Walks: lists are dealt in blocks. Every member walks each block from the largest bound on and stops where |a| times the bound
   falls below the worst score that it still needs: its results are certified. The first walk finds positives, the second negatives.

Equal rows are handled once. Of rows with equal vector and label only the smallest ids can be among an anchor's first; these are kept, by a
limited window. Anchors with equal vector and label walk as one. So a vector that a third of all rows have is neither a hot
group nor a list of ties. Bounds are widened by their rounding error, so no result depends on them. Only pivots (at most MAX_CLUSTERS)
and one cone and reach for each reach the driver.

Defined results: a null id, null label, or a null vector or one with null or non-finite components takes no part; a shorter vector
counts as padded with zeros, an empty one as zero; ties go to the smaller id; rows with equal id, label and vector are one row, other rows with an equal id are
rows of their own; an anchor is never its own positive; an anchor without positives, or a positive without negatives in its
range, returns no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.llm.common import staged
from sparkqc.llm.vectors import groups, matrix, pivots, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
MAX_CLUSTERS = 1024
MEMBER_BLOCK = 1024
LIST_BLOCK = 8192
STEP = 256
EXACT = 2 ** 53


def _whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, int]:
    """Distinct ``(id, label, v)`` in the smallest integer type that holds all components, and the dimension."""
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    dim, low, high = rows.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    most = max(abs(low or 0), abs(high or 0))
    kind = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint"
    return rows.withColumn("v", F.col("v").cast(f"array<{kind}>")).groupBy("id", "label", "v").agg(F.lit(1).alias("_")).drop("_"), int(dim or 0)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.sqrt((x * x).sum(1))
    return x / np.where(length > 0, length, 1)[:, None], length


def _angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1, 1))


def _cluster(members: DataFrame, centres: np.ndarray, dim: int) -> DataFrame:
    """``members`` with their ``cluster`` and the ``angle`` to its pivot."""
    shared = members.sparkSession.sparkContext.broadcast(centres)
    kind = members.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, length = _unit(matrix(batch.column("v"), dim).astype(float))
            angle = np.where(length[:, None] > 0, _angles(unit, shared.value), 0.0)  # a zero vector scores 0 everywhere
            own = angle.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("label"), batch.column("v"), pa.array(own, pa.int64()), pa.array(angle[np.arange(len(own)), own])],
                                             names=["cls", "label", "v", "cluster", "angle"])

    return members.select("cls", "label", "v").mapInArrow(run, f"cls string, label string, v {kind}, cluster long, angle double")


def _bounds(candidates: DataFrame, centres: np.ndarray, cones: dict[int, float], dim: int, reach: dict[int, float] | None, first: int = 0) -> DataFrame:
    """``(cluster, bound, id, label, v)``: entries of the clusters' lists, as far as ``reach``; or, of each batch, the ``first`` of each
    cluster and label."""
    shared = candidates.sparkSession.sparkContext.broadcast((centres, cones, reach))
    kind = candidates.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, cone, upto = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                unit, length = _unit(matrix(part.column("v"), dim).astype(float))
                angle = _angles(unit, c)
                labels = np.array(part.column("label").to_pylist(), object) if upto is None else None
                for cluster, wide in cone.items():
                    bound = length * np.cos(np.maximum(0, angle[:, cluster] - wide - 1e-7))
                    if upto is not None:
                        rows = np.flatnonzero(bound >= upto[cluster])
                    else:
                        by = np.lexsort((-bound, labels.astype(str)))
                        group = labels[by].astype(str)
                        start = np.ones(len(by), bool)
                        start[1:] = group[1:] != group[:-1]
                        place = np.arange(len(by)) - np.maximum.accumulate(np.where(start, np.arange(len(by)), 0))
                        rows = by[place < first]
                    if len(rows):
                        take = pa.array(rows)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), cluster), pa.int64()), pa.array(bound[rows]), *(part.column(n).take(take) for n in ("id", "label", "v"))],
                                                         names=["cluster", "bound", "id", "label", "v"])

    return candidates.select("id", "label", "v").mapInArrow(run, f"cluster long, bound double, id long, label string, v {kind}")


def _walk(asks: DataFrame, lists: DataFrame, k: int, low: int, high: int, dim: int, member_block: int, list_block: int) -> DataFrame:
    """``(cls, target, id, score, twin)``: for every ask of a member its ``k`` best in each block, ties to the smaller id.

    ``asks`` (cls, label, v, cluster, worst, target): with a null target, rows of the own label count; else rows of other labels that score
    between ``low`` and ``high`` per cent of it. No result scores below ``worst``. ``twin``: vector and label are the member's own.
    """
    def solve(rows: pa.Table) -> pa.RecordBatch | None:
        is_ask = rows.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        if is_ask.all() or not is_ask.any():
            return None
        labels = rows.column("label").to_numpy(zero_copy_only=False)
        v = matrix(rows.column("v"), dim).astype(np.int64)
        ids, bound = rows.column("id").to_numpy(zero_copy_only=False), rows.column("bound").to_numpy()
        q, x = np.flatnonzero(is_ask), np.flatnonzero(~is_ask)
        x = x[np.argsort(-bound[x], kind="stable")]
        asked = [t.as_py() for t in rows.column("target").take(pa.array(q))]
        wants_own = np.array([t is None for t in asked])
        target = [t or 0 for t in asked]
        worst = bound[q]  # asks carry their worst score there
        most = float(np.abs(v).max(initial=0)) ** 2 * max(1, dim)
        small = most * 100 * (list_block + 1) < EXACT and max(map(abs, target)) * 100 < EXACT
        kind = np.int64 if small else object
        place = np.empty(len(x), kind)
        place[np.argsort(ids[x], kind="stable")] = len(x) - 1 - np.arange(len(x))
        a = v[q].astype(float) if most < EXACT else v[q].astype(object)
        c = v[x].astype(float) if most < EXACT else v[x].astype(object)
        length = np.sqrt((v[q].astype(float) ** 2).sum(1))
        goal = np.array(target, kind)
        never = -(1 << 62) if small else -(1 << 200)
        best = np.full((len(q), k), never, kind)
        going = np.arange(len(q))
        for at in range(0, len(x), STEP):
            need = np.maximum(worst[going], np.where(best[going, -1] == never, -np.inf, (best[going, -1] // len(x)).astype(float)))
            going = going[length[going] * bound[x[at]] * (1 + 1e-9) + 1e-6 >= need]
            if not len(going):
                break
            step = x[at:at + STEP]
            score = (a[going] @ c[at:at + STEP].T).astype(kind)
            same = labels[q[going]][:, None] == labels[step][None, :]
            full = score * 100
            fits = np.where(wants_own[going][:, None], same, ~same & (full >= goal[going][:, None] * low) & (full <= goal[going][:, None] * high))
            keys = np.where(fits, score * len(x) + place[at:at + STEP][None, :], never)
            both = np.concatenate([best[going], keys], 1)
            best[going] = -np.sort(-both, axis=1)[:, :k] if not small else -np.sort(np.partition(-both, k - 1, axis=1)[:, :k], axis=1)
        r, n = np.nonzero(best != never)
        if not len(r):
            return None
        found = best[r, n]
        by_place = np.empty(len(x), np.int64)
        by_place[place.astype(np.int64)] = x
        hit = by_place[(found % len(x)).astype(np.int64)]
        score = [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in found // len(x)]
        twin = (v[q[r]] == v[hit]).all(1) & wants_own[r]
        ask = pa.array(q[r])
        return pa.RecordBatch.from_arrays([rows.column("cls").take(ask).combine_chunks(), rows.column("target").take(ask).combine_chunks(), pa.array(ids[hit].astype(np.int64)), pa.array(score, pa.int64()), pa.array(twin)],
                                          names=["cls", "target", "id", "score", "twin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cluster", "mb", "lb"]):
            if (out := solve(group)) is not None:
                yield out

    blocks = lambda n, size: F.ceil(n / F.lit(size)).cast("long")
    plan = asks.groupBy("cluster").agg(blocks(F.count(F.lit(1)), member_block).alias("mbs")).join(
        lists.groupBy("cluster").agg(blocks(F.count(F.lit(1)), list_block).alias("lbs")), "cluster")
    plan = F.broadcast(plan)  # a row for each of at most MAX_CLUSTERS clusters
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    q_rows = asks.join(plan, "cluster").select("cluster", F.pmod(F.xxhash64("cls"), F.col("mbs")).alias("mb"), upto(F.col("lbs")).alias("lb"),
                                               F.lit(0).cast("long").alias("id"), "label", "v", F.col("worst").alias("bound"), F.lit(True).alias("ask"), "cls", "target")
    x_rows = lists.join(plan, "cluster").select("cluster", upto(F.col("mbs")).alias("mb"), F.pmod(F.xxhash64("id", "label"), F.col("lbs")).alias("lb"),
                                                "id", "label", "v", "bound", F.lit(False).alias("ask"), F.lit(None).cast("string").alias("cls"), F.lit(None).cast("long").alias("target"))
    dealt = q_rows.unionByName(x_rows).repartition("cluster", "mb", "lb").sortWithinPartitions("cluster", "mb", "lb", "ask", F.desc("bound"))
    return dealt.mapInArrow(run, "cls string, target long, id long, score long, twin boolean")


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, clusters: int | None = None, member_block: int = MEMBER_BLOCK, list_block: int = LIST_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; ``is_anchor`` is a condition on ``id``.

    ``clusters`` defaults to a quarter of the square root of the number of distinct anchors.
    """
    whole, dim = _whole_vectors(vectors, id_col, vector_col, label_col, scale)
    whole = staged(whole, "hard-rows")
    smallest = Window.partitionBy("v", "label").orderBy("id")
    candidates = staged(whole.withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= max(positives + 1, negatives)).drop("_n"), "hard-candidates")
    anchors = whole.where(is_anchor)
    classes = staged(anchors.groupBy("v", "label").agg(F.min("id").alias("_id")).select(F.concat_ws(":", "_id", F.xxhash64("label", "v")).alias("cls"), "label", "v", "_id"), "hard-classes")
    n = classes.count()
    centres = pivots(classes.where(F.exists("v", lambda x: x != 0)), "_id", "v", min(MAX_CLUSTERS, clusters or max(1, round(n ** 0.5 / 4))), dim, 13)
    centres = _unit(centres)[0] if len(centres) else np.zeros((1, dim))
    members = staged(_cluster(classes, centres, dim), "hard-members")
    cones = {r["cluster"]: r["cone"] for r in members.groupBy("cluster").agg(F.max("angle").alias("cone")).collect()}  # one row per cluster

    # lower bounds of the last positive's score, from the first entries of the lists
    best = Window.partitionBy("cluster", "label").orderBy(F.desc("bound"), "id")
    seeds = _bounds(candidates, centres, cones, dim, None, 2 * (positives + 1)).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= 2 * (positives + 1))
    seeds = seeds.select(F.col("cluster").alias("_c"), F.col("label").alias("_l"), F.col("v").alias("_v"))
    product = F.aggregate(F.zip_with("v", "_v", lambda x, y: F.coalesce(x, F.lit(0)).cast("double") * F.coalesce(y, F.lit(0)).cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = members.join(seeds, (F.col("cluster") == F.col("_c")) & (F.col("label") == F.col("_l"))).select("cls", product.alias("s"))
    # of positives + 1 seeds one may be the anchor itself
    known = scored.groupBy("cls").agg(F.reverse(F.array_sort(F.collect_list("s"))).alias("s"))
    edge = F.get("s", F.lit(positives))
    known = known.select(F.col("cls").alias("_cls"), (edge - 1e-9 * F.abs(edge) - 1e-6).alias("_worst"))
    asks = members.join(known, F.col("cls") == F.col("_cls"), "left").select("cls", "label", "v", "cluster", F.coalesce("_worst", F.lit(float("-inf"))).alias("worst"))
    asks = staged(asks, "hard-asks")

    # how far the lists are kept: down to the worst score that any member can need
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    needed = F.least(F.col("worst"), F.col("worst") * (low / 100)) / length
    reach = {r["cluster"]: (-np.inf if r["reach"] is None else r["reach"] * (1 - np.sign(r["reach"]) * 1e-9) - 1e-6)
             for r in asks.groupBy("cluster").agg(F.min(F.when(length > 0, needed)).alias("reach")).collect()}  # one row per cluster
    zero = [r["cluster"] for r in asks.where(length == 0).select("cluster").distinct().collect()]
    reach.update(dict.fromkeys(zero, -np.inf))
    lists = staged(_bounds(candidates, centres, cones, dim, reach), "hard-lists")

    walked = _walk(asks.withColumn("target", F.lit(None).cast("long")), lists, positives + 1, low, high, dim, member_block, list_block)
    order = Window.partitionBy("cls").orderBy(F.desc("score"), "id", F.desc("twin"))
    firsts = staged(walked.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= positives + 1), "hard-positives")
    named = anchors.select(F.col("id").alias("anchor_id"), F.col("label").alias("_l"), F.col("v").alias("_v"))
    named = classes.join(named, (F.col("label") == F.col("_l")) & (F.col("v") == F.col("_v"))).select("cls", "anchor_id")
    others = named.join(firsts, "cls").where(~(F.col("twin") & (F.col("anchor_id") == F.col("id"))))
    kept = Window.partitionBy("cls", "anchor_id").orderBy("_n")
    pairs = staged(others.withColumn("_p", F.row_number().over(kept)).where(F.col("_p") <= positives).select(
        "cls", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("_n").alias("_place")), "hard-pairs")

    targets = pairs.select(F.col("cls").alias("_cls"), F.col("positive_score").alias("target")).distinct().where("target >= 0")  # below 0 no score fits
    asks = asks.drop("worst").join(targets, F.col("cls") == F.col("_cls")).select("cls", "label", "v", "cluster", (F.col("target").cast("double") * (low / 100) - 1e-6).alias("worst"), "target")
    walked = _walk(staged(asks, "hard-asks"), lists, negatives, low, high, dim, member_block, list_block)
    order = Window.partitionBy("cls", "target").orderBy(F.desc("score"), "id")
    ranked = walked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ranked = ranked.select(F.col("cls").alias("_cls"), "target", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(ranked, (F.col("cls") == F.col("_cls")) & (F.col("positive_score") == F.col("target"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_label(label: Column, id_: Column, every: int = 7, labels: int = 10) -> Column:
    """The test's label noise: every so many ids, the next label."""
    return F.when(id_ % every == 0, (label + 1) % labels).otherwise(label)


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id AS other, a.label = x.label AS same, CAST(list_dot_product(CAST(a.e AS DOUBLE[]), CAST(x.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""
