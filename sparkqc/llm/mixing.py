"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets. Sources in code point order (null last) weigh 5, 2, 1 and so on; they share ``share`` times all words
   by weight; no target exceeds ``most`` times its source's words, and what lies above goes to the others by weight
   until none is above.
2. Streams. A source's documents stand in the order of a hash; passing over them again and again gives an endless stream of
   words. A document's copy in a pass belongs to the mix if the middle of its words lies before the target. So
   the words taken differ from the target by at most half a document, and no document is taken more than ``most`` times.
3. Quotas. The stream up to the target is cut into blocks of equal words; a source's number of blocks follows its
   target, at least one.
4. Splitting tree. All blocks start in one node. Each level draws, without replacement, half of a node's blocks for its
   left child and leaves the rest to the right one: a multivariate hypergeometric split of the node's source
   quotas, exact at every node. The leaves are the output shards.
5. A shard holds its blocks' copies in the order of a hash: a local shuffle.

All draws are hashes of ids and the seed, so reruns agree. Running sums over a source come from range-dealt
slices, so a source with a third of all rows is not one task.

Defined results: sizes count the words of the whole text, 0 for null; a source without words has target 0 and takes
nothing; equal hashes are ordered by id, then by size; repeated rows are documents of their own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import staged
from sparkqc.operators.ranking import cumulative_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 7
SPLITS = 3  # 2 ** SPLITS output shards
BLOCKS_PER_SHARD = 64


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\t\\n\\v\\f\\r; 0 for null.

    Single spaces, the usual case, are counted by length; only texts with several in a row need the pattern.
    """
    flat = text
    for c in "\t\n\x0b\f\r":
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    flat = F.btrim(flat, F.lit(" "))
    single = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit(""))) + 1
    return F.coalesce(
        F.when(flat == "", F.lit(0)).when(F.contains(flat, F.lit("  ")), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).otherwise(single),
        F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """``(_row, id, source, size)``: ``_row`` tells repeated rows apart; it is ``row_col``, a number of each row, if that is given."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), row.alias("_row")), "mix-sizes")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, weight, target)``, one row per source."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = cumulative_sums(per_source, [], [F.col("source").isNull(), F.col("source")], out_before="_rank", out_total="_n")
    weighted = staged(ranked.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
                                    .cast("long").alias("weight")), "mix-sources")
    cap = F.col("source_size") * most
    words, = weighted.agg(F.sum("source_size")).first()
    level, free = 0.0, None
    while words:  # each round settles at least one more source at its cap
        capped = F.col("weight") * F.lit(level) >= cap
        fixed, open_weight = weighted.agg(F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if open_weight == free or not open_weight:
            break
        level, free = (share * words - fixed) / open_weight, open_weight
    return weighted.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))


def _draw(seed: int, *cols: str) -> Column:
    """A pseudo-random order that any engine can repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def split_blocks(targeted: DataFrame, splits: int = SPLITS, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """``(source, block, shard)``: the blocks of every source, dealt to the shards by the splitting tree."""
    total = targeted.agg(F.sum("target")).first()[0] or 0.0
    quota = F.greatest(F.lit(1), F.round(F.col("target") / F.lit(total or 1.0) * F.lit(blocks_per_shard << splits))).cast("long")
    blocks = targeted.where("target > 0").select("source", F.explode(F.sequence(F.lit(0).cast("long"), quota - 1)).alias("block")).withColumn("shard", F.lit(0))
    for level in range(splits):
        drawn = cumulative_sums(blocks.withColumn("_h", _draw(seed * 1000 + level, "source", "block")), ["shard"], ["_h", F.col("source").isNull(), "source", "block"])
        blocks = drawn.select("source", "block", (F.col("shard") * 2 + (F.col("cum_before") * 2 >= F.col("group_total")).cast("int")).alias("shard"))
    return blocks


def mix(sized: DataFrame, targeted: DataFrame, most: int = MOST, splits: int = SPLITS, blocks_per_shard: int = BLOCKS_PER_SHARD,
        seed: int = SEED) -> DataFrame:
    """One row per document and copy taken, and one with null ``copy`` for a document that is not taken:
    ``(_row, id, source, size, source_size, target, copy, block, shard, place)``; ``place`` orders a shard."""
    blocks = staged(split_blocks(targeted, splits, blocks_per_shard, seed), "mix-blocks")
    quotas = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("_quota"))
    known = targeted.join(quotas.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "weight")
    placed = cumulative_sums(sized.withColumn("_h", _draw(seed, "id")), ["source"], ["_h", "id", "size", "_row"], weight="size").drop("group_total", "_h")
    rows = placed.join(known.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    middle = lambda p: p * F.col("source_size") + F.col("cum_before") + F.col("size") / 2
    passes = F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda p: (F.col("size") > 0) & (middle(p) < F.col("target")))
    copies = rows.select("_row", "id", "source", "size", "source_size", "target", "_quota", "cum_before", F.explode_outer(passes).alias("copy"))
    block = F.least(F.floor(middle(F.col("copy")) * F.col("_quota") / F.col("target")), F.col("_quota") - 1)
    at = copies.withColumn("block", F.when(F.col("copy").isNotNull(), block)).drop("cum_before", "_quota")
    dealt = at.join(blocks.withColumnsRenamed({"source": "_s", "block": "_b"}),
                    F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left").drop("_s", "_b")
    return dealt.withColumn("place", F.when(F.col("copy").isNotNull(), _draw(seed + 1, "id", "copy", "block")))


def taken(mixed: DataFrame, splits: int = SPLITS) -> DataFrame:
    """One row per document: the words that the shards' blocks hold of it, in all and (``shard_words``) for each shard."""
    found = mixed.groupBy("_row", "id", "size", "source_size", "target").agg(F.collect_list("shard").alias("shards"))
    words = F.transform(F.sequence(F.lit(0), F.lit((1 << splits) - 1)), lambda s: F.col("size") * F.size(F.filter("shards", lambda x: x == s)))
    counted = found.withColumn("shard_words", words)
    return counted.select("id", "size", "source_size", "target", F.aggregate("shard_words", F.lit(0).cast("long"), lambda n, w: n + w).alias("taken"), "shard_words")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
w AS (SELECT source, n, 2 * n AS cap, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s),
c AS (SELECT *, sum(cap) OVER r AS capped, sum(weight) OVER () - sum(weight) OVER r AS free, 1.5 * sum(n) OVER () AS total
      FROM w WINDOW r AS (ORDER BY cap / weight RANGE UNBOUNDED PRECEDING)),
k AS (SELECT coalesce(sum(cap) FILTER (WHERE capped + cap / weight * free <= total), 0) AS fixed,
             sum(weight) FILTER (WHERE NOT capped + cap / weight * free <= total) AS open, max(total) AS total FROM c),
t AS (SELECT source, n, CAST(least(weight * coalesce((total - fixed) / open, 0), cap) AS DOUBLE) AS target FROM w, k),
p AS (SELECT d.*, t.n, t.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT source, target, CAST(greatest(1, round(target / (SELECT CASE WHEN sum(target) = 0 THEN 1 ELSE sum(target) END FROM t) * 512)) AS BIGINT) AS quota FROM t WHERE target > 0),
b0 AS (SELECT source, unnest(range(quota)) AS block, 0 AS shard FROM q),
b1 AS (SELECT source, block, shard * 2 + CAST(2 * (row_number() OVER r - 1) >= count(*) OVER (PARTITION BY shard) AS INT) AS shard FROM b0
       WINDOW r AS (PARTITION BY shard ORDER BY md5('7000:' || coalesce(source, '') || ':' || block), source IS NULL, source, block)),
b2 AS (SELECT source, block, shard * 2 + CAST(2 * (row_number() OVER r - 1) >= count(*) OVER (PARTITION BY shard) AS INT) AS shard FROM b1
       WINDOW r AS (PARTITION BY shard ORDER BY md5('7001:' || coalesce(source, '') || ':' || block), source IS NULL, source, block)),
b3 AS (SELECT source, block, shard * 2 + CAST(2 * (row_number() OVER r - 1) >= count(*) OVER (PARTITION BY shard) AS INT) AS shard FROM b2
       WINDOW r AS (PARTITION BY shard ORDER BY md5('7002:' || coalesce(source, '') || ':' || block), source IS NULL, source, block)),
x AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM p),
m AS (SELECT r, x.source, size, x.target, quota, pass * n + before + size / 2 AS middle FROM x JOIN q ON x.source IS NOT DISTINCT FROM q.source, (VALUES (0), (1)) v(pass) WHERE size > 0),
d1 AS (SELECT r, size, shard FROM (SELECT *, least(floor(middle * quota / target), quota - 1) AS block FROM m WHERE middle < target) c
       JOIN b3 ON c.source IS NOT DISTINCT FROM b3.source AND c.block = b3.block),
g AS (SELECT r, CAST(sum(size) AS BIGINT) AS taken, list_transform(range(8), lambda s: CAST(coalesce(list_sum(list_filter(list(CASE WHEN size > 0 THEN shard * 1000000000000 + size END), lambda y: y // 1000000000000 = s)), 0) AS BIGINT)) AS w
      FROM d1 GROUP BY r)
SELECT doc_id, size, n AS source_size, round(target, 6) AS target, coalesce(taken, 0) AS taken,
       coalesce(array_to_string(list_transform(range(8), lambda s: CAST(w[s + 1] % 1000000000000 AS VARCHAR)), ','), '0,0,0,0,0,0,0,0') AS shard_words
FROM x LEFT JOIN g ON x.r = g.r
"""
