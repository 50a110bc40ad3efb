"""Line deduplication by winnowing over line hashes.

Documents are sequences of lines; lines without words are left out of the comparison. A run of lines with ``min_words``
words or more that stands at an earlier place too (smaller id, or further up in the same document) is deleted.

1. Grams: from each line on, the lines that start within ``min_words / 2`` words, hashed.
2. Winnowing: of the grams that start within ``min_words / 2`` words of one another, the smallest hash is a fingerprint.
   Any repeated run of ``min_words`` words holds a whole gram window, and its smallest hash is the same at both
   places; so every repeated run has a fingerprint in common, at a fraction of all grams.
3. Positions: fingerprints are joined on their hash; those that stand at two places or more are seeds.
4. Extension: in documents with a seed, matches grow to both sides, from each line forwards and from each line backwards, to
   the shortest run with ``min_words`` words. Every longer match is the union of such runs.
5. Deletion: of equal runs the first place stays; the lines of all later ones go, wherever in a hot passage they stand.

Runs are compared by 128 bits of hash, each with its first place only (a partial aggregate), so a passage
in a third of all documents gives no pairs. All joins are merge joins, at every size: none of their sides is bounded, and the disk they take grows as the input does. A task holds the line hashes of one document, never a group of documents.

Defined results: a null text stays null with 0 lines; an empty text has one empty line. A line without words
goes with the line before it. A document that loses all its lines has an empty text. Rows with equal id and
text are one document and get the same result; a null id comes before all others. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.llm.common import forget, staged
from sparkqc.llm.mixing import word_count

MIN_WORDS = 50


def _document_key(id_col: str, text_col: str) -> list:
    return [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key")]


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, pos, h1, h2, first, last)``, one row per line with words; ``first`` and ``last`` are the places of its first
    and last word in the document."""
    lines = F.transform(F.split(F.col(text_col), "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), word_count(x).alias("n")))
    once = docs.where(F.col(text_col).isNotNull()).select(*_document_key(id_col, text_col), lines.alias("lines")).groupBy("id", "key").agg(F.first("lines").alias("lines"))
    rows = once.select("id", "key", F.posexplode("lines").alias("pos", "line")).select("id", "key", "pos", "line.h1", "line.h2", "line.n").where("n > 0")
    upto = Window.partitionBy("id", "key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("last", F.sum("n").over(upto) - 1).withColumn("first", F.col("last") - F.col("n") + 1).drop("n")


def _from_here(words: int):
    """The lines that start within so many words: the shortest run from a line on with so many words, or the document's rest."""
    return Window.partitionBy("id", "key").orderBy("first").rangeBetween(0, words - 1)


def _up_to_here(words: int):
    """The lines that end within so many words back: the shortest run that ends with a line and has so many words, or less."""
    return Window.partitionBy("id", "key").orderBy("last").rangeBetween(1 - words, 0)


def _hash_of(window) -> tuple:
    lines = F.collect_list(F.struct("h1", "h2")).over(window)
    return F.xxhash64(F.transform(lines, lambda x: x["h1"])), F.xxhash64(F.transform(lines, lambda x: x["h2"]))


def fingerprints(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``lines`` with the gram hash of every line and whether it is a fingerprint."""
    half = min_words // 2
    gram = F.xxhash64(F.collect_list("h1").over(_from_here(half)))
    whole = F.max("last").over(_from_here(half)) - F.col("first") + 1 >= half
    grams = lines.withColumn("gram", F.when(whole, gram))
    least = grams.withColumn("_least", F.min("gram").over(_from_here(half)))
    back = Window.partitionBy("id", "key").orderBy("first").rangeBetween(1 - half, 0)
    return least.withColumn("chosen", F.coalesce(F.max("_least").over(back) == F.col("gram"), F.lit(False))).drop("_least")


def deletions(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, kept)`` for each document that loses lines: the places of the lines with words that stay."""
    lines = staged(fingerprints(line_table(docs, id_col, text_col), min_words), "line-grams")
    seeds = lines.where("chosen").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    # the gram of an equal run is a fingerprint at both places, so seeds are marked on chosen lines only
    seeded = lines.where("chosen").join(seeds.hint("merge"), "gram", "left_semi").select("id", "key").distinct()
    near = lines.join(seeded.withColumnsRenamed({"id": "_id", "key": "_key"}).hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi")
    runs = []
    for kind, window in enumerate((_from_here(min_words), _up_to_here(min_words))):
        h1, h2 = _hash_of(window)
        start, end = F.min("pos").over(window), F.max("pos").over(window)
        words = F.max("last").over(window) - F.min("first").over(window) + 1
        runs.append((f"r{kind}", F.struct(F.lit(kind).alias("kind"), h1.alias("h1"), h2.alias("h2"), start.alias("start"), end.alias("end"), words.alias("words"))))
    grown = near.select("id", "key", "pos", *[r.alias(k) for k, r in runs])
    every = grown.select("id", "key", F.explode(F.array("r0", "r1")).alias("r")).select("id", "key", "r.*").where(F.col("words") >= min_words).drop("words")
    every = staged(every, "line-runs")
    place = F.struct("id", "start", "key")
    firsts = every.groupBy("kind", "h1", "h2").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = every.join(firsts.hint("merge"), ["kind", "h1", "h2"]).where(~place.eqNullSafe(F.col("place"))).select("id", "key", "start", "end")
    # a line goes if a run that starts at it or before reaches it
    marks = later.groupBy("id", "key", F.col("start").alias("pos")).agg(F.max("end").alias("reach"))
    marked = lines.select("id", "key", "pos").withColumn("reach", F.lit(None).cast("int")).unionByName(marks.withColumn("reach", F.col("reach").cast("int")))
    at_line = marked.groupBy("id", "key", "pos").agg(F.max("reach").alias("reach"))
    upto = Window.partitionBy("id", "key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    gone = F.coalesce(F.max("reach").over(upto) >= F.col("pos"), F.lit(False))
    judged = at_line.withColumn("gone", gone).groupBy("id", "key").agg(
        F.max("gone").alias("any"), F.sort_array(F.collect_list(F.struct("pos", "gone"))).alias("lines"))
    found = staged(judged.where("any").drop("any"), "line-deletions")
    forget(lines, every)
    return found


def clean_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with texts without their later repeated runs, and ``n_lines`` and ``n_deleted``; columns of these names are replaced."""
    found = deletions(docs, min_words, id_col, text_col).withColumnsRenamed({"id": "_ld_id", "key": "_ld_key", "lines": "_ld_lines"})
    rows = docs.join(found.hint("merge"), F.col(id_col).eqNullSafe(F.col("_ld_id")) & (F.xxhash64(F.col(text_col)) == F.col("_ld_key")), "left")
    parts = F.split(F.col(text_col), "\n", -1)
    # each judged line reaches to the next one, so lines without words go with the line before; those at the top stay
    judged = F.col("_ld_lines")
    spans = F.transform(judged, lambda x, i: F.struct(
        x["pos"].alias("from"), F.when(i + 1 < F.size(judged), F.get(judged, i + 1)["pos"]).otherwise(F.size(parts)).alias("to"), x["gone"].alias("gone")))
    head = F.slice(parts, 1, F.get(judged, F.lit(0))["pos"])
    kept = F.concat(head, F.flatten(F.transform(F.filter(spans, lambda x: ~x["gone"]), lambda x: F.slice(parts, x["from"] + 1, x["to"] - x["from"]))))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(parts)).cast("long")
    out = rows.withColumn("_ld_kept", F.when(judged.isNotNull(), kept)).withColumns({
        "n_lines": total, "n_deleted": F.when(F.col("_ld_kept").isNull(), 0).otherwise(total - F.size("_ld_kept")).cast("long")})
    out = out.withColumn(text_col, F.when(F.col("_ld_kept").isNull(), F.col(text_col)).otherwise(F.array_join("_ld_kept", "\n")))
    return out.drop("_ld_id", "_ld_key", "_ld_lines", "_ld_kept")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the text without its later repeated runs, ``n_lines`` and ``n_deleted``."""
    return clean_lines(docs.select(id_col, text_col), min_words, id_col, text_col)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
e AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d WHERE text IS NOT NULL),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM e),
l AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY pos) - 1 AS last, sum(n) OVER (PARTITION BY r ORDER BY pos) - n AS first FROM w WHERE n > 0),
runs AS (
  SELECT r, doc_id, 0 AS kind, list(md5(line)) OVER f AS run, pos AS start, max(pos) OVER f AS stop, max(last) OVER f - first + 1 AS words
  FROM l WINDOW f AS (PARTITION BY r ORDER BY first RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT r, doc_id, 1, list(md5(line)) OVER b, min(pos) OVER b, pos, last - min(first) OVER b + 1
  FROM l WINDOW b AS (PARTITION BY r ORDER BY last RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
f AS (SELECT *, row_number() OVER (PARTITION BY kind, run ORDER BY doc_id, start) AS nth FROM runs WHERE words >= 50),
g AS (SELECT DISTINCT l.r, l.pos FROM l JOIN f ON f.r = l.r AND f.nth > 1 AND l.pos BETWEEN f.start AND f.stop),
a AS (SELECT w.r, w.pos, w.line, CASE WHEN w.n > 0 THEN g.pos IS NOT NULL END AS gone FROM w LEFT JOIN g USING (r, pos)),
k AS (SELECT *, coalesce(last_value(gone IGNORE NULLS) OVER (PARTITION BY r ORDER BY pos), false) AS goes FROM a),
t AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE goes) AS m, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '') AS text FROM k GROUP BY r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text, CAST(coalesce(t.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.m, 0) AS BIGINT) AS n_deleted
FROM d LEFT JOIN t USING (r)
"""
