"""A training-corpus pipeline: five operators, each stage written as Parquet and reread as the next one's documents.

1. language: documents without a letter, or that no language has the larger share of, go.
2. line dedup: later repeats of runs of 50 words or more are cut; a document of which no word is left goes.
3. near duplicates (five words, 0.8): the document with the smallest id of each group stays.
4. mixing: documents are taken as often as their sources' targets ask, in the order of the output shards.
5. SentencePiece: the ids of each document.

Stages 1 to 4 return the columns of ``documents``. Empty tables give empty results; null texts go in stage 1; texts of any length are
handled whole; rows without an id, and rows that share an id but not a text, are documents of their own; rows that share id and text are
copies, of which stage 3 keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.llm import langid, line_dedup, mixing, ngram_jaccard, sentencepiece_codec
from sparkqc.llm.common import staged, table
from sparkqc.llm.queries import tokenizer_path

MIN_LANGUAGE_SHARE = 0.5
NEAR = ngram_jaccard.Similarity(words=5, num=80, den=100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = langid.annotate(docs, langid.fit(docs), pred_col="_lang_pred", score_col="_lang_score")
    return told.where((F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_lang_score") >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean_lines(docs)
    left = (F.col("n_deleted") == 0) | (mixing.word_count(F.col("text")) > 0)
    return cleaned.where(left).withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # id and text name a row: rows that share an id, or have none, are documents of their own
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    found = ngram_jaccard.near_duplicates(keyed, NEAR, "_key").select(F.col("_key").alias("_found"), F.col("component_id").alias("_group")).distinct()
    ids = keyed.select("_key", "doc_id").distinct().join(found, F.col("_key") == F.col("_found"))
    first = ids.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("_first")).select(F.col("_first._key").alias("_stays"))
    kept = keyed.join(staged(first, "pipeline-first").hint("merge"), F.col("_key") == F.col("_stays"), "left_semi")
    return kept.dropDuplicates(["_key"]).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = staged(docs.withColumn("_number", F.monotonically_increasing_id()), "pipeline-numbered")
    sized = mixing.sizes(rows, row_col="_number")
    taken = mixing.mix(sized, mixing.targets(sized)).where("shard IS NOT NULL").select(F.col("_row").alias("_taken"), "shard", "place")
    copies = rows.join(staged(taken, "pipeline-taken").hint("merge"), F.col("_number") == F.col("_taken"))
    return copies.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.load_pieces(tokenizer_path("piece_bpe_32k.model"))
    coded = sentencepiece_codec.encode(docs, pieces)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]

#: Stage 1 is a fitted model and stage 5 a Viterbi search: no SQL. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
