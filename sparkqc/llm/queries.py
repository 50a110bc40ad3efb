"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.llm import chat_format, hard_negatives, langid, license_scan, line_dedup, mixing, ngram_jaccard, nn_descent, repair_ids, sentencepiece_codec, spelling, suffix_dedup, voronoi_knn
from sparkqc.llm.common import table

#: Folder of the public vocabulary files; "" means the installed package.
TOKENIZER_DIR = os.environ.get("PUBLIC_TOKENIZERS_DIR", "")


def tokenizer_path(name: str, folder: str = TOKENIZER_DIR) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(table(spark, sf, "documents"), ngram_jaccard.Similarity(words=3, num=90, den=100))


def op2_sentencepiece_codec(spark: SparkSession, sf: str) -> DataFrame:
    pieces = sentencepiece_codec.load_pieces(tokenizer_path("piece_bpe_32k.model"))
    coded = sentencepiece_codec.encode(table(spark, sf, "documents"), pieces)
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "decoded")


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf, "documents")))


def op6_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    calls, results = chat_format.conversation_calls(table(spark, sf, "conversations"))
    linked = chat_format.link(calls, results, chat_format.CONVERSATION_TOOLS)
    return linked.select(F.col("conv").alias("conv_id"), F.col("id").alias("call_id"), "kind", "state", "level", "place",
                         F.size("errors").cast("long").alias("n_errors"), "message", "n_rows")


def op7_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    sized = mixing.sizes(table(spark, sf, "documents"))
    taken = mixing.taken(mixing.mix(sized, mixing.targets(sized)))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken",
                        F.array_join(F.transform("shard_words", lambda w: w.cast("string")), ",").alias("shard_words"))


def op8_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = repair_ids.write_ids(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"), repair_ids.shard_folder(spark))
    return repair_ids.read_ids(spark, path)


def op9_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return voronoi_knn.top_k(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, 10)


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf, "documents"), noise=spelling.NOISE)


def op12_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf, "documents")))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").withColumn("label", hard_negatives.shifted_label(F.col("label"), F.col("vec_id")))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sentencepiece_codec": op2_sentencepiece_codec,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_chat_format": op6_chat_format,
    "op7_source_mixing": op7_source_mixing,
    "op8_token_ids": op8_token_ids,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_chat_format": chat_format.ORACLE,
    "op7_source_mixing": mixing.ORACLE,
    "op10_exact_top_k": voronoi_knn.ORACLE,
    "op12_suffix_dedup": suffix_dedup.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
