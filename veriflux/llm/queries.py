"""The registered queries of this package, each over its whole table, and the same results as SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.llm import (
    centroids, chat, contamination, context_tree, language, main_text, metric_tree, mixing, near_copies, periods, substrings, token_files, word_pieces,
)
from veriflux.session import shared_dir, ship_library


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_library(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.drop_repeated_passages(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    vectors = vectors.filter(F.coalesce(usable, F.lit(False))).select("vec_id", whole.alias("vector"))
    return metric_tree.top_inner_products(vectors, F.col("vec_id") % 50 == 0)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    found = main_text.extract_main_text(pages, main_text.train(pages))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language.train(docs.filter(~language.is_held_out(F.col("doc_id"))))
    found = language.predict(docs, model)
    return found.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return context_tree.score_texts(_read(spark, sf_dir, "documents"), held_out)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.link_near_copies(_read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls are checked against the tools of their conversation. place_turn, then whether call_turn >= turn (a result that
    moved behind its call), sort a conversation."""
    turns = _read(spark, sf_dir, "conversations")
    formatted = chat.format_turns(turns, chat.declared_tools(turns))
    return formatted.select("conv_id", "turn", "role", F.col("place.turn").alias("place_turn"), "call_turn", "problem", "message")


TOKENIZER, VOCABULARY, END_ID = "byte_bpe_50k.json", 50257, 2


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    token_files.write(_read(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read(spark, folder, VOCABULARY).select("doc_id", "start", "n_tokens", "ids_crc32")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of all documents; where crc32(doc_id) ends in 0, the words from some place on repeat a few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    cut = cut.select("*", F.when(n > 0, F.pmod("g", n)).alias("a"))
    cut = cut.select("*", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    looped = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return cut.select("doc_id", F.when(n > 0, F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.collapse_runs(with_planted_runs(_read(spark, sf_dir, "documents").select("doc_id", "text")))
    found = found.withColumn("best", periods.strongest(F.col("runs")))
    best = [F.col("best")[name].alias(name) for name in ("start", "length", "period")]
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best, F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.whole_vectors(_read(spark, sf_dir, "embeddings"), 64)
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    found = centroids.cluster(vectors, 40, 5, 64, order)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest)


WORD_TOKENIZER = "word_bpe_49k.json"


def op13_word_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_pieces.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_mixing": op3_mixing,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_token_files": op5_token_files,
    "op6_topk_search": op6_topk_search,
    "op7_main_text": op7_main_text,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_word_pieces": op13_word_pieces,
}
