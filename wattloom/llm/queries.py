"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import bpe, decontamination, gru_lm, hard_negatives, line_crf, line_join, mixing, shingle_join, token_store, toxicity, variants, warc, wrapper
from wattloom.llm.common import table


def remainder(id: str, by: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % by


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


END_ID = 1


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_store.read_store(token_store.write_store(docs, tokenizer_path(), END_ID))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = gru_lm.train(docs, usable=remainder("doc_id", 7) != 2)
    held_out = (remainder("doc_id", 7) == 2).alias("held_out")
    return gru_lm.score(docs, model).select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no time of capture; one second per page id stands for it, over again every 10^9."""
    captured = F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod("page_id", F.lit(10**9)))
    return warc.read_records(warc.write_archive(table(spark, sf_dir, "pages"), captured))


def op5_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontamination.contaminated(docs, benchmark)
    return found.select(
        "doc_id", "item_id", "n_equal", "n_window", F.col("start").cast("long").alias("start")
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    machine = toxicity.train(docs, labels, usable=remainder("doc_id", 4) != 2)
    held_out = (remainder("doc_id", 4) == 2).alias("held_out")
    return toxicity.scored(docs, machine).select("doc_id", held_out, "score", "predicted")


def op8_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.line_counts(table(spark, sf_dir, "documents"))


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.assess(docs, model)


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.linked_documents(table(spark, sf_dir, "documents"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    tokens = bpe.encoded(table(spark, sf_dir, "documents"), path)
    return bpe.decoded(tokens, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_token_store": op2_token_store,
    "op3_gru_lm": op3_gru_lm,
    "op4_warc": op4_warc,
    "op5_wrapper": op5_wrapper,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_line_join": op8_line_join,
    "op9_line_crf": op9_line_crf,
    "op10_shingle_join": op10_shingle_join,
    "op11_variants": op11_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_bpe": op13_bpe,
}
