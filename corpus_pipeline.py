"""Documents to training data: the stages, each a function (spark, docs, sf_dir) -> DataFrame.

What a stage returns is written as Parquet and read again as the documents of the next one. All but
the last return the columns of ``documents``. NULLs, empty texts, repeated rows and empty tables are
handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import decontamination, line_crf, mixing, shingle_join, token_store
from wattloom.llm.common import saved, table
from wattloom.llm.queries import END_ID, tokenizer_path


#: Near copies: documents whose sets of so many consecutive words are as similar as that.
COPY_WORDS = 5
COPY_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the counts or the lines' labels reject."""
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.kept_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles, directly or by others, the one of least id stays."""
    return shingle_join.one_of_each(docs, n=COPY_WORDS, percent=COPY_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that overlap with a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    store = token_store.write_store(docs, tokenizer_path(), END_ID)
    return token_store.read_store(store).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: SQL expresses neither the fitted field nor the tokenizer; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
