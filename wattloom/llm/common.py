"""Helpers shared by the operators: words, tables written between steps, key hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import fresh_folder

#: A word is a run of characters other than ASCII white space; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write and reread: the lineage ends here, and what an executor held may be lost."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def null_safe_key(column: Column) -> Column:
    """A string that differs for different values, NULL included, and is never NULL itself."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def text_key(text: Column) -> list[Column]:
    """128 bits that name a text; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("_key_a"), F.xxhash64(F.lit(1), text).alias("_key_b")]


def whole_row(df: DataFrame) -> Column:
    """All columns as one, ``row``, beside which no name of a step can clash with one of theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str):
    """The pyarrow file system of a folder in the shared folder, and the path in it. For use in
    tasks: local and network paths alike, so nothing is assumed about the machine."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, suffix: str, chunks) -> str:
    """Write byte chunks under a name of its own and return the name. A task that runs twice
    leaves two files, and the result of the one that counts names the file that counts."""
    files, folder = file_system(uri)
    files.create_dir(folder, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    return name


def small(df: DataFrame, rows: int = 400_000) -> DataFrame:
    """Broadcast a written table if it has few rows; join it by shuffling otherwise."""
    return F.broadcast(df) if df.count() <= rows else df
