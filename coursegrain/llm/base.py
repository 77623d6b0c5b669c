"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once below ``spark.checkpoint.dir`` and read back.

    A lost executor then repeats one read instead of the whole lineage, and
    several readers share the work.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def packed(df: DataFrame, **needed: Column) -> DataFrame:
    """The input row as one struct beside the columns an operator works on, so that no input name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in needed.items()])


def unpacked(df: DataFrame, columns: list[str], *made: str) -> DataFrame:
    """The input columns again, those named like an output replaced by it."""
    kept = [c for c in columns if c.lower() not in {m.lower() for m in made}]
    return df.select(*[F.col("_row").getField(c).alias(c) for c in kept], *made)


def hash60(value: Column, seed: str) -> Column:
    """60 bits of md5 over seed and value as a non-negative long; null counts as empty."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(value.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def replaced(df: DataFrame, docs: DataFrame, text: str, n_chars: str) -> DataFrame:
    """The input columns with the new ``text`` and, where it changed, its length in code points."""
    fields = {c: F.col("_row").getField(c) for c in docs.columns}
    if n_chars in fields:
        same = F.col("text").eqNullSafe(fields[text])
        fields[n_chars] = F.when(same, fields[n_chars]).otherwise(F.length("text").cast(docs.schema[n_chars].dataType))
    fields[text] = F.col("text")
    return df.select(*[v.alias(c) for c, v in fields.items()])


#: Texts that a task holds as Python strings at a time.
CHUNK_ROWS = 1000


def chunks(batches, column: int):
    """(batch part, its texts) in parts of CHUNK_ROWS rows, so that a task's strings and what is made of them stay few; null counts as empty."""
    for batch in batches:
        for begin in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(begin, CHUNK_ROWS)
            yield part, [t or "" for t in part.column(column).to_pylist()]
