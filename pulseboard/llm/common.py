"""Helpers shared by the operators of this package.

Conventions of every operator here:

* input columns are named by parameters; columns an operator does not name are carried along or
  dropped as its docstring says, never read.  Internal columns start with ``__op_``;
* an output column replaces an input column of the same name;
* a null text counts as a text without words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.session import ensure_checkpoint_dir

#: Words of the quality counters: runs of anything but \x20 and \x09-\x0D, which is what \S is to Java.
SPACE_WORDS = r"\S+"
#: Words of matching operators, after lower-casing A-Z: ASCII letters, digits and all non-ASCII.
#: Stated as what it holds: Java takes six times as long for the same set as a complement.
MATCH_WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column, pattern: str) -> Column:
    """Array of the words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def barrier(df: DataFrame, keep: list[str], made: dict[str, Column]) -> DataFrame:
    """``keep`` plus ``made`` columns, such that later filters on them are not rewritten into filters
    that compute the made expressions a second time below (a generated column is not inlined)."""
    row = F.struct(*[c.alias(n) for n, c in made.items()])
    return df.select(*[F.col(f"`{k}`") for k in keep if k not in made], F.inline(F.array(row)))


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the session's checkpoint folder (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write a result to the shared folder and read it back: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = shared_folder(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def values(batch: pa.RecordBatch | pa.Table, *names: str, rows: int = 256) -> Iterator:
    """Rows of the named columns as Python values (integers stay integers next to nulls), made a slice at a time."""
    for i in range(0, batch.num_rows, rows):
        part = [batch.column(n).slice(i, rows).to_pylist() for n in names]
        yield from zip(*part, strict=True) if len(names) > 1 else part[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
