"""Corpus pipeline: each stage calls one operator, is written as Parquet, and is reread as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm import packing, toxicity
from pulseboard.llm.common import stored, table
from pulseboard.llm.decontaminate import contamination
from pulseboard.llm.near_duplicates import one_per_class
from pulseboard.llm.quality import quality_cascade
from pulseboard.llm.queries import held_out, tokenizer_file

#: Columns that pass from stage to stage.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.

    Scores are a text's own, so rejected rows leave by id and text; ids may be null or repeated; null texts score as empty ones; no rows give no rows."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    docs = docs.select(*COLUMNS)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    toxic = scored.where("predicted = 1").select(F.col("doc_id").alias("toxic_id"), F.col("text_hash").alias("toxic_hash")).distinct()
    toxic = stored(toxic, "toxic")
    toxic = F.broadcast(toxic) if toxic.count() <= toxicity.BROADCAST_LABELS else toxic
    same = F.col("doc_id").eqNullSafe(F.col("toxic_id")) & (F.xxhash64("text") == F.col("toxic_hash"))
    return docs.join(toxic, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    Null and empty texts have too few words and go; equal rows are judged alike; ids are not read; no rows give no rows."""
    return quality_cascade(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    A text without words is never contaminated; equal rows are judged alike; ids may be null; no rows give no rows."""
    return contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*COLUMNS)


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class.

    Texts without words all stay; of equal rows one stays; ids may be null or repeated; no rows give no rows."""
    return one_per_class(docs.select(*COLUMNS))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in packed sequences.

    A null or empty text is the end id alone; equal rows are documents of their own; ids may be null; no rows give no rows."""
    pieces = packing.token_pieces(docs.select(*COLUMNS), tokenizer_file("word_bpe_49k.json"))
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", clean), ("quality_rules", quality), ("jaccard_join", deduplication),
          ("decontamination", decontamination), ("packing", sequences)]
#: Toxicity scores, near-duplicate groups and packing are not SQL. Tests hold each stage against its operator on its own input, and the operators
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
