"""The corpus pipeline on a small table: every stage's decision takes effect on what the one before kept."""

import duckdb

import corpus_pipeline as P
from conftest import SF0001
from pulseboard.llm import decontaminate, near_duplicates, quality, toxicity
from pulseboard.llm.common import stored, table
from pulseboard.llm.queries import held_out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_apply_their_operators(spark):
    from pyspark.sql import functions as F
    docs = table(spark, SF0001, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "quality_rules", "jaccard_join", "decontamination", "packing"]
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF0001), f"test-{name}"))
    assert all(s.columns == list(P.COLUMNS) for s in steps[1:-1])
    labels = table(spark, SF0001, "labels").where(~held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert ids(steps[1]) == ids(scored.where("predicted = 0"))
    assert ids(steps[2]) == ids(quality.quality_cascade(steps[1], order=quality.RULES).where("kept"))
    classes = near_duplicates.jaccard_join(steps[2]).collect()
    assert ids(steps[3]) == sorted({r["class_id"] for r in classes})
    assert ids(steps[4]) == ids(decontaminate.contamination(steps[3], table(spark, SF0001, "benchmark")).where("NOT contaminated"))
    assert sorted(set(ids(steps[5]))) == ids(steps[4])
    clean = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF0001}/labels.parquet' WHERE toxic = 0 AND quality = 1").fetchall()}
    assert len(clean & set(ids(steps[1]))) >= 0.97 * len(clean & set(ids(docs)))


def test_pipeline_on_no_rows(spark):
    docs = table(spark, SF0001, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF0001)
        assert docs.count() == 0
