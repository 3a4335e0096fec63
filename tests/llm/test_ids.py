"""Ids above 2^53 and near the least long come back whole next to a null id."""

from collections import Counter

import pytest

import corpus_pipeline as P
from pulseboard.llm import near_duplicates, packing, token_counts, token_output, toxicity, warc
from pulseboard.llm.queries import tokenizer_file

BIG, LOW = 2**53 + 1, -(2**63) + 1
IDS = [BIG, LOW, None, BIG + 2]
BASE = " ".join(f"w{i}" for i in range(80))
TEXTS = [BASE, BASE + " tail", "something else entirely", "y" * 1200]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(zip(IDS, TEXTS, strict=True)), "doc_id long, text string").coalesce(1)


def test_scores_and_counts(spark, docs):
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert Counter(r["doc_id"] for r in toxicity.score(docs, model).collect()) == Counter(IDS)
    assert Counter(r["doc_id"] for r in token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model")).collect()) == Counter(IDS)


def test_links(docs):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.jaccard_join(docs).collect()}
    assert got == {BIG: (LOW, 1), LOW: (LOW, 1), None: (None, 0), BIG + 2: (BIG + 2, 0)}


def test_pieces(docs):
    path = tokenizer_file("word_bpe_49k.json")
    assert {r["doc_id"] for r in packing.pack(packing.token_pieces(docs, path)).collect()} == set(IDS)
    assert {r["doc_id"] for r in token_output.read_packed(token_output.write_packed(docs, path)).collect()} == set(IDS)


def test_records(spark):
    pages = spark.createDataFrame([(BIG, "u", TEXTS[3]), (BIG + 2, "u", TEXTS[3]), (None, "u", "x"), (LOW, "u", TEXTS[3])], "page_id long, url string, html string").coalesce(1)
    got = {(r["record_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.write_archives(pages)).collect()}
    top = str(BIG + 2)
    assert got == {(top, "response", None), (str(BIG), "revisit", top), (str(LOW), "revisit", top), (None, "response", None)}


def test_toxic_documents_leave_next_to_a_null_id(spark, tmp_path):
    good, bad = "a pleasant day by the river", "you worthless idiot go away"
    rows = [(BIG + i, f"{bad if i % 4 == 0 else good} n{i}", "en", "web", 1) for i in range(120)] + [(None, good, "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    spark.createDataFrame([(k, int(bad in t)) for k, t, *_ in rows if k], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = P.clean(spark, docs, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(k for k, t, *_ in rows if bad not in t)


def test_rows_of_one_id_do_not_flood_the_fit(spark):
    rows = [(1, f"good {i % 50}") for i in range(20_000)] + [(i, f"bad {i}") for i in range(2, 60)]
    labels = spark.createDataFrame([(1, 0)] + [(i, 1) for i in range(2, 60)], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert model["rows"] == 20_058  # the ratios count all of them
