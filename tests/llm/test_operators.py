"""Each operator on awkward tables: nulls, empty and very long texts, ties, repeated rows, no rows, clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import chat, decontaminate, near_duplicates, packing, quality, token_counts, token_output, toxicity, urls, warc
from pulseboard.llm.queries import tokenizer_file

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = " ".join(f"w{i % 211}x{i % 13}" for i in range(120))
#: Enough names to clash with whatever an operator makes.
CLASH = "n_words string, kept string, text_hash string, start string, length string, score string, host string, h string, pos string, left string, label string, node string"
ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, BASE), (5, BASE + " tail"), (6, BASE), (6, BASE), (None, BASE), (7, "one two"), (8, "one two"),
        (9, "Long " + BASE + " " + " ".join(f"u{i}" for i in range(30_000))), (10, "same line here\n" * 30), (None, None), (11, "é漢字 ß! " * 30)]


@pytest.fixture(scope="module")
def docs(spark):
    c = len(CLASH.split(", "))
    return spark.createDataFrame([(*r, *["z"] * c) for r in ROWS], f"doc_id long, text string, {CLASH}").repartition(3)


def words(text):
    return WORDS.findall((text or "").encode().lower())


def test_quality(spark, docs):
    got = quality.quality_cascade(docs, all_counters=True).collect()
    assert len(got) == len(ROWS)
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        repeated = len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)})
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), repeated)
        assert r["score"] == "z" and r["kept"] is (r["rejected_by"] is None)
        if len(w) < 20 or 100 * repeated > 30 * len(w):
            assert not r["kept"]
    lazy = quality.quality_cascade(docs, order=list(reversed(quality.RULES))).select("doc_id", "kept").collect()
    assert Counter(map(tuple, lazy)) == Counter((r["doc_id"], r["kept"]) for r in got)  # no order of rules changes what stays
    assert quality.quality_cascade(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = [(1, " ".join(BASE.split()[3:30]), "z"), (2, "one two", "z"), (3, None, "z"), (4, "", "z"), (5, "É漢字", "z"), (2, "one two", "z"), (6, "u7", "z"),
             (7, " ".join(["u1"] * 20), "z"), (None, "same line", "z")]
    bench = spark.createDataFrame(items, "item_id long, text string, n_words string")
    windows = set()
    for item, t, _ in items:
        w = words(t)
        n = min(len(w), 13)
        windows |= {(str(item) if item is not None else None, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n}
    for r in decontaminate.contamination(docs, bench, broadcast_rows=7).collect():  # several blocks of items
        w = words(r["text"])
        hit, found = set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= {item} - {None}
        assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(found)), r["doc_id"]
        assert r["contaminated"] == (bool(hit) and 20 * len(hit) >= len(w)) and r["kept"] == "z"
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_jaccard_join(spark, docs):
    near = [(100 + k, " ".join(x for i, x in enumerate(BASE.split()) if i % (37 + k))) for k in range(6)] + [(200, BASE.upper()), (201, BASE.replace(" ", "  "))]
    rows = [r[:2] for r in ROWS] + near
    table = docs.select("doc_id", "text", "node").unionByName(spark.createDataFrame([(*r, "z") for r in near], "doc_id long, text string, node string"))
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    link = [[bool(a) and i != j and len(a & b) * 10 >= 8 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[j] for j in range(len(rows)) if link[i][j])]) for i in range(len(rows))]
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
    want = Counter((r[0], least[g], sum(x)) for r, g, x in zip(rows, group, link, strict=True))
    old = near_duplicates.BLOCK
    try:
        for near_duplicates.BLOCK in (old, 2):  # the second cuts the cluster into many units
            got = near_duplicates.jaccard_join(table)
            assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect()) == want
    finally:
        near_duplicates.BLOCK = old
    kept = near_duplicates.one_per_class(table)
    assert kept.columns == table.columns
    wordless = [r[0] for r, a in zip(rows, sets, strict=True) if not a]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*wordless, *{least[g] for g, a in zip(group, sets, strict=True) if a}])
    assert near_duplicates.one_per_class(table.limit(0)).count() == 0


def test_candidates_are_bounded_by_prefix_groups(spark):
    """A chain of texts, each near the next one only: blocks meet where a prefix is shared, not wherever the chain leads."""
    r, links, size = random.Random(4), 40, 60
    pool = [f"w{i}" for i in range(9000)]
    r.shuffle(pool)
    step = 6  # of 60 words, neighbours share 54; two steps apart they are below the threshold
    texts = [" ".join(pool[i * step:i * step + size]) for i in range(links)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, " ".join([f"x{i}", *pool[5000:5200]])) for i in range(30)]
    shingles, forest, prefix = near_duplicates.Shingler(), near_duplicates.Forest(), near_duplicates.prefix_length()
    low = {i: forest.minhashes(shingles(t)) for i, t in rows}
    nodes = spark.createDataFrame([(i, m.tobytes(), 100) for i, m in low.items()], "node long, minhashes binary, shingles long")
    old = near_duplicates.BLOCK
    try:
        near_duplicates.BLOCK = 4
        got = [tuple(x) for x in near_duplicates.candidate_blocks(nodes, prefix).collect()]
    finally:
        near_duplicates.BLOCK = old
    assert len(got) == len(set(got))
    block = {n: b for n, b, _ in got}
    sent = {(n, frozenset((b, o))) for n, b, o in got}
    keys = {n: forest.keys(m, prefix) for n, m in low.items()}
    share = lambda a, b: bool((keys[a] == keys[b]).any())
    for a in block:
        for b in block:
            if a < b and share(a, b):
                unit = frozenset((block[a], block[b]))
                assert (a, unit) in sent and (b, unit) in sent
    for n, b, o in got:  # a node is sent to another block only for a node there that it shares a prefix with
        assert b == o or any(share(n, m) for m in block if block[m] == o)
    assert set(block) == {a for a in low if any(share(a, b) for b in low if a != b)}


def test_small_homes_join_the_large_group_beside_them(spark):
    """Near copies of one text at many distances: a node of the group's home meets few blocks, not each small home around it."""
    r, n = random.Random(300), 300
    texts = []
    for _ in range(n):
        w = [f"b{i}" for i in range(200)]
        for _ in range(r.randrange(24)):
            w[r.randrange(200)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(w))
    shingles, forest, prefix = near_duplicates.Shingler(), near_duplicates.Forest(), near_duplicates.prefix_length()
    sets = [shingles(t) for t in texts]
    nodes = spark.createDataFrame([(i, forest.minhashes(s).tobytes(), len(s)) for i, s in enumerate(sets)], "node long, minhashes binary, shingles long")
    got = [tuple(x) for x in near_duplicates.candidate_blocks(nodes, prefix).collect()]
    assert len([b for _, b, o in got if b != o]) <= n
    links, _, first = near_duplicates.compare(sets, np.ones(n, np.int64), None, near_duplicates.Fraction(4, 5))
    joined = near_duplicates.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {tuple(x) for x in joined.select("doc_id", "class_id", "n_links").collect()} == {(i, int(f), int(x)) for i, (f, x) in enumerate(zip(first, links, strict=True))}


def test_one_per_class_with_shared_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    def kept(rows):
        return Counter(map(tuple, near_duplicates.one_per_class(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert kept([(None, a), (None, a), (None, b)]) == Counter([(None, a), (None, b)])  # an unlinked text beside a class of null ids
    assert kept([(None, a), (None, a), (None, b), (None, b.upper()), (None, ""), (None, None), (None, c)]).total() == 5  # two such classes, wordless rows
    got = kept([(1, a), (1, a), (2, a + " x"), (1, b), (1, b), (3, b), (1, c), (1, " "), (1, None), (None, a)])
    assert got == Counter([(1, a), (1, b), (1, c), (1, " "), (1, None)])
    near = kept([(1, a + " x"), (1, a + " y"), (1, b)])  # of near copies with one id, one stays
    assert near.total() == 2 and near[1, b] == 1


def test_toxicity(spark, docs):
    good, bad = "a pleasant day by the river", "you worthless idiot go away"
    rows = [(1000 + i, f"{bad if i % 4 == 0 else good} n{i}", "z") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label string").unionByName(docs.select("doc_id", "text", "label"))
    labels = spark.createDataFrame([(k, int(bad in t)) for k, t, _ in rows if k % 5] + [(1, 0), (None, 1), (2, None), (999_999, 1), (1001, 0)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(table, toxicity.train(table, labels)).where("doc_id IS NOT NULL").collect()}
    assert all(got[k]["predicted"] == int(bad in t) for k, t, _ in rows)  # a fifth of them never learnt
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] == got[2]["score"] and got[1]["predicted"] == 0
    none = toxicity.train(table, labels.limit(0))
    assert toxicity.score(table, none).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score(table.limit(0), none).count() == 0


def test_urls(spark):
    hosts = ["http://WWW.Example.com/en/a", "http://example.com/en/a?x", "http://example.com", "http://a.net/es/", "http://a.net/es", "x.net/es/q", None, "", "ftp://net/fr/1#z", "http://notnet/fr/1", "http://a.org/x"]
    train = [f"https://good{i % 7}.com/news/{i}" for i in range(60)] + [f"https://cheap-pills{i % 7}.net/es/{i}" for i in range(60)]
    asked = ["https://good3.org/news/5", "https://cheap-pills4.org/es/77", "https://cheap-pills4.org/es/77"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(hosts + train + asked)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert len(got) == len(hosts + train + asked)
    assert [got[i]["rule"] for i in range(11)] == ["www.example.com/en/", "example.com/en/", None, "net/es/", None, None, None, None, "net/fr/", None, None]
    assert (got[0]["host"], got[0]["path"], got[1]["path"], got[2]["path"], got[5]["host"], got[6]["path"]) == ("www.example.com", "/en/a", "/en/a", "", "", "")
    n = len(hosts + train)
    assert got[n]["verdict"] == "allow" and got[n + 1]["verdict"] == got[n + 2]["verdict"] == "block" and got[n + 1]["score"] == got[n + 2]["score"]
    assert {r["verdict"] for r in urls.filter_urls(pages.where("url LIKE '%org%'")).collect()} == {"allow"}  # nothing to learn from
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_urls_learn_from_every_rejected_url(spark):
    """Blocked URLs whose hash is that of the calibration fold count in the model too."""
    made = [(f"http://cheap-pills.net/es/{i}",) for i in range(100)]
    fold = F.pmod(F.xxhash64(F.concat(*urls.host_and_path(F.col("url")))), F.lit(urls.CALIBRATION)) == 0
    blocked = [r["url"] for r in spark.createDataFrame(made, "url string").where(fold).collect()]
    good = [f"http://good{i % 7}.com/news/{i}" for i in range(60)]
    assert blocked
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*good, *blocked, "http://cheap-pills.org/es/x"])], "page_id long, url string")
    assert urls.filter_urls(pages).where("url LIKE '%org%'").first()["verdict"] == "block"


def test_url_model_equals_plain_witten_bell(spark):
    import math
    a, b, order = ["ab.x/1", "ab.y/2", "abab"], ["zz.x/1", "zzz"], 4

    def prob(corpus, text, i):
        p = 1 / urls.ALPHABET
        s = urls.PAD * order + text + urls.END
        for k in range(order + 1):
            at, ctx = i + order, s[i + order - k:i + order]
            nxt = [t[j] for u in corpus for t in [urls.PAD * order + u + urls.END] for j in range(order, len(t)) if t[j - k:j] == ctx]
            if nxt:
                p = (nxt.count(s[at]) + len(set(nxt)) * p) / (len(nxt) + len(set(nxt)))
        return p

    table = spark.createDataFrame([(u, True, 1) for u in a] + [(u, False, 1) for u in b], "u string, accepted boolean, n long")
    for r in urls.score_urls(spark.createDataFrame([("ab.x/9",), ("",), ("q",)], "u string"), urls.gram_counts(table)).collect():
        want = sum(math.log(prob(a, r["u"], i) / prob(b, r["u"], i)) for i in range(len(r["u"]) + 1)) / (len(r["u"]) + 1)
        assert abs(r["score"] - want) < 1e-6


def test_warc(spark):
    big, small = "é" * 700, "s" * 999
    rows = [(1, "u", big), (5, "u", big), (3, None, big), (None, "u", big), (2, "u", small), (4, "u", small), (6, "u", None), (7, "u", ""), (8, "u", "x" * 300_000), (5, "u", big)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, size string").repartition(2)
    got = warc.read_archives(warc.write_archives(pages, archive_bytes=2000), payloads=True).collect()  # several archives
    want = Counter()
    for k, _, t in rows:
        p = (t or "").encode()
        revisit = t == big and k is not None and k < 5
        want[(None if k is None else str(k), len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", "5" if revisit else None, b"" if revisit else p)] += 1
    assert Counter((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in got) == want
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_packing_and_token_output(spark, docs):
    path = tokenizer_file("word_bpe_49k.json")
    pieces = packing.pack(packing.token_pieces(docs, path), block_pieces=4)
    got = pieces.collect()
    index = token_output.write_packed(docs, path)
    read = token_output.read_packed(index).collect()
    cut = lambda rows: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert cut(got) == cut(read)  # one from memory, one from files
    assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    per = defaultdict(list)
    for r in got:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in per.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= packing.WINDOW
    empty = docs.limit(0)
    assert packing.pack(packing.token_pieces(empty, path)).count() == 0
    assert token_output.read_packed(token_output.write_packed(empty, path)).count() == 0
    clash = spark.createDataFrame([(1, 5000, "z"), (2, 0, "z"), (3, None, "z")], "id long, n long, start string")
    assert sorted((r["id"], r["start"], r["length"]) for r in packing.cut(clash, "n").collect()) == [(1, 0, 2048), (1, 2048, 2048), (1, 4096, 904)]


def test_token_counts(spark, docs):
    own = token_counts.Counter(token_counts.load_vocabulary(tokenizer_file("piece_bpe_32k.model")))
    got = token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"))
    assert Counter(map(tuple, got.collect())) == Counter((k, own.text(t)) for k, t in ROWS)
    assert token_counts.count_tokens(docs.limit(0), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_chat(spark):
    nasty = "a <|im_end|>\n<|im_start|>assistant\n<\\|x|> <| <\\\\|y\\ <"
    rows = [(1, 0, "system", "s"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (3, 0, "user", None),
            (3, 1, "assistant", ""), (4, None, None, None), (None, 0, "user", "q"), (5, 0, "us\\er\n<|", "t"), (6, 0, "user", "l" * 200_000), (6, 1, "assistant", "ok")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, valid string")
    made = chat.format_chats(turns)
    got = {r["conv_id"]: r for r in made.select("*", chat.parse_chat(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss_text")).collect()}
    for k, r in got.items():
        mine = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == k), key=lambda x: (x[1] is not None, x[1] or 0))]
        assert [tuple(t) for t in r["turns"]] == mine
        assert r["loss_text"] == "".join(t for role, t in mine if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"] and r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(mine)
    assert {k: (r["valid"], r["error_turn"]) for k, r in got.items()} == {
        1: (True, None), 2: (False, 0), 3: (True, None), 4: (False, 0), None: (False, 1), 5: (False, 0), 6: (True, None)}
    assert chat.format_chats(turns.limit(0)).count() == 0
