"""Spelling variants, whitening and sharding against plain versions, on awkward tables."""

import random
from binascii import crc32
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import sharding, spelling, whitening


def near(a, b):
    """Whether one insertion, deletion or replacement turns a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def plain_groups(words, ratio=2):
    out = {}
    for w, n in words.items():
        if not w:
            out[w] = (None, n, 0, None)
            continue
        others = [(-words[o], o) for o in words if o and near(w, o)]
        best = min(others, default=None)
        ok = best is not None and -best[0] >= ratio * n
        out[w] = (best[1] if ok else None, n, len(others), -best[0] if ok else None)
    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w
    return Counter((w, f, root(w), n, c, fn) for w, (f, n, c, fn) in out.items())


def random_words(seed, letters, size, longest, count):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randrange(1, longest))): r.randrange(1, 40) for _ in range(count * size)}


def test_acceptor_is_minimal_and_numbers_its_strings():
    words = sorted(random_words(3, "ab", 1, 8, 120))
    a = spelling.Acceptor(words)
    def strings(q):
        return ([""] if a.final[q] else []) + [x + s for x, (to, _) in a.arcs[q].items() for s in strings(to)]
    assert strings(0) == words and a.count[0] == len(words)
    reached, todo = {0}, [0]
    while todo:
        for to, _ in a.arcs[todo.pop()].values():
            if to not in reached:
                reached.add(to)
                todo.append(to)
    languages = [tuple(strings(q)) for q in reached]
    assert len(languages) == len(set(languages))
    for q in reached:
        for x, (to, at) in a.arcs[q].items():
            assert strings(q)[at] == (x + strings(to)[0])


@pytest.mark.parametrize("letters", ["ab", "aéx", "abcdefgh"])
def test_group_holds_every_near_pair_once(letters):
    for seed in range(6):
        longest = 6
        words = [w for w in random_words(seed, letters, 1, longest, 60) if len(w) in (4, 5)]
        if len(words) < 2:
            continue
        got = {w: (c, n, f) for w, c, n, f in spelling.group_forms(words, list(range(len(words))), 4, 0, 0, 5)}
        for k, w in enumerate(words):
            others = [(-j, o) for j, o in enumerate(words) if near(w, o) and len(w) + len(o) < 10]
            assert got.get(w) == ((len(others), -min(others)[0], min(others)[1]) if others else None)


@pytest.mark.parametrize("most", [2, 20_000])  # with 2, groups are halved down to one free code point
def test_spelling_groups(spark, most):
    words = random_words(1, "abc", 1, 9, 250) | random_words(2, "aé漢😀", 1, 5, 60) | {"x" * 3000: 5, "x" * 3001: 50, "x" * 1500 + "y" + "x" * 1500: 200, "": 7, "colour": 100, "color": 30, "colr": 10, "col": 1}
    table = spark.createDataFrame([(w, n, "z") for w, n in words.items()], "word string, n long, form string").repartition(3)
    got = spelling.spelling_groups(table, most=most, task_words=50)
    assert Counter(map(tuple, got.collect())) == plain_groups(words)


def test_spelling_tables(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_groups(none).count() == 0
    rows = [(1, "Été ÉTÉ a×b÷c x1y"), (None, "Hello hello"), (2, None), (3, ""), (1, "Été"), (4, "z" * 100_000)]
    docs = spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in spelling.run_counts(docs).collect()}
    # only A-Z is lower-cased; the signs between U+00C0 and U+00FF are part of the runs
    assert got == {"Été": 2, "ÉtÉ": 1, "a×b÷c": 1, "x": 1, "y": 1, "hello": 2, "z" * 100_000: 1}


def test_planted_typos(spark):
    import re
    text = " ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é{'x' * (i % 5)}" for i in range(900))
    rows = [(1, text), (-7, text.upper()), (None, text)]
    got = {r["word"]: r["n"] for r in spelling.run_counts(spark.createDataFrame(rows, "doc_id long, text string"), spell=spelling.planted_typo).collect()}
    want = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    assert got == dict(want) and any(v == 1 for v in got.values())


# ------------------------------------------------------------------ whitening
def plain_whitening(vectors, k):
    x = np.array(sorted({tuple(v) for v in vectors}), object)
    n, s = len(x), x.sum(axis=0)
    y = (np.array(x, object) * n - s).astype(float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    return n, s, e[::-1][:k], u[:, ::-1][:, :k], np.trace(v)


def test_fixed_point(spark):
    rows = [([0.5, -0.0078125, 1.0],), ([0.5, None],), ([float("nan")],), ([float("inf"), 1.0],), (None,), ([],), ([1e300, -1e300],)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<double>").select(whitening.fixed_point(F.col("v"))).collect()]
    assert got == [[1_000_032, 999_999, 1_000_064], None, None, None, None, [], [2**52 + 1_000_000, -(2**52) + 1_000_000]]


@pytest.mark.parametrize("spread", [40, 800_000])  # the second takes the exact path of large entries
def test_whitening(spark, spread):
    r = np.random.RandomState(5)
    mix = r.standard_normal((12, 12)) * np.arange(1, 13)
    x = (np.floor(r.standard_normal((300, 12)) @ mix * spread / 40) + 1_000_000).astype(int)
    rows = [(int(i), v.tolist(), "z") for i, v in enumerate(x)] + [(7, x[0].tolist(), "z"), (None, x[1].tolist(), "z"), (2**53 + 1, x[0].tolist(), "z")]
    odd = [(1000, None, "z"), (1001, [], "z"), (1002, [1, 2], "z")]
    table = spark.createDataFrame(rows + odd, "vec_id long, x array<long>, n string").repartition(4)
    got = whitening.whiten(table, components=5).collect()
    n, s, e, u, trace = plain_whitening(x.tolist(), 5)
    assert Counter(r["vec_id"] for r in got) == Counter({k: 5 * c for k, c in Counter(r[0] for r in rows).items()})
    by = defaultdict(dict)
    for g in got:
        by[g["vec_id"], g["deviation"]][g["component"]] = g
    vectors = {}
    for k, v, _ in rows:
        vectors.setdefault(k, []).append(v)
    sign = None
    for (k, deviation), parts in by.items():
        v = next(v for v in vectors[k] if sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) == deviation)  # exact
        want = ((np.array(v) * n - s).astype(float) / n) @ u / np.sqrt(e)
        mine = np.array([parts[c]["whitened"] for c in range(1, 6)])
        sign = np.sign(want * mine) if sign is None else sign
        assert np.allclose(want * sign, mine, atol=1e-9)
        assert np.allclose([parts[c]["explained"] for c in range(1, 6)], e / trace, rtol=1e-10)
    assert {g["n"] for g in got} == {n} and len({g["identity_error"] for g in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_without_spread(spark):
    same = spark.createDataFrame([(1, [5, 5]), (2, [5, 5])], "vec_id long, x array<long>")
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [i, 2 * i, 0]) for i in range(5)], "vec_id long, x array<long>")  # rank 1
    got = whitening.whiten(line).collect()
    assert len(got) == 5 and all(abs(r["explained"] - 1) < 1e-12 and r["component"] == 1 for r in got)
    assert np.isclose(sum(r["whitened"] ** 2 for r in got) / 5, 1)
    huge = spark.createDataFrame([(i, [(-1) ** i * 2**52, i]) for i in range(4)], "vec_id long, x array<long>")
    assert all(r["deviation"] is None for r in whitening.whiten(huge).collect())  # beyond a long


def test_factor_and_rotation():
    r = np.random.RandomState(0)
    for rank in (1, 5, 17):
        f = r.standard_normal((17, rank)) * 10.0 ** r.randint(-4, 3, rank)
        c = f @ f.T
        low, order = whitening.pivoted_cholesky(c)
        assert np.allclose((low @ low.T), c[np.ix_(order, order)]) and np.allclose(low, np.tril(low))
        e, v = whitening.principal(c, 17)
        assert np.allclose((v * e) @ v.T, c) and np.allclose(v.T @ v, np.eye(len(e)), atol=1e-12)
        assert np.allclose(e[:3], np.linalg.eigvalsh(c)[::-1][:len(e[:3])])


# ------------------------------------------------------------------ sharding
def rows_of(n, seed=4):
    r = random.Random(seed)
    return ([(r.choice([i, 5, None]), r.choice(["", None, "é" * r.randrange(400), "w " * r.randrange(3000)])) for i in range(n)]
            + [(77, "copy")] * 700 + [(2**53 + 1, "big id"), (-(2**63) + 1, "low"), (9, "l" * 60_000)])


def test_sharding(spark):
    rows = rows_of(900)
    docs = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, slot string, shard int").repartition(5)
    got = sharding.shard_documents(docs, shards=7, slots=512).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((k, size(t), crc32((t or "").encode())) for k, t in rows)
    by, slots = defaultdict(list), defaultdict(Counter)
    for r in got:
        by[r["shard"]].append(r["slot"])
        slots[r["shard"]][r["virtual_slot"]] += r["size"]
    assert sorted(by) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sum(len(set(s)) for s in slots.values()) == len(set().union(*slots.values()))  # a slot lies in one shard
    loads = sorted(sum(s.values()) for s in slots.values())
    assert loads[-1] - loads[0] < 0.02 * loads[-1]
    assert max(Counter(r["virtual_slot"] for r in got if r["doc_id"] == 77).values()) <= 2 * sharding.TOGETHER
    again = sharding.shard_documents(docs.repartition(2), shards=7, slots=512).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))  # however the rows lie
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_slot_map_versions(spark, tmp_path):
    folder = str(tmp_path / "map")
    docs = spark.createDataFrame(rows_of(900), "doc_id long, text string")
    first = sharding.shard_documents(docs, shards=6, slots=512, folder=folder).collect()
    more = docs.unionByName(spark.createDataFrame([(10_000 + i, "n" * 200) for i in range(60)], "doc_id long, text string"))
    second = sharding.shard_documents(more, shards=6, slots=512, folder=folder).collect()
    assert {r["map_version"] for r in first} == {2} and {r["map_version"] for r in second} == {3}
    v2, v3 = ({r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, folder, v).collect()} for v in (2, 3))
    assert sorted(v2) == list(range(512)) and v3 == {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, folder).collect()}
    loads = {r["virtual_slot"]: r["bytes"] for r in sharding.load_map(spark, folder, 3).collect()}
    assert sum(b for s, b in loads.items() if v2[s] != v3[s]) < 0.1 * sum(loads.values())  # an edit, not a new deal
    seven = sharding.shard_documents(more, shards=7, slots=512, folder=folder).collect()
    assert {r["shard"] for r in seven} == set(range(7))
    old = {(r["doc_id"], r["text_crc32"], r["size"], r["virtual_slot"]): r["shard"] for r in second}
    moved = [r for r in seven if r["shard"] != old[r["doc_id"], r["text_crc32"], r["size"], r["virtual_slot"]]]
    assert len(moved) < len(seven) / 2


def test_rebalance_equals_a_plain_fold(spark):
    r = random.Random(8)
    loads = {v: r.choice([0, 1, r.randrange(5000), 40_000]) for v in range(64) if v % 9}
    table = spark.createDataFrame([(v, b, 1) for v, b in loads.items()], "virtual_slot int, bytes long, records long")
    got = {x["virtual_slot"]: x["shard"] for x in sharding.rebalance(sharding.first_map(spark, 5, 64), table, 5).collect()}
    used, share, want = [0] * 5, -(-sum(loads.values()) // 5), {}
    for v in sorted(range(64), key=lambda v: (-loads.get(v, 0), v)):
        b = loads.get(v, 0)
        to = v % 5 if used[v % 5] + b <= share else used.index(min(used))
        used[to] += b
        want[v] = to
    assert got == want
