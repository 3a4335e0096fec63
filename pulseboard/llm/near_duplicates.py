"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact comparison decides.

Every text becomes the set of its hashed five-word shingles.  Texts with equal sets are one node from there on.  Each of ``TREES`` tries
orders the nodes by its own sequence of minhash values.  Nodes under one prefix of a trie are candidates, and matched prefixes are
shortened from ``DEPTH`` values until a pair at the threshold shares one in some trie with at least the target probability (``prefix_length``).

Where a node first matches says where it is compared.  Nodes that share whole prefixes (``DEPTH`` values) are chained, and such a
chain is one home, so many near copies have one; any other node goes to the home of the least node under its deepest shared prefix, and nobody
follows it there, so chance matches of short prefixes connect nothing.  Then a home moves into the largest one that it shares a prefix with, so
that few small homes are left around a large group.  Nodes of a home are dealt into blocks of bounded size.  Two blocks meet only if a prefix of the last level holds nodes of both, and only these
nodes go there.  So each pair is compared in one place, and what is compared is bounded by the prefix groups, not by
what chains of chance matches connect.  A unit counts shingles that its texts share by a
matrix product, adds up each text's links, and returns a spanning forest of them - one row per text and unit, not per pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, values
from pulseboard.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
HASHES, TREES, DEPTH = 128, 48, 16
#: Values that a shortening step takes off a matched prefix.
STEP = 3
RECALL = 0.999
#: Nodes and shingles of a block, about; a unit compares two blocks in one task (some 50 MB of arrays).
BLOCK, BLOCK_SHINGLES = 1024, 500_000
#: Rows up to which node lists are sent to every task to fetch their texts (under 100 bytes each); beyond, texts are shuffled.
BROADCAST_ROWS = 500_000
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CACHE = 100_000


def forest_recall(similarity: float, prefix: int, trees: int = TREES, hashes: int = HASHES) -> float:
    """The probability that a pair shares a prefix in some trie.  All tries draw from the same minhashes, so they are not
    independent: of ``hashes`` values m agree (binomial), and a trie's prefix is a draw of ``prefix`` of them without replacement."""
    return 1 - sum(comb(hashes, m) * similarity**m * (1 - similarity) ** (hashes - m) * (1 - comb(m, prefix) / comb(hashes, prefix)) ** trees for m in range(hashes + 1))


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, hashes: int = HASHES) -> int:
    """The longest prefix, at most ``depth``, that a pair at the threshold shares in some trie with probability ``recall`` (1 if none does)."""
    return next((k for k in range(depth, 1, -1) if forest_recall(threshold, k, trees, hashes) >= recall), 1)


class Shingler:
    def __init__(self, size: int = SHINGLE):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Hashes of the distinct shingles, ascending; a text of fewer words is one shingle; without words, none."""
        from xxhash import xxh3_64_intdigest
        words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(h))
        g = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            g = g * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - n + 1 + k]
        g ^= g >> np.uint64(32)
        g *= np.uint64(0x9E3779B97F4A7C15)
        g ^= g >> np.uint64(29)
        return np.unique(g)


class Forest:
    """Minhash values of a set, and the keys of its prefixes in every trie."""

    def __init__(self, seed: int = 20):
        r = np.random.RandomState(seed)
        self.a = (r.randint(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = r.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
        self.order = np.stack([r.permutation(HASHES)[:DEPTH] for _ in range(TREES)])
        self.mix = r.randint(0, 1 << 63, (TREES, DEPTH), dtype=np.uint64) | np.uint64(1)
        self.salt = r.randint(0, 1 << 63, TREES, dtype=np.uint64)

    def minhashes(self, shingles: np.ndarray) -> np.ndarray:
        h, low = (shingles >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(h), 2048):
            low = np.minimum(low, (h[i:i + 2048, None] * self.a + self.b).min(axis=0))
        return low

    def keys(self, minhashes: np.ndarray, level: int) -> np.ndarray:
        """The key of the first ``level`` values in every trie; keys of different levels differ."""
        order, mix = self.order[:, :level], self.mix[:, :level]
        k = (minhashes.astype(np.uint64)[order] * mix).sum(axis=1, dtype=np.uint64) + self.salt * np.uint64(2 * level + 1)
        k ^= k >> np.uint64(31)
        return ((k * np.uint64(0x9E3779B97F4A7C15)) ^ self.salt).view(np.int64)


def shortened(prefix: int, depth: int = DEPTH, step: int = STEP) -> list[int]:
    """The levels from the deepest down to, and without, the last one (only the last one, if it is the deepest)."""
    return list(range(depth, prefix, -step)) or [prefix]


def _prefix_keys(nodes: DataFrame, levels: list[int]) -> DataFrame:
    """(node, level, prefix): the keys of nodes (with their ``minhashes``) in every trie on each of the levels."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                ids = np.repeat(part.column("node").to_numpy(), len(levels) * TREES)
                found = [forest.keys(np.frombuffer(m, np.uint32), n) for m in part.column("minhashes").to_pylist() for n in levels]
                each = np.tile(np.repeat(np.array(levels, np.int32), TREES), part.num_rows)
                yield pa.record_batch([pa.array(ids), pa.array(each), pa.array(np.concatenate(found))], names=["node", "level", "prefix"])

    return nodes.select("node", "minhashes").mapInArrow(keys, "node long, level int, prefix long")


def candidate_blocks(nodes: DataFrame, prefix: int) -> DataFrame:
    """(node, block, other): every node that shares a prefix of the last level, its block, and each block that it meets (its own one
    too).  ``nodes``: node, minhashes, shingles.  Two nodes that share a prefix are in one block or are both sent to the other's."""
    under = stored(_prefix_keys(nodes, [prefix]).select("node", "prefix"), "prefixes")
    crowded = under.groupBy("prefix").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix", "first")
    # a node twice under one prefix (two tries with equal keys) does no harm: the pair is compared once anyway
    matched = stored(under.join(crowded, "prefix").select("node", "prefix", "first"), "matched")
    last = matched.groupBy("node").agg(F.min("first").alias("first"))
    deep = _prefix_keys(nodes.join(last.select("node"), "node", "left_semi"), shortened(prefix))
    deep = stored(deep, "deep-prefixes")
    shared = deep.groupBy("level", "prefix").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    longer = stored(deep.join(shared, ["level", "prefix"]).select("node", "level", "first").distinct(), "longer")
    deepest = longer.unionByName(last.withColumn("level", F.lit(prefix))).groupBy("node").agg(F.min(F.struct((-F.col("level")).alias("l"), "first")).alias("h"))
    # of a node's several least nodes, all to the least of them: about an edge each and not one per trie
    firsts = longer.where(F.col("level") == shortened(prefix)[0]).groupBy("node").agg(F.collect_set("first").alias("firsts"))
    chains = firsts.select(F.explode(F.array_union("firsts", F.array("node"))).alias("a"), F.array_min("firsts").alias("b")).where("a != b").distinct()
    chained = connected_components(chains)
    homes = deepest.select("node", F.col("h.first").alias("first")).join(chained.withColumnRenamed("node", "first"), "first", "left")
    homes = homes.select("node", F.coalesce("label", "first").alias("home"))
    homes = stored(homes.join(nodes.select("node", "shingles"), "node"), "homes")
    # a home moves into the largest one that it shares a prefix of the last level with, if that is larger (nobody follows it there):
    # else each node of a large home meets all the small ones around it, every one of them a block
    sized = homes.join(homes.groupBy("home").agg(F.count(F.lit(1)).alias("size")), "home").select("node", "home", "size")
    met = stored(matched.select("node", "prefix").join(sized, "node").select("prefix", "home", "size").distinct(), "met")
    largest = met.groupBy("prefix").agg(F.max(F.struct("size", "home")).alias("to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    moves = met.join(largest, "prefix").groupBy("home").agg(F.max("to").alias("to")).select("home", F.col("to.home").alias("host"))
    homes = stored(homes.join(moves, "home", "left").select("node", F.coalesce("host", "home").alias("home"), "shingles"), "moved-homes")
    sizes = homes.groupBy("home").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).alias("blocks"))
    placed = homes.join(sizes, "home").select("node", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block"))
    placed = stored(placed, "blocks")
    at = matched.select("node", "prefix").join(placed, "node")
    # prefixes of near copies hold the same blocks: a node meets each distinct set of blocks once, not once per trie
    held = stored(at.select("prefix", "block").distinct(), "held")
    name = [F.bit_xor(F.xxhash64("block")).alias("x"), F.bit_xor(F.xxhash64("block", F.lit(1))).alias("y")]
    mixed = held.groupBy("prefix").agg(*name, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    others = held.join(mixed, "prefix").select("x", "y", F.col("block").alias("other")).distinct()
    meets = at.join(mixed, "prefix").select("node", "block", "x", "y").distinct().join(others, ["x", "y"])
    meets = meets.select("node", "block", "other").where("block != other")
    return placed.withColumn("other", F.col("block")).unionByName(meets.distinct())


def compare(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray | None, threshold: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(linked texts, linked documents, index of the component's first text) per set; with ``side`` (two values), only pairs across it."""
    total, n = len(sets), np.array([len(s) for s in sets], np.int64)
    left = np.ones(total, bool) if side is None else side == side[0]
    a, b = np.flatnonzero(left), np.arange(total) if side is None else np.flatnonzero(~left)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(total), n)
    shared = df[column] > 1
    row, (used, column) = row[shared], np.unique(column[shared], return_inverse=True)
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    both, step = np.zeros((len(a), len(b)), np.float32), 2048
    for c in range(0, len(used), step):
        lo, hi = np.searchsorted(column, (c, c + step))
        m = np.zeros((total, min(step, len(used) - c)), np.float32)
        m[row[lo:hi], column[lo:hi] - c] = 1
        both += m @ m.T if side is None else m[a] @ m[b].T
    p, q = threshold.numerator, threshold.denominator
    linked = np.zeros(both.shape, bool)
    for i in range(0, len(a), 256):
        linked[i:i + 256] = both[i:i + 256].astype(np.int64) * (p + q) >= p * (n[a[i:i + 256], None] + n[b])
    if side is None:
        np.fill_diagonal(linked, False)
    texts, documents = np.zeros(total, np.int64), np.zeros(total, np.int64)
    texts[b], documents[b] = linked.sum(axis=0), copies[a] @ linked
    texts[a], documents[a] = linked.sum(axis=1), linked @ copies[b]
    first = np.arange(total)
    while True:
        least = first.copy()
        least[b] = np.minimum(first[b], np.where(linked, first[a][:, None], total).min(axis=0, initial=total))
        least[a] = np.minimum(least[a], np.where(linked, first[b], total).min(axis=1, initial=total))
        least = least[least]
        if (least == first).all():
            return texts, documents, first
        first = least


JOINED = ("doc_id", "text_hash", "class_id", "n_links", "n_text_links")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, text_hash (xxhash64 of the text), class_id, n_links, n_text_links.

    Two documents are linked if the Jaccard similarity of their shingle sets is at least ``threshold``.  ``class_id``
    is the least doc_id among documents connected by links; ``n_links`` counts linked documents, copies included, and ``n_text_links``
    linked sets other than the own one.  Null and empty texts, and texts without words, are linked to nothing
    and are classes of their own (class_id is their doc_id).  Null ids are allowed; a class of null ids alone has
    a null class_id.  Repeated rows are copies.  An empty table gives an empty result; other columns are ignored.

    Only a verified link joins classes, and copies are carried as counts.  What a prefix group costs beyond its
    own size is comparing its texts, spread over units of at most about two blocks.
    """
    return classes(docs, doc_id, text, threshold).select(*JOINED)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``jaccard_join`` with ``class_hash``: class_id and class_hash are the id and text_hash of the class's least
    document (null ids last).  Both name the class: an id alone does not, as classes may share it.  A text without words has no class_hash."""
    fraction = Fraction(threshold).limit_denominator(1000)
    prefix = prefix_length(threshold)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, forest = Shingler(), Forest()
        for batch in batches:
            keys, low, sizes = [], [], []
            for t in values(batch, "text"):
                s = shingles(t)
                keys.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sizes.append(len(s))
                low.append(forest.minhashes(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), pa.array(low, pa.binary()), pa.array(sizes, pa.int64())],
                                  names=["doc_id", "text_hash", "set_key", "minhashes", "shingles"])

    signed = stored(source.mapInArrow(sign, f"doc_id {id_type}, text_hash long, set_key binary, minhashes binary, shingles long"), "signatures")
    nodes = signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("minhashes").alias("minhashes"), F.any_value("shingles").alias("shingles"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", "least.doc_id", "least.text_hash", "copies", "least", "minhashes", "shingles"), "nodes")

    asked = candidate_blocks(nodes, prefix).join(nodes.select("node", "doc_id", "text_hash", "copies"), "node")
    asked = stored(asked.select("node", "block", "other", F.col("doc_id").alias("rep_id"), F.col("text_hash").alias("rep_hash"), "copies"), "candidates")
    wanted = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    texts = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash")))
    units = texts.select(F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "copies", "text")
    units = units.repartition("lo", "hi").sortWithinPartitions("lo", "hi", "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, unit, rows = Shingler(), None, {}

        def table(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * 4
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["node", "root", "texts", "documents"])

        def done() -> list[tuple[int, int, int, int]]:
            if len(rows) < 2:
                return []
            ids = np.array(list(rows))
            sets, blocks, copies = zip(*rows.values(), strict=True)
            side = None if unit[0] == unit[1] else np.array(blocks)
            texts_, docs_, first = compare(list(sets), np.array(copies), side, fraction)
            at = np.flatnonzero(texts_)
            return list(zip(ids[at].tolist(), ids[first[at]].tolist(), texts_[at].tolist(), docs_[at].tolist(), strict=True))

        for batch in batches:
            out = []
            for lo, hi, block, node, copies, t in values(batch, "lo", "hi", "block", "node", "copies", "text"):
                if (lo, hi) != unit:
                    out += done()
                    unit, rows = (lo, hi), {}
                if node not in rows:  # a repeated row brings its text twice
                    rows[node] = (shingles(t), block, copies)
            yield table(out)
        yield table(done())

    found = stored(units.mapInArrow(verify, "node long, root long, texts long, documents long"), "links")
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    least = joined.join(nodes.select("node", "least"), "node").groupBy("label").agg(F.min("least").alias("first"))
    labels = joined.join(least, "label").join(totals, "node").select("node", "first", "texts", "documents")
    judged = nodes.select("node", "set_key", "copies", "least").join(labels, "node", "left").withColumn("first", F.coalesce("first", "least")).select(
        "set_key", F.col("first.doc_id").alias("class_id"), F.col("first.text_hash").alias("class_hash"),
        (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"))
    return signed.select("doc_id", "text_hash", "set_key").join(judged, "set_key", "left").select(
        "doc_id", "text_hash", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "class_hash",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("n_text_links", F.lit(0).cast("long")).alias("n_text_links"))


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are the least document of their class (by id, null ids last, then text_hash); texts without words
    all stay; of repeated rows one stays.  Ids may be null or repeated: classes that share their least id keep a document each."""
    c = stored(classes(docs, doc_id, text, threshold), "classes")
    ids = (F.col("doc_id").alias("__op_id2"), F.col("text_hash").alias("__op_th2"))
    least = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    gone = c.where(F.col("class_hash").isNotNull() & ~least).select(*ids).distinct()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    mark = docs.withColumns({"__op_id": F.col(f"`{doc_id}`"), "__op_th": F.xxhash64(f"`{text}`")})
    same = lambda: F.col("__op_id").eqNullSafe(F.col("__op_id2")) & (F.col("__op_th") == F.col("__op_th2"))
    left = mark.join(gone, same(), "left_anti")
    # a class's least document may be there as several rows
    twice = c.where((F.col("n_links") > 0) & least).groupBy(*ids).agg(F.count(F.lit(1)).alias("__op_n")).where("__op_n > 1")
    if twice.limit(1).count():
        repeated = F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice
        hit = left.join(repeated, same(), "left")
        left = hit.where("__op_n IS NULL").unionByName(hit.where("__op_n IS NOT NULL").dropDuplicates(["__op_id", "__op_th"]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
