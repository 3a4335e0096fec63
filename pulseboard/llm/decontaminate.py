"""Benchmark decontamination by winnowed fingerprints.

An item window of ``t`` words shares ``t - k + 1`` consecutive k-grams with any document that holds it.  Both
sides keep, of every run of ``w = t - k + 1`` k-gram hashes, the smallest, so both keep the same hash of a shared
window: joining the kept hashes finds every shared span of ``t`` words.  Each place of a joined hash is
then extended word by word to both sides, and counts only where the extended span holds ``t`` equal words.
Items shorter than a window are one window each; each such length present in the benchmark is a pass of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import MATCH_WORDS, barrier, lower_ascii, stored, words_of

WINDOW = 13
GRAM = 5
#: Fingerprints of all items of one window length that are sent to every task at once (about 400 bytes each).
BROADCAST_ROWS = 200_000


def _hashes(words: str, k: int) -> Column:
    """Hash of every k-gram; null where there is none."""
    n = F.size(words) - (k - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(k)])))


def _least(hashes: str, w: int) -> Column:
    """Distinct least hashes of all runs of ``w`` hashes; null where there is no run."""
    n = F.size(hashes) - (w - 1)
    at = lambda i: [F.get(F.col(hashes), i + j) for j in range(w)]
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.least(*at(i)) if w > 1 else at(i)[0])))


def _fingerprints(df: DataFrame, k: int, w: int) -> DataFrame:
    """``df`` (with an array ``__op_words``) with ``__op_grams`` and one row per kept fingerprint ``h``."""
    df = df.withColumn("__op_grams", _hashes("__op_words", k))
    df = df.withColumn("__op_kept", _least("__op_grams", w))
    # outer: else a filter on the array's size is pushed below and computes the fingerprints again
    return df.select("*", F.explode_outer("__op_kept").alias("h")).drop("__op_kept").where("h IS NOT NULL")


def _places(df: DataFrame, k: int, w: int, prefix: str) -> DataFrame:
    """One row per place of ``h``: pos, and its k-gram with up to ``w - 1`` words on either side, nearest first."""
    words, p = F.col("__op_words"), F.col("pos")
    where = F.filter(F.transform("__op_grams", lambda x, i: F.when(x == F.col("h"), i)), lambda i: i.isNotNull())
    df = df.withColumn("__op_at", where).withColumn("pos", F.explode_outer("__op_at"))
    return df.withColumns({
        f"{prefix}left": F.reverse(F.slice(words, F.greatest(p - (w - 2), F.lit(1)), F.least(p, F.lit(w - 1)))),
        f"{prefix}gram": F.slice(words, p + 1, k), f"{prefix}right": F.slice(words, p + k + 1, w - 1)}).drop("__op_words", "__op_grams", "__op_at")


def _common(a: str, b: str) -> Column:
    """Number of leading words that two arrays share."""
    differ = F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: ~x)
    short = F.least(F.size(a), F.size(b))
    at = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(F.size(differ) == 0, short).otherwise(at.cast("int") - 1)


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit, n_items, items (sorted ids as strings), contaminated; one row per input row.

    A document word is hit if it lies in an occurrence of an item window; contaminated: at least one hit word and
    20 * n_hit >= n_words.  Null and empty texts have no words and no windows; an item without words matches
    nothing; a null item id is not listed in ``items``.  Documents are told apart by id and text, so repeated
    rows get equal results.  Extra columns of either side are untouched.  The item side is counted and sent to
    the documents in blocks of about ``broadcast_rows`` fingerprints (one pass over the documents per block), so documents
    are never shuffled; only their verified hits are.
    """
    key = ["__op_id", "__op_th"]
    d = docs.select(F.col(f"`{doc_id}`").alias("__op_id"), F.xxhash64(f"`{doc_text}`").alias("__op_th"),
                    words_of(lower_ascii(F.col(f"`{doc_text}`")), MATCH_WORDS).alias("__op_words"))
    i = items.select(F.col(f"`{item_id}`").cast("string").alias("__op_item"), words_of(lower_ascii(F.col(f"`{item_text}`")), MATCH_WORDS).alias("__op_words"))
    i = i.withColumn("__op_t", F.least(F.size("__op_words"), F.lit(window))).where("__op_t > 0")
    lengths = sorted(r[0] for r in i.select("__op_t").distinct().collect())  # at most `window` numbers
    hits = None
    for t in lengths:
        k = min(gram, t)
        w = t - k + 1
        fp = _places(_fingerprints(i.where(F.col("__op_t") == t).select("__op_item", "__op_words"), k, w), k, w, "i_")
        fp = stored(fp.select("h", "i_gram", "i_left", "i_right", "__op_item").distinct(), "item-fingerprints")
        blocks = -(-fp.count() // broadcast_rows)
        for block in range(blocks):
            part = F.broadcast(fp.where(F.pmod("h", F.lit(blocks)) == block) if blocks > 1 else fp)
            # only a document with a kept hash of the benchmark goes on; the words stay in its row until then
            found = _fingerprints(d, k, w).join(F.broadcast(part.select("h").distinct()), "h", "left_semi")
            found = _places(found, k, w, "").join(part, "h").where(F.col("gram") == F.col("i_gram"))
            found = found.withColumns({"l": _common("left", "i_left"), "r": _common("right", "i_right")}).where(F.col("l") + F.col("r") + k >= t)
            found = found.select(*key, "__op_item", (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + k + F.col("r")).alias("b"))
            hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = d.select(*key, F.lit("").alias("__op_item"), F.lit(0).alias("a"), F.lit(0).alias("b")).where(F.lit(False))
    # per document: its spans (fewer than 200 for each of its words, whatever the benchmark) and its items
    per_doc = hits.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"), F.sort_array(F.collect_set("__op_item")).alias("found"))
    union = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end")), lambda s: s["n"])
    per_doc = per_doc.select(F.col("__op_id").alias("__op_id2"), F.col("__op_th").alias("__op_th2"), union.cast("long").alias("__op_hit"), F.col("found").alias("__op_found"))
    base = docs.withColumns({"__op_id": F.col(f"`{doc_id}`"), "__op_th": F.xxhash64(f"`{doc_text}`"),
                             "__op_n": F.size(words_of(lower_ascii(F.col(f"`{doc_text}`")), MATCH_WORDS)).cast("long")})
    joined = base.join(per_doc, F.col("__op_id").eqNullSafe(F.col("__op_id2")) & (F.col("__op_th") == F.col("__op_th2")), "left")
    hit = F.coalesce("__op_hit", F.lit(0).cast("long"))
    found = F.coalesce("__op_found", F.array().cast("array<string>"))
    return barrier(joined, docs.columns, {
        "n_words": F.col("__op_n"), "n_hit": hit, "n_items": F.size(found).cast("long"), "items": found,
        "contaminated": (hit > 0) & (20 * hit >= F.col("__op_n"))})
