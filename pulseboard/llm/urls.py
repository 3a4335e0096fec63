"""URL filter: host and path rules, and a character language-model ratio for the URLs no rule decides.

Two variable-order Markov models (Witten-Bell interpolation of orders 0 to ``order``) are counted on the URLs
that the rules accept and reject.  A URL's score is the difference of its log-likelihoods under the
two, divided by its length.  All rejected URLs are counted; a fifth of the accepted ones stays out of the counts and calibrates the
threshold: the score below which a share ``false_block`` of them falls.

Everything is a join or a grouping of distinct n-grams; counts grow with the URLs, and nothing is sent to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import barrier, stored

#: (host and path prefix, verdict), in the form host/path.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
ORDER = 4
FALSE_BLOCK = 0.01
#: Every CALIBRATION-th accepted URL, by hash, calibrates instead of training.
CALIBRATION = 5
#: Symbols of the order -1 model: the probability of a character never seen is 1 / ALPHABET.
ALPHABET = 256
PAD, END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, F.lit("://"))
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; ties go to the rule that sorts first."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0]), reverse=False):
        h, _, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _grams(u: Column, order: int) -> Column:
    """One (order + 1)-gram per character of a URL and its end, padded at its start."""
    padded = F.concat(F.lit(PAD * order), u, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(u) + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))


def _suffixes(gram: Column, order: int) -> Column:
    """(order k, context, k-gram with its last character) for k = 0 to ``order``."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.substring(gram, F.lit(order + 1 - k), F.lit(k)).alias("ctx"),
                              F.substring(gram, F.lit(order + 1 - k), F.lit(k + 1)).alias("g")) for k in range(order + 1)])


def gram_counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(k, ctx, g, acc, rej, acc_n, rej_n, acc_t, rej_t): counts of the k-gram, of its context and of
    the context's distinct next characters, in accepted and rejected URLs.  ``urls``: u, accepted, n (times it occurs)."""
    full = urls.select(F.explode_outer(_grams(F.col("u"), order)).alias("g"), "accepted", "n")
    full = full.groupBy("g").agg(F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("acc"),
                                 F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("rej"))
    every = full.select(F.inline(_suffixes(F.col("g"), order)), "acc", "rej")
    every = every.groupBy("k", "ctx", "g").agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej"))
    ctx = every.groupBy("k", "ctx").agg(F.sum("acc").alias("acc_n"), F.sum("rej").alias("rej_n"),
                                        F.count_if(F.col("acc") > 0).alias("acc_t"), F.count_if(F.col("rej") > 0).alias("rej_t"))
    return every.join(ctx, ["k", "ctx"])


def score_urls(urls: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls`` (distinct u) with ``score``: mean log ratio of accepted to rejected per character (end included)."""
    pos = urls.select("u", F.explode_outer(_grams(F.col("u"), order)).alias("gram"))
    pos = pos.groupBy("u", "gram").agg(F.count(F.lit(1)).alias("times"))
    grams = pos.select("gram").distinct().select("gram", F.inline(_suffixes(F.col("gram"), order)))
    ctx = counts.select("k", "ctx", "acc_n", "rej_n", "acc_t", "rej_t").distinct()
    seen = counts.select("k", "g", "acc", "rej")
    levels = grams.join(ctx, ["k", "ctx"]).join(seen, ["k", "g"], "left")
    levels = levels.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct(
        "k", F.coalesce("acc", F.lit(0)).alias("acc"), F.coalesce("rej", F.lit(0)).alias("rej"), "acc_n", "rej_n", "acc_t", "rej_t"))).alias("levels"))

    def step(p: Column, c: Column, n: Column, t: Column) -> Column:
        return F.when(n > 0, (c + t * p) / F.greatest(n + t, F.lit(1))).otherwise(p)

    flat = F.lit(1.0 / ALPHABET)
    ratio = F.aggregate(
        "levels", F.struct(flat.alias("a"), flat.alias("r")),
        lambda p, x: F.struct(step(p["a"], x["acc"], x["acc_n"], x["acc_t"]).alias("a"), step(p["r"], x["rej"], x["rej_n"], x["rej_t"]).alias("r")),
        lambda p: F.log(p["a"]) - F.log(p["r"]))
    rated = levels.select("gram", F.round(ratio * 1e9).cast("long").alias("nano"))
    total = pos.join(rated, "gram", "left").groupBy("u").agg(F.sum(F.coalesce("nano", F.lit(0)) * F.col("times")).alias("nano"))
    return total.select("u", (F.col("nano") / 1e9 / (F.length("u") + 1)).alias("score"))


def filter_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER,
                false_block: float = FALSE_BLOCK) -> DataFrame:
    """All columns of ``pages`` plus host, path, rule, score, verdict; one row per input row.

    The models see host and path.  ``score`` is null where a rule decides; an undecided URL is blocked if its score is
    below the calibrated threshold.  A null url, or one without ``://``, has empty host and path and is scored as an
    empty string.  With no accepted or no rejected URL to learn from, or no accepted one held out, undecided URLs are allowed.
    Equal URLs get equal results however often they occur; n-grams are counted per occurrence.  Scores are summed as
    whole billionths, so no result depends on the order of additions.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    base = pages.withColumns({"__op_host": host, "__op_path": path})
    rule, verdict = match_rule(F.col("__op_host"), F.col("__op_path"), rules)
    base = base.withColumns({"__op_rule": rule, "__op_verdict": verdict, "__op_u": F.concat("__op_host", "__op_path")})
    urls = base.groupBy(F.col("__op_u").alias("u"), F.col("__op_verdict").alias("known")).agg(F.count(F.lit(1)).alias("n"))
    urls = stored(urls.withColumn("held", (F.col("known") == "allow") & (F.pmod(F.xxhash64("u"), F.lit(CALIBRATION)) == 0)), "urls")
    counts = stored(gram_counts(urls.where("known IS NOT NULL AND NOT held").select("u", (F.col("known") == "allow").alias("accepted"), "n"), order), "url-grams")
    asked = urls.where("known IS NULL OR held")
    scores = stored(asked.join(score_urls(asked.select("u").distinct(), counts, order), "u"), "url-scores")
    learnt = counts.where("k = 0").agg((F.sum("acc") > 0).alias("a"), (F.sum("rej") > 0).alias("r")).first()
    row = scores.where("known = 'allow'").agg(F.percentile("score", false_block, F.col("n")).alias("t")).first()
    threshold = row["t"] if learnt["a"] and learnt["r"] else None
    own = scores.where("known IS NULL").select(F.col("u").alias("__op_u2"), F.col("score").alias("__op_score"))
    joined = base.join(own, (F.col("__op_u") == F.col("__op_u2")) & F.col("__op_verdict").isNull(), "left")
    judged = F.when(F.col("__op_score") < threshold, F.lit("block")).otherwise(F.lit("allow")) if threshold is not None else F.lit("allow")
    return barrier(joined, pages.columns, {
        "host": F.col("__op_host"), "path": F.col("__op_path"), "rule": F.col("__op_rule"),
        "score": F.col("__op_score"), "verdict": F.coalesce("__op_verdict", judged)})
