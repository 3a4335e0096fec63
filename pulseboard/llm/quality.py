"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Each rule rejects a document by one predicate over a few counters.  A bounded sample gives, per rule,
the share it rejects and the time its counters take; rules then run in descending rejections per second, and
a counter that only later rules need is not computed for a document already rejected (``CASE WHEN`` does
not evaluate the branches it skips).  The order changes the work and ``rejected_by``, never ``kept``.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import SPACE_WORDS, barrier, stored, words_of

#: Words in a window of the repetition counter.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTERS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``reject`` is SQL over the counters named in ``needs``; a null counts as not rejected."""

    name: str
    needs: tuple[str, ...]
    reject: str


#: The two base rules, then rules on markup, repeated lines and word length.
RULES = (
    Rule("few_words", ("n_words",), "n_words < 20"),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", ("word_chars", "n_symbols"), "100 * n_symbols > 10 * word_chars"),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
)
#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2000


def _steps() -> list[tuple[str, tuple[str, ...], Column]]:
    """(column, counters that need it, expression); each step reads the columns of those before."""
    c = lambda n: F.col(f"__op_{n}")
    repeat = ("n_repeat_words",)
    windows = F.when(F.size(c("words")) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(c("words")) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(c("words"), i, WINDOW))))
    twice = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    ordered = F.when(twice, F.sort_array(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    same = lambda x, k: (x["h"] == F.get(c("ordered"), k - 1)["h"]) | (x["h"] == F.get(c("ordered"), k + 1)["h"])
    starts = F.sort_array(F.transform(F.filter(c("ordered"), lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"]))
    covered = F.aggregate(
        c("starts"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end")),
        lambda a: a["n"])
    has_word = lambda x: x.rlike(r"\S")
    every_word = ("n_words", "word_chars", "n_repeat_words")
    line = ("n_lines", "n_dup_lines")
    return [
        ("words", every_word, words_of(c("text"), SPACE_WORDS)),
        ("n_words", ("n_words",), F.size(c("words")).cast("long")),
        ("word_chars", ("word_chars",), F.length(F.array_join(c("words"), "")).cast("long")),
        ("n_symbols", ("n_symbols",), F.length(F.regexp_replace(c("text"), f"[^{SYMBOLS}]", "")).cast("long")),
        ("lines", line, F.filter(F.split(c("text"), "\n"), has_word)),
        ("n_lines", ("n_lines",), F.size(c("lines")).cast("long")),
        ("n_dup_lines", ("n_dup_lines",), (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long")),
        ("windows", repeat, windows),
        ("ordered", repeat, ordered),
        ("starts", repeat, starts),
        ("n_repeat_words", repeat, F.coalesce(covered, F.lit(0)).cast("long")),
    ]


def _add(df: DataFrame, needs: Sequence[str], done: set[str], only_if: Column | None = None) -> DataFrame:
    for name, users, expr in _steps():
        if name not in done and set(users) & set(needs):
            df = df.withColumn(f"__op_{name}", expr if only_if is None else F.when(only_if, expr))
            done.add(name)
    return df


def _rejects(rule: Rule) -> Column:
    sql = rule.reject
    for n in sorted(COUNTERS, key=len, reverse=True):
        sql = sql.replace(n, f"__op_{n}") if f"__op_{n}" not in sql else sql
    return F.coalesce(F.expr(sql), F.lit(False))


def order_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Rules with their measured ``selectivity`` and ``cost`` (seconds on the sample), best first.

    The sample holds about ``sample_rows`` rows, drawn over the whole table and written once.
    An empty sample keeps the given order.
    """
    n = docs.count()
    share = 1.0 if n <= sample_rows else sample_rows / n
    sample = stored(docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__op_text")).sample(share, seed=7), "rule-sample")
    frames = [_add(sample, r.needs, set()).select(_rejects(r).alias("r")) for r in rules]

    def seconds(df: DataFrame) -> float:
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    base = sample.select(F.length("__op_text"))
    seconds(base)
    floor = seconds(base)
    out = []
    for rule, df in zip(rules, frames, strict=True):
        hits, rows = df.agg(F.count_if("r"), F.count(F.lit(1))).first()  # compiles the code that is timed next
        out.append({"rule": rule, "selectivity": hits / rows if rows else 0.0, "cost": max(seconds(df) - floor, 1e-3)})
    return sorted(out, key=lambda x: -x["selectivity"] / x["cost"])


def quality_cascade(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, order: Sequence[Rule] | None = None,
                    all_counters: bool = False, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` plus ``rejected_by`` (null if kept) and ``kept``; no row is dropped.

    ``all_counters`` also returns every counter for every row (then nothing is skipped).
    A null or empty text has zero words, lines and symbols.  Rows are judged alone, so repeated rows get equal
    verdicts; an empty table gives an empty result.  No shuffle: counters are expressions
    over one row, in time near-linear in its text (the windows are sorted only where one occurs twice, and are
    compared by 64-bit hash).
    """
    order = list(order) if order is not None else [x["rule"] for x in order_rules(docs, text, rules, sample_rows)]
    df, done = docs.withColumn("__op_text", F.coalesce(F.col(f"`{text}`"), F.lit(""))), set()
    if all_counters:
        df = _add(df, COUNTERS, done)
    df = df.withColumn("__op_by", F.lit(None).cast("string"))
    for rule in order:
        df = _add(df, rule.needs, done, None if all_counters else F.col("__op_by").isNull())
        df = df.withColumn("__op_by", F.when(F.col("__op_by").isNotNull(), F.col("__op_by")).when(_rejects(rule), F.lit(rule.name)))
    made = {"rejected_by": F.col("__op_by"), "kept": F.col("__op_by").isNull()}
    if all_counters:
        made |= {n: F.col(f"__op_{n}") for n in COUNTERS}
    return barrier(df, docs.columns, made)
