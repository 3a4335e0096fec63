"""Spelling variants: words at one edit, found by composing automata.

Two words at one edit, the shorter of c code points, share either their first c // 2 code points or their last.  So every word joins
the groups of its leading and of its trailing half, once with itself as the shorter and once as the longer word.  A group's words are
what the vocabulary's acceptor accepts from the state that the shared half leads to; this part of the acceptor is built minimised
and composed with a one-edit transducer and with itself, and the accepted pairs are enumerated.  A pair is accepted in the one group that its
first differing place belongs to, so none is found twice.  Groups of more than ``MOST`` words are halved again: their words share
a longer start or end, until only one code point is free.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import lower_ascii, stored, values

RUN = r"[a-z\x{C0}-\x{FF}]+"
#: Words of a group beyond which it is halved again, and words that a task gets on average.
MOST, TASK_WORDS = 20_000, 100_000
KEY = ("c", "p", "s", "bound", "head", "tail")


class Acceptor:
    """The minimal acyclic automaton of ascending distinct strings.  A state numbers the strings it accepts in ascending order:
    ``arcs[q]`` maps a label to (next state, number of the first string through it)."""

    def __init__(self, strings: list[str]):
        self.final, self.arcs, self.count = [False], [{}], [0]
        #: Least and greatest length of what a state accepts.
        self.low, self.high = [0], [0]
        known, path, before = {}, [0], ""
        for s in strings:
            n = min(len(s), len(before))
            same = next((k for k in range(n) if s[k] != before[k]), n)
            self._settle(path, before, same, known)
            for label in s[same:]:
                self.final.append(False)
                self.arcs.append({})
                self.count.append(0)
                self.low.append(0)
                self.high.append(0)
                self.arcs[path[-1]][label] = (len(self.arcs) - 1, 0)
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            before = s
        self._settle(path, before, -1, known)

    def _settle(self, path: list[int], labels: str, upto: int, known: dict) -> None:
        """Finish the states of the path beyond ``upto``, each replaced by an equal one where there is one."""
        for k in range(len(path) - 1, upto, -1):
            q, at, low, high = path[k], int(self.final[path[k]]), [0] * self.final[path[k]], [0] * self.final[path[k]]
            for label, (to, _) in self.arcs[q].items():
                self.arcs[q][label] = (to, at)
                at += self.count[to]
                low.append(self.low[to] + 1)
                high.append(self.high[to] + 1)
            self.count[q], self.low[q], self.high[q] = at, min(low, default=0), max(high, default=0)
            if k:
                same = known.setdefault((self.final[q], tuple(self.arcs[q].items())), q)
                self.arcs[path[k - 1]][labels[k - 1]] = (same, 0)
        del path[upto + 1:]

    def meet(self, a: int, b: int) -> bool:
        """Whether two states may accept strings of one length (a group's lengths differ by one at most, so this is exact)."""
        return self.low[a] <= self.high[b] and self.low[b] <= self.high[a]

    def one_edit(self, below: int, after: str = "") -> Iterator[tuple[int, int]]:
        """Numbers of all accepted pairs at one edit whose first difference is at a place before ``below``; ``after`` is the label that
        follows every string (empty: none does).  Of two strings of the greater length only those that share their way with lesser ones appear.

        The transducer copies labels, then replaces one (the lesser label on the left) or inserts one on the right, then copies again.
        After an insertion the next label must differ from the inserted one, so that of several readings only the last is taken."""
        walk, least = [(0, 0, 0)], self.low[0]
        while walk:
            q, i, depth = walk.pop()
            arcs = [(x, to, i + at) for x, (to, at) in self.arcs[q].items()]
            for k, (x, to, at) in enumerate(arcs):
                if depth + 1 < below and self.count[to] > 1:
                    walk.append((to, at, depth + 1))
                for _, to2, at2 in arcs[k + 1:] if self.low[to] + depth < least else ():
                    if self.meet(to, to2):
                        yield from self._copy(to, at, to2, at2, None, after)
                if self.meet(q, to):
                    yield from self._copy(q, i, to, at, x, after)

    def _copy(self, a: int, i: int, b: int, j: int, not_next: str | None, after: str) -> Iterator[tuple[int, int]]:
        walk = [(a, i, b, j)]
        while walk:
            a, i, b, j = walk.pop()
            if a == b:
                yield from zip(range(i, i + self.count[a]), range(j, j + self.count[a]), strict=True)
                continue
            if self.final[a] and self.final[b] and (not_next is None or not_next != after):
                yield i, j
            other = self.arcs[b]
            for x, (to, at) in self.arcs[a].items():
                if x in other and x != not_next:
                    to2, at2 = other[x]
                    if self.meet(to, to2):
                        walk.append((to, i + at, to2, j + at2))
            not_next = None


def group_forms(words: list[str], n: list[int], c: int, p: int, s: int, bound: int) -> list[tuple[str, int, int, str]]:
    """(word, near words, n of the best of them, the best) of a group's words, of c and c + 1 code points, that share their first p and
    last s.  Pairs of two longer words belong to the group in which they are the shorter ones."""
    middles = sorted((w[p:len(w) - s], k) for k, w in enumerate(words))
    place = [k for _, k in middles]
    near, best = [0] * len(words), [None] * len(words)
    after = words[0][len(words[0]) - s] if s else ""
    for i, j in Acceptor([m for m, _ in middles]).one_edit(bound - p, after):
        i, j = place[i], place[j]
        if len(words[i]) + len(words[j]) > 2 * c + 1:
            continue
        for a, b in ((i, j), (j, i)):
            near[a] += 1
            form = (-n[b], words[b])
            if best[a] is None or form < best[a]:
                best[a] = form
    return [(w, c, -f[0], f[1]) for w, c, f in zip(words, near, best, strict=True) if c]


def run_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spell=lambda doc_id, run: run) -> DataFrame:
    """word, n: the runs of Latin letters (A-Z lower-cased) of all texts, with their occurrences; ``spell`` gives the word of a document's run."""
    runs = docs.select(F.col(f"`{doc_id}`").alias("d"), F.explode(F.regexp_extract_all(lower_ascii(F.col(f"`{text}`")), F.lit(RUN), F.lit(0))).alias("run"))
    return runs.select(spell(F.col("d"), F.col("run")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _halves(df: DataFrame) -> DataFrame:
    """The rows of each group in the groups of its leading and of its trailing half; a group's pairs first differ at a place from p to before ``bound``."""
    h, word = F.floor((F.col("c") - F.col("p") - F.col("s")) / 2).cast("int"), F.col("word")
    one = F.struct("c", (F.col("p") + h).alias("p"), "s", "bound")
    two = F.struct("c", "p", (F.col("s") + h).alias("s"), (F.col("p") + h).alias("bound"))
    both = df.select("word", "n", F.explode(F.array(one, two)).alias("g")).select("word", "n", "g.*").where("p < bound")
    return both.select("word", "n", "c", "p", "s", "bound", F.substring(word, F.lit(1), F.col("p")).alias("head"),
                       F.substring(word, F.length(word) - F.col("s") + 1, F.col("s")).alias("tail"))


def near_words(words: DataFrame, most: int = MOST, task_words: int = TASK_WORDS) -> DataFrame:
    """word, n_near, best_n, best for the words of ``words`` (word, n; stored) that have a near word."""
    length = F.length("word")
    start = words.where("length(word) > 0").select("word", "n", F.explode(F.filter(F.array(length, length - 1), lambda c: c > 0)).alias("c"))
    level = _halves(start.withColumns({"p": F.lit(0), "s": F.lit(0), "bound": F.col("c") + 1}))
    ready = None
    while True:
        crowded = stored(level.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where(f"rows > {most} AND c - p - s > 1").select(*KEY), "crowded")
        if not crowded.limit(1).count():
            ready = level if ready is None else ready.unionByName(level)
            break
        done = level.join(crowded, list(KEY), "left_anti").select(*level.columns)
        ready = done if ready is None else ready.unionByName(done)
        level = _halves(level.join(crowded, list(KEY), "left_semi"))
    tasks = max(1, -(-4 * words.count() // task_words))
    ready = ready.repartition(tasks, *KEY).sortWithinPartitions(*KEY)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n_near", "best_n", "best"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        group, rows = None, []

        def found() -> list[tuple[str, int, int, str]]:
            return group_forms([w for w, _ in rows], [n for _, n in rows], *group[:4]) if len(rows) > 1 else []

        def table(out: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)], names=names)

        for batch in batches:
            out = []
            for word, n, *key in values(batch, "word", "n", *KEY, rows=4096):
                if key != group:
                    out += found()
                    group, rows = key, []
                rows.append((word, n))
            yield table(out)
        yield table(found())

    pairs = ready.mapInArrow(compose, "word string, n_near long, best_n long, best string")
    best = pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b"))
    return best.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached from each word of ``forms`` (word, form) by following forms; doubles its steps each round."""
    jump = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = jump.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = stored(jump.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jump = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return jump


def spelling_groups(words: DataFrame, ratio: int = 2, most: int = MOST, task_words: int = TASK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``words`` (word: distinct, n: occurrences).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point.  ``form`` is the near word of largest n (ties: smallest
    in code-point order) if that n is at least ``ratio`` times the word's, else null; ``root`` is the last word when forms are
    followed, the word itself without one.  As n grows along forms there is no circle (``ratio`` > 1).  The empty word and null
    words are near nothing.  Words of any length; an empty table gives no rows; other columns are ignored.
    """
    words = stored(words.select("word", "n"), "words")
    near = near_words(words, most, task_words)
    all_ = words.join(near, "word", "left").withColumn("ok", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
    judged = stored(all_.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("ok"), F.col("best")).alias("form"),
                                F.when(F.col("ok"), F.col("best_n")).alias("form_n")), "forms")
    last = roots(judged.where("form IS NOT NULL"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def planted_typo(doc_id: Column, run: Column, every: int = 97) -> Column:
    """The run, without its code point h % length where ``every`` divides h = crc32 of ``<doc_id>:<run>`` (a null id is empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    k = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), k), F.substring(run, k + 2, F.length(run)))).otherwise(run)
