"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton yields every vocabulary piece that ends at a position; dynamic programming keeps, per position,
the best score and the number of pieces on its path.  Ties follow the tokenizer (``tokenizers`` Unigram): of
equal scores the path whose last piece starts first wins; a character without a piece of its own may be an unknown, at the
least score less 10, and neighbouring unknowns are one token.  Texts are cut at white space, and each word starts with U+2581.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import values

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words a task remembers, and the length up to which a word is worth it.
CACHE_WORDS = 200_000
CACHE_CHARS = 64
_BLANK = re.compile("[\t-\r \x85\xa0  -     　]+")
_PARTS = re.compile(f"{SPACE}[^{SPACE}]*")


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) from a ``sentencepiece`` file; the unknown is first, with score 0.

    A merge-ranked file holds ranks (-2, -3, ...), which become Zipf log-probabilities, -log(1 - rank).  Control pieces, bytes and pieces marked as never used
    (rank below -1e8) are left out.
    """
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i)) and m.get_score(i) > -1e8]
    return [("<unk>", 0.0), *((m.id_to_piece(i), -math.log1p(-min(0.0, m.get_score(i)))) for i in ids)]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary[1:]:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary[1:] if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        """Tokens of one pre-token."""
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        count, unknown = [0] * (n + 1), [False] * (n + 1)
        best[0], done = 0.0, 0

        def close(upto: int) -> None:
            for e in range(done + 1, upto + 1):
                if word[e - 1] not in self.single:
                    score = best[e - 1] + self.unknown
                    if best[e] is None or score > best[e]:
                        best[e], unknown[e] = score, True
                        count[e] = count[e - 1] + (not unknown[e - 1])

        for last, (size, value) in self.automaton.iter(word):
            e = last + 1
            if e - 1 > done:
                close(e - 1)
                done = e - 1
            score = best[e - size] + value
            if best[e] is None or score > best[e]:
                best[e], unknown[e], count[e] = score, False, count[e - size] + 1
        close(n)
        return count[n]

    def word(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            marked = word if word[0] == SPACE else SPACE + word
            found = sum(map(self.pieces, _PARTS.findall(marked)))
            if len(word) <= CACHE_CHARS:
                if len(self.known) >= CACHE_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def text(self, text: str | None) -> int:
        return sum(self.word(w) for w in _BLANK.split(text or "") if w)


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens (long): one row per input row, whatever its id, in one pass without a shuffle.

    A null or empty text has no tokens; texts of any length are counted whole, in memory of a few numbers per character of
    one word; repeated rows get equal counts; other columns are not carried.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_vocabulary(vocabulary))
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array([counter.text(t) for t in values(batch, "text")], pa.int64())], names=["doc_id", "n_tokens"])

    return source.mapInArrow(count, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long")
