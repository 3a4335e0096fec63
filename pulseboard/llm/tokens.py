"""Word-wise encoding with a public ``tokenizers`` vocabulary.

The vocabulary's pre-tokenizer never joins text across white space, so a text's ids are those of its
white-space separated chunks in a row.  Chunks repeat, so a worker encodes a chunk once and looks it up afterwards, in a
table of bounded size that its later tasks find again.

The ids are the untouched tokenizer's with ``add_special_tokens=False``: an added token's string inside a text, such as
``<|endoftext|>``, is that one id, found in the raw text before anything is lower-cased (``<|ENDOFTEXT|>`` is ordinary text).
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

#: Chunks a worker remembers (about 200 bytes each, so some 80 MB a worker), and the length up to which a chunk is worth it.
CACHE_CHUNKS = 400_000
CACHE_CHARS = 48
#: Chunks that a full table may lack, in multiples of its size, until it is emptied.
RENEW = 16
#: str.split() also cuts at these four, which the tokenizer keeps as text.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: One point or comma at a word's end is a pre-token of its own, so a blank may part it from the word.
#: The point is looked for first and its neighbours after: a leading look-behind is tried at every character.
_STOP = re.compile(r"[.,](?!\S)(?<=[0-9A-Za-z].)")
_ENCODERS: dict[str, WordEncoder] = {}
#: Chunks whose normal form and pre-tokens are plain to see: ASCII without the apostrophe, and the letters up to U+00FF.  None of these
#: compose with one another, each has a lower-case form of one character, and letters, single digits and other runs are the pre-tokens.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
_PRE_TOKENS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-`{-~]+")
#: The normalizer and pre-tokenizer for which that holds.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _byte_letters() -> dict[int, str]:
    """The byte-level form of the letters U+00DF to U+00FF: their UTF-8 bytes, each as its letter."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # as themselves, the others from U+0100 on
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


class Chunks(dict):
    """Ids of chunks; one that is looked up and not there is encoded, kept and noted in ``new``.

    A plain chunk's pre-tokens go straight to the tokenizer's model, at a third of the time of its whole chain."""

    def __init__(self, tokenizer):
        super().__init__()
        self.encode, self.new = tokenizer.encode_batch_fast, []
        self.model, self.letters = tokenizer.model.tokenize, _byte_letters()
        steps = [json.loads(x.__getstate__()) if x else None for x in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
        self.plain = _PLAIN.fullmatch if steps == [_NORMALIZER, _PRE_TOKENIZER] else lambda chunk: None

    def __missing__(self, chunk: str) -> bytes:
        if self.plain(chunk):
            low = chunk.lower()
            words = [low] if low.isalpha() else _PRE_TOKENS.findall(low)
            ids = [t.id for w in words for t in self.model(w if w.isascii() else w.translate(self.letters))]
        else:
            ids = self.encode([chunk], add_special_tokens=False)[0].ids
        self[chunk] = found = struct.pack(f"<{len(ids)}I", *ids)
        self.new.append(chunk)
        return found


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {content: struct.pack("<I", i) for content, i in added.items()}
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})") if added else None
        self.tokenizer.encode_special_tokens = True  # texts are cut at added tokens first; what lower-casing makes is none
        self.known = Chunks(self.tokenizer)
        self.missed = 0

    def ids(self, text: str | None, end: int) -> np.ndarray:
        """Ids of a whole text (null: none), then ``end``; unsigned 32-bit, little-endian."""
        text = text or ""
        parts = self.cut.split(text) if any(a in text for a in self.added) else [text]
        ids = b"".join([self.added[p] if n % 2 else self._plain(p) for n, p in enumerate(parts)])
        return np.frombuffer(ids + struct.pack("<I", end), "<u4")

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        text = _STOP.sub(r" \g<0>", text)
        if text.isascii():  # the vocabulary lower-cases after composing characters, which ASCII has none of
            text = text.lower()
        chunks = [c for c in _SPACE.split(text) if c] if _SEPARATORS.search(text) else text.split()
        ids = b"".join(map(self.known.__getitem__, chunks))
        # the table keeps what it met first, so mostly frequent chunks; where too much is missing from it, it begins anew
        known, new = self.known, self.known.new
        full = len(known) > CACHE_CHUNKS
        for c in new:
            if full or len(c) > CACHE_CHARS:
                del known[c]
        if full:
            self.missed += len(new)
            if self.missed > RENEW * CACHE_CHUNKS:
                known.clear()
                self.missed = 0
        new.clear()
        return ids
