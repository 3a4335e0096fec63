"""Task-side cores against plain versions and the libraries they must agree with (no Spark)."""

import io
import random
import struct

import numpy as np
import pytest
import zstandard

from pulseboard.llm import near_duplicates as N
from pulseboard.llm import packing, token_output, warc
from pulseboard.llm.token_counts import Counter, load_vocabulary
from pulseboard.llm.tokens import WordEncoder

PT = pytest.importorskip("public_tokenizers")
ALPHABET = "ab's\x1c\x1f \t\n\x85　é́İΣσ1２漢ー'reT'LL<|endoftext|>▁ﬁ😀.,.,"


def texts(n, seed=3):
    r = random.Random(seed)
    return ["", " ", "\x1c", *("".join(r.choice(ALPHABET) for _ in range(r.randrange(60))) for _ in range(n)), "word " * 30_000]


def added_texts():
    """Strings of added tokens at word ends, in a row, in capitals, inside words and next to points."""
    r = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "x", "Y.", " ", ".", "İ", "don't", "<|"]
    return ["x<|endoftext|>y", *("".join(r.choice(parts) for _ in range(r.randrange(1, 12))) for _ in range(400))]


def test_word_encoder_equals_tokenizer():
    from tokenizers import Tokenizer
    path = PT.path("word_bpe_49k.json")
    own, ref = WordEncoder(path), Tokenizer.from_file(path)
    for t in texts(800) + added_texts():
        assert own.ids(t, 1).tolist() == [*ref.encode(t, add_special_tokens=False).ids, 1]
    assert own.ids(None, 1).tolist() == [1]


def test_word_encoder_with_a_full_table(monkeypatch):
    from pulseboard.llm import tokens
    path = PT.path("word_bpe_49k.json")
    plain = [WordEncoder(path).ids(t, 1).tolist() for t in texts(60)]
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 20)
    monkeypatch.setattr(tokens, "RENEW", 4)
    own = WordEncoder(path)
    assert [own.ids(t, 1).tolist() for t in texts(60)] == plain and len(own.known) <= 20


def test_plain_chunks_skip_the_tokenizers_chain(monkeypatch):
    """ASCII without the apostrophe and letters up to U+00FF go to the model alone, with the tokenizer's ids."""
    from tokenizers import Tokenizer
    path, r = PT.path("word_bpe_49k.json"), random.Random(6)
    ref, own = Tokenizer.from_file(path), WordEncoder(path)
    letters = [chr(c) for c in [*range(33, 127), *range(0xC0, 0x100)] if chr(c) not in "'×÷"]
    chunks = [*letters, *("".join(r.choices(letters, k=r.randrange(1, 30))) for _ in range(3000)), *("".join(r.choices("aeßéÉnNtA", k=r.randrange(1, 12))) for _ in range(3000)), "a" * 5000]
    ref.encode_special_tokens = True
    want = [ref.encode(c, add_special_tokens=False).ids for c in chunks]
    monkeypatch.setattr(own.known, "encode", None)
    assert [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in map(own.known.__getitem__, chunks)] == want
    monkeypatch.undo()
    for other in ("don't", "×", "÷", "ª", "µ", "İ", "e\u0301", "漢", "ŉ"):
        assert list(struct.unpack(f"<{len(own.known[other]) // 4}I", own.known[other])) == ref.encode(other, add_special_tokens=False).ids and not own.known.plain(other)


def test_counts_equal_unigram_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = load_vocabulary(PT.path("piece_bpe_32k.model"))
    ref = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    ref.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    own = Counter(vocabulary)
    for t in texts(800):
        assert own.text(t) == len(ref.encode(t).ids)


def test_counts_follow_tie_rules():
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("▁a", -2.0), ("b", -1.0), ("ab", -2.0)]
    ref = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    ref.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    own, r = Counter(vocabulary), random.Random(5)
    for _ in range(500):
        t = "".join(r.choice("aabx ") for _ in range(r.randrange(12)))
        assert own.text(t) == len(ref.encode(t).ids), t


def test_best_fit_decreasing_picks_tightest_window():
    r = random.Random(1)
    for window in (1, 2, 7, 64, 2048):
        lengths = np.array(sorted((r.randrange(1, window + 1) for _ in range(300)), reverse=True))
        number, offset = packing.best_fit_decreasing(lengths, window)
        used = {}
        for n, k, o in zip(lengths.tolist(), number.tolist(), offset.tolist(), strict=True):
            fits = [window - u for u in used.values() if window - u >= n]
            assert o == used.get(k, 0) and (window - o == min(fits) if fits else o == 0)
            used[k] = o + n
        assert max(used.values()) <= window


def test_packed_block_is_lossless():
    docs = [np.arange(n, dtype="<u4") % 500 for n in (5, 1, 130, 64, 64, 63)]
    arrays, pieces = token_output.pack_block(docs, 64, 0, "<u2")
    back = {k: [] for k in range(len(docs))}
    for k, start, length, row, offset in sorted(pieces):
        assert start == len(back[k])
        back[k] += arrays["ids"][row, offset:offset + length].tolist()
        assert np.unpackbits(arrays["resets"], axis=1)[row, offset] == 1
    assert all(back[k] == d.tolist() for k, d in enumerate(docs))
    assert np.unpackbits(arrays["resets"]).sum() == len(pieces)


def archive(records, dictionary=b"", skippable=True):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(dict_data=d) if d else zstandard.ZstdCompressor()
    head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary)) + dictionary if skippable else b""
    return head + b"".join(c.compress(r) for r in records)


def test_warc_reader_reads_and_rejects():
    body = "é\r\n\r\nWARC/1.1\r\n".encode() * 10_000
    good = warc.record("response", "urn:page:1", "http://x/\r\ny", body, warc.sha1_hex(body), len(body))
    empty = warc.record("response", "urn:page:2", "", b"", warc.sha1_hex(b""), 0)
    samples = [bytes(random.Random(i).choices(b"abcdefgh <>", k=400)) for i in range(200)]
    for d in (b"", zstandard.train_dictionary(2048, samples).as_bytes()):
        got = list(warc.read_archive(io.BytesIO(archive([good, empty], d)), chunk=7))
        assert [b for _, b in got] == [body, b""] and got[0][0]["warc-target-uri"] == "http://x/%0D%0Ay"
    packed = zstandard.ZstdCompressor().compress(zstandard.train_dictionary(2048, samples).as_bytes())
    assert warc.read_dictionary(io.BytesIO(struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed)) is not None
    assert list(warc.read_archive(io.BytesIO(archive([])))) == []
    wrong = [archive([good], skippable=False), archive([good])[:-3], archive([good[:-1]]), archive([good.replace(b"Content-Length: ", b"Content-Length: 1")]),
             archive([b"WARC/1.0" + good[8:]]), archive([good]) + b"rest", archive([good.replace(b"sha1:", b"sha1:0")])]
    for data in wrong:
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(data)))


def test_compare_counts_links_and_components():
    r = random.Random(2)
    base = [np.unique(np.array([r.getrandbits(64) for _ in range(100)], np.uint64)) for _ in range(3)]
    sets = [np.unique(np.concatenate([b[r.randrange(0, 8):], np.array([r.getrandbits(64) for _ in range(r.randrange(4))], np.uint64)])) for b in base for _ in range(20)]
    copies = np.array([r.randrange(1, 4) for _ in sets])
    j = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for b in sets] for a in sets]) >= 0.8
    np.fill_diagonal(j, False)
    linked, documents, first = N.compare(sets, copies, None, N.Fraction(4, 5))
    assert linked.tolist() == j.sum(1).tolist() and documents.tolist() == (j @ copies).tolist()
    assert all(first[a] == first[b] for a, b in zip(*np.nonzero(j), strict=True))
    side = np.arange(len(sets)) % 2
    assert N.compare(sets, copies, side, N.Fraction(4, 5))[0].tolist() == (j & (side[:, None] != side)).sum(1).tolist()


def test_forest_recall_at_the_threshold():
    assert 1 - (1 - 0.8 ** N.prefix_length()) ** N.TREES >= N.RECALL
    r, forest, level = np.random.RandomState(0), N.Forest(), N.prefix_length()
    hits = 0
    for _ in range(300):
        both = r.randint(0, 1 << 62, 400).astype(np.uint64) * np.uint64(3)
        a, b = both[:360], np.concatenate([both[40:360], both[360:]])  # 320 of 400 shared
        x, y = forest.minhashes(np.unique(a)), forest.minhashes(np.unique(b))
        hits += bool((forest.keys(x, level) == forest.keys(y, level)).any())
        for longer, shorter in ((16, 13), (13, 10), (10, level)):  # what meets on a level meets on those above
            assert (~(forest.keys(x, longer) == forest.keys(y, longer)) | (forest.keys(x, shorter) == forest.keys(y, shorter))).all()
    assert hits >= 295


def test_forest_recall_with_shared_minhashes():
    k = N.prefix_length()
    assert N.forest_recall(N.THRESHOLD, k) >= N.RECALL > N.forest_recall(N.THRESHOLD, k + 1)
    r, order = np.random.RandomState(1), N.Forest().order[:, :k]
    agree = r.random_sample((100_000, N.HASHES)) < N.THRESHOLD  # minhashes of pairs at the threshold, under the forest's own draws
    missed = np.ones(len(agree), bool)
    for trie in order:
        missed &= ~agree[:, trie].all(axis=1)
    assert 1 - missed.mean() >= N.RECALL
