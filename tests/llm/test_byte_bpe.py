"""Words folded many at a time, and the memos of the byte-level encoder."""

import random

import public_tokenizers
import pytest

from lotwise.llm import byte_bpe

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def one_by_one(words: list[str]) -> dict[str, bytes]:
    return {w: byte_bpe.pack_ids(byte_bpe.fold_merges(w.encode(), RANKS)) for w in words}


def test_words_folded_together_equal_words_folded_alone():
    chosen = random.Random(3)
    parts = ["a", "aa", "ing", " the", "é", "ß", "日本", "\n", "9", "!!", "\x00", "😀"]
    words = ["".join(chosen.choices(parts, k=chosen.randint(1, 14))) for _ in range(3000)]
    words += ["a" * n for n in range(1, 40)] + ["é" * 16, "é" * 17]
    words = list(dict.fromkeys(words))
    assert byte_bpe.Folder(RANKS).fold(words) == one_by_one(words)


def test_few_ranks_and_bytes_outside_the_vocabulary():
    ranks = {b"a": 0, b"b": 1, b"ab": 2, b"ba": 3, b"aba": 4, b"xy": 5}
    words = ["abab", "bbaa", "aba", "abaab", "xyab", "abxyb"]
    folded = byte_bpe.Folder(ranks).fold(words)
    assert folded == {w: byte_bpe.pack_ids(byte_bpe.fold_merges(w.encode(), ranks)) for w in words}
    with pytest.raises(KeyError):
        byte_bpe.Folder(ranks).fold(["abx"])


def test_a_word_is_folded_once_whatever_stands_beside_it(monkeypatch):
    folded = []
    fold = byte_bpe.Folder.fold
    monkeypatch.setattr(byte_bpe.Folder, "fold", lambda self, words: folded.extend(words) or fold(self, words))
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = ["zorgle.\nzorgle zorgle, zorgle. zorgle;", "a zorgle! zorgle", ""]
    found = encoder.encode(texts) + encoder.encode(texts)
    assert len(folded) == len(set(folded))
    assert found[:3] == found[3:]
    assert found[2] == b""


def test_memos_stay_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_ENTRIES", 5)
    monkeypatch.setattr(byte_bpe, "WORD_ENTRIES", 5)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    plain = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ("one two three", "x" * 500 + " one", "four five six seven one", "one " + "y" * 90):
        assert encoder.encode([text]) == plain.encode([text])
        assert len(encoder.chunks) <= 5 and len(encoder.words) <= 5
        assert max(map(len, [*encoder.chunks, *encoder.words, ""])) <= byte_bpe.MEMO_CHARS
