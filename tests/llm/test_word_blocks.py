"""op6: texts as blocks of word numbers that ask groups of n-grams."""

import os
import random

import numpy as np
import pytest

from lotwise.llm import quality_model as qm


def _docs(spark, n, words, size, parts):
    rng = random.Random(17)
    texts = [" ".join(rng.choices(words, k=rng.randint(1, size))) for _ in range(n)]
    rows = [(i, i % 5, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "row long, fold int, text string").repartition(parts, "row")


def test_words_are_those_of_the_pattern():
    rng = random.Random(1)
    signs = "abcXYZ_019 \n\t.,;!?é漢字カな・ー\u3000\u00a0Приветß𝔘😀\u200b\x1c"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000)]
    hashes, counts, whole, starts, ends = qm.words_of(texts)
    plain = [qm.WORD.findall(t) for t in texts]
    words = [w for found in plain for w in found]
    assert counts.tolist() == [len(found) for found in plain]
    assert [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)] == words
    numbers = dict(zip(words, hashes.tolist(), strict=True))
    assert [numbers[w] for w in words] == hashes.tolist() and len({*numbers.values()}) == len(numbers)
    assert [len(qm.words_of(x)[0]) for x in ([], [""], [" ", ""])] == [0, 0, 0]


def test_columns_come_back():
    columns = [np.array([5, 2**63], np.uint64), np.zeros(0, np.int64), np.array([1.5, -2.0]), np.arange(70_000)]
    for a, b in zip(columns, qm.unpack(qm.pack(*columns)), strict=True):
        assert a.tolist() == b.tolist()


def test_many_blocks_turns_and_groups_change_nothing(spark, monkeypatch):
    table = np.linspace(-9, -1, qm.ALPHABET**qm.ORDER).astype(np.float32)
    monkeypatch.setattr(qm, "log_probabilities", lambda counts: table)
    docs = _docs(spark, 120, [f"w{i}" for i in range(40)] + ["漢字", "."], 30, 13)
    whole = {r.row: r.perplexity for r in qm.perplexities(docs).collect()}
    for name, value in (("BLOCK", 60), ("GROUP", 30), ("LEAST", 32), ("TURNS", 8)):
        monkeypatch.setattr(qm, name, value)
    split = {r.row: r.perplexity for r in qm.perplexities(docs).collect()}
    assert len(whole) == 120 and whole == {k: pytest.approx(v, rel=1e-9) for k, v in split.items()}


def test_what_is_stored_is_a_few_bytes_a_word(spark, monkeypatch):
    docs = _docs(spark, 2000, [f"word{i}" for i in range(3000)], 300, 2)
    n = sum(len(qm.WORD.findall(r.text)) for r in docs.collect())
    sizes = []

    def measured(df, stored=qm.stored):
        found = stored(df)
        sizes.append(sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in found.inputFiles()))
        return found

    monkeypatch.setattr(qm, "stored", measured)
    assert qm.perplexities(docs).count() == 2000
    # Rows of hashes and counts took 24 bytes and more for each.
    assert sum(sizes) < 10 * n
