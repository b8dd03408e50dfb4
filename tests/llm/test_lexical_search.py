"""op12 against a plain loop over all documents, on small shards and on lists of many blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lotwise.llm import lexical_search as search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, queries, k):
    """``(item_id, rank, doc_id, score)`` by scoring every document."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in queries:
        asked, scores = set(terms(text)), []
        for doc_id, c in counts:
            m = 100 - 90 + 90 * c.total() * n_docs // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in asked
                if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, doc_id, -s) for i, (s, _, _, doc_id) in enumerate(sorted(scores, key=lambda r: r[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, queries, k=10, shard_terms=search.SHARD_TERMS):
    table = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, score long, term int").repartition(3)
    index = search.stored(search.build_index(table, shard_terms))
    asked = spark.createDataFrame([(*q, "x") for q in queries], "item_id long, text string, shard string")
    return sorted(map(tuple, search.search(index, asked, k).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(900)]
    queries = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 12)))) for i in range(40)]
    return docs, queries


def test_all_documents_are_ranked(spark, corpus):
    docs, queries = corpus
    expected = plain(docs, queries, 10)
    assert found(spark, docs, queries) == expected
    assert found(spark, docs, queries, shard_terms=2000) == expected
    assert found(spark, docs, queries, k=1) == plain(docs, queries, 1)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "Äpfel äpfel ÄPFEL"), (3, "Äpfel äpfel ÄPFEL"), (None, "tie word"), (9, "tie word"), (4, "tie word"),
            (5, "under_score naïve\x85x word3.14"), (6, "漢字 仮名"), (7, "x" * 300_000 + " word"), (8, "word " * 40_000)]
    queries = [(1, "Äpfel"), (1, "word tie WORD"), (2, None), (3, "..."), (None, "3 14 under"), (4, "漢字"), (5, "absent"), (6, "x" * 300_000)]
    assert found(spark, docs, queries) == plain(docs, queries, 10)


@pytest.mark.parametrize("docs, queries", [([], [(1, "a")]), ([(1, None)], [(1, "a")]), ([(1, "a")], [])])
def test_empty_tables(spark, docs, queries):
    assert found(spark, docs, queries) == []


def test_blocks_that_cannot_matter_stay_packed(monkeypatch):
    """One rare term decides; of the frequent term's many blocks only those of its documents are read."""
    words = search._Numbers()
    rare = {40, 3000, 7000}
    texts = [[b"often"] * 2 + [b"filler"] * 50 + ([b"rare"] * 4 if i in rare else []) for i in range(8000)]
    numbers = [np.array([words[t] for t in text], np.int32) for text in texts]
    batch = search.index_shard(0, list(range(8000)), numbers, words)
    rows = search.pa.Table.from_batches([batch])
    total = sum(map(len, texts))
    shard = search.Shard(rows, {b"often": 1, b"rare": 9000, b"filler": 0}, 8000, total)
    read, plainly = [], search.PostingList.read
    monkeypatch.setattr(search.PostingList, "read", lambda self, wanted=None: read.append((self.weight, wanted)) or plainly(self, wanted))
    best = shard.best([b"rare", b"often"], 3)
    assert {p for p, _ in best} == rare
    assert [w for w, _ in read] == [9000, 1]
    assert read[1][1].tolist() == sorted({p // search.BLOCK for p in rare})


def test_varints_return():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**32 - 1, 5])
    packed, sizes = search.pack_varints(values)
    assert sizes.tolist() == [1, 1, 1, 2, 2, 3, 4, 5, 5, 1]
    assert search.unpack_varints(packed).tolist() == values.tolist()
