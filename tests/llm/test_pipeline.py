"""Stages of the pipeline against plain loops, and the text queries against their SQL."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import queries, toxicity
from lotwise.llm.common import table

DATA = "/root/testdata/sf0.001"


def _copies(docs):
    last = {}
    for i, text in docs.items():
        last[text or ""] = max(i, last.get(text or "", i))
    return {i: text for i, text in docs.items() if last[text or ""] == i}


def _near(docs):
    found = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for i, t in docs.items()}
    sets = {
        i: {tuple(w[at : at + 5]) for at in range(max(1, len(w) - 4))} if w else set()
        for i, w in found.items()
    }
    root = {i: i for i in docs}
    for i in docs:
        for j in docs:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if x in (a, b) else x for k, x in root.items()}
    return {i: t for i, t in docs.items() if root[i] == i}


def _by_id(frame):
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r.text for r in rows}


def test_stages_match_plain_loops(spark, tmp_path):
    source = table(spark, DATA, "documents")
    special = spark.createDataFrame([(10**6, "a <|endoftext|> b"), (10**6 + 1, None)], "doc_id long, text string")
    docs = source.unionByName(special, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, DATA, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    names, before = [name for name, _ in corpus_pipeline.STAGES], docs
    assert names == ["toxicity", "exact_dedup", "ngram_join", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, before, str(tmp_path)).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns
            old, new = _by_id(before), _by_id(after)
            assert 0 < len(new) <= len(old)
        if name == "toxicity":
            # The classifier is trained; its scores stand in, the dropping is checked.
            scores = toxicity.score(docs.select("doc_id", "text"), table(spark, DATA, "labels"))
            kept = {r.doc_id for r in scores.collect() if not r.predicted}
            assert new == {i: t for i, t in old.items() if i in kept}
        elif name == "exact_dedup":
            assert new == _copies(old)
        elif name == "ngram_join":
            assert new == _near(old)
        elif name == "suffix_dedup":
            assert new == _passages(old) != old
        before = after
    expected = _check_pieces(_by_id(spark.read.parquet(f"{tmp_path}/suffix_dedup")), before.collect())
    assert collections.Counter(corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()) == expected


def _passages(docs):
    """Bytes of windows that occur twice go, in every copy; what is left is read as UTF-8."""
    size = 200
    data = {i: (t or "").encode() for i, t in docs.items()}
    windows = collections.Counter(d[k : k + size] for d in data.values() for k in range(len(d) - size + 1))
    left = {}
    for i, d in data.items():
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - size + 1):
            if windows[d[k : k + size]] > 1:
                gone[k : k + size] = True
        kept = np.frombuffer(d, "u1")[~gone].tobytes()
        left[i] = kept.decode("utf-8", "ignore") if gone.any() else docs[i]
    return left


def _check_pieces(docs, pieces):
    tokenizer = Tokenizer.from_file(queries.PACKING_TOKENIZER)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(int)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id] += p.length
    assert set(by_doc) == set(docs)
    for i, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert all(n & (n - 1) == 0 and n <= 2048 for n in by_sequence.values())
    return collections.Counter((i, sum(p.length for p in found)) for i, found in by_doc.items())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_text_query_matches_its_oracle(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    expected = duck.sql(queries.oracle_sql()[name])
    found = queries.queries()[name](spark, DATA)
    assert set(found.columns) == set(expected.columns)
    order = [found.columns.index(c) for c in expected.columns]
    rows = [tuple(r[k] for k in order) for r in found.collect()]
    assert collections.Counter(rows) == collections.Counter(expected.fetchall())
