"""Columns of the documents whose names the operators use themselves come back as they were."""

import pytest

from lotwise.llm import exact_dedup, ngram_join, suffix_dedup, toxicity

CLASHING = (
    "score", "held_out", "predicted", "label", "_x", "_row", "_text", "kept", "n_bytes", "n_removed", "n_spans",
    "keep_id", "group_size", "_h1", "_h2", "_sha", "_found", "_id", "h1", "h2", "rep", "class", "size", "token", "toxic",
)
PASSAGE = " ".join(f"word{i}" for i in range(60))


def documents(spark):
    rows = [
        (1, "a plain text of its own", 23), (2, "one text twice", 14), (3, "one text twice", 14), (4, None, None), (5, "", 0),
        (6, f"{PASSAGE} first", 400), (7, f"second {PASSAGE}", 400), (None, "no id", 5),
    ]
    marked = [(*row, *(f"{name} of {row[0]}" for name in CLASHING)) for row in rows]
    schema = "doc_id long, text string, n_chars int, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(marked, schema)


def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    "stage, left",
    [
        (lambda d, s: toxicity.drop_toxic(d, labels(s)), {1, 2, 3, 4, 5, 6, 7, None}),
        (lambda d, s: exact_dedup.drop_copies(d), {1, 3, 5, 6, 7, None}),
        (lambda d, s: ngram_join.keep_first(d), {1, 2, 4, 5, 6, None}),
        (lambda d, s: suffix_dedup.drop_repeats(d), {1, 2, 3, 4, 5, 6, 7, None}),
    ],
    ids=["toxicity", "exact_dedup", "ngram_join", "suffix_dedup"],
)
def test_columns_come_back(spark, stage, left):
    docs = documents(spark)
    found = stage(docs, spark)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    rows = found.collect()
    assert {r.doc_id for r in rows} == left
    for row in rows:
        assert all(row[name] == f"{name} of {row.doc_id}" for name in CLASHING)


def test_removed_passages_shorten_the_documents(spark):
    rows = {r.doc_id: r for r in suffix_dedup.drop_repeats(documents(spark)).collect()}
    for i in (6, 7):
        assert rows[i].n_chars == len(rows[i].text) < 100
    assert rows[4].text is None and rows[4].n_chars is None and rows[1].n_chars == 23
