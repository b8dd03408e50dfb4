"""Learned operators: held-out accuracy, recall against all pairs, and odd rows."""

import numpy as np

from lotwise.llm import embedding_links, quality_model, toxicity
from lotwise.llm.common import components, table

DATA = "/root/testdata/sf0.01"


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)
    }
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_vectors_link_as_in_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 32))
    rows = []
    for i in range(600):
        x = centres[i % 60] + rng.normal(scale=0.12, size=32) * (i % 3)
        rows.append((i, [float(v) for v in x]))
    odd = [(900, None), (901, [0.0] * 32), (902, [None] * 32), (903, [float("nan")] * 32), (None, rows[0][1])]
    schema = "vec_id long, embedding array<double>, weight string"
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], schema)
    found = {r.vec_id: r for r in embedding_links.link_vectors(frame).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = np.array([found[i].n_links for i in range(600)])
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum() > 0
    for i, _ in odd[:4]:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert embedding_links.link_vectors(frame.limit(0)).count() == 0


def test_toxic_documents_of_held_out_rows(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "x")], "doc_id long, text string")
    rows = toxicity.score(docs.select("doc_id", "text").unionByName(odd), labels).collect()
    assert len(rows) == docs.count() + 3 and all(0 <= r.score <= 1 for r in rows)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in known]
    insulted = {
        r.doc_id for r in docs.collect() if any(w in r.text.lower() for w in ("idiot", "moron", "stupid"))
    }
    caught = [r.predicted for r in held if known[r.doc_id] and r.doc_id in insulted]
    clean = [r.predicted for r in held if not known[r.doc_id]]
    assert np.mean(caught) >= 0.9 and np.mean(clean) <= 0.1


def test_gapped_words_stay_close():
    plain, other = toxicity.word_features("worthless"), toxicity.word_features("elsewhere")

    def kernel(a, b):
        dense = np.zeros(toxicity.LETTERS**3)
        dense[a[0]] = a[1]
        return dense[b[0]] @ b[1]

    for changed in ("w.o.r.t.h.l.e.s.s", "w0rthl3ss", "worth-less", "wörthless", "worxthless"):
        assert kernel(plain, toxicity.word_features(changed)) > 2 * kernel(plain, other)
    number, n = toxicity._words(toxicity.classes_of("so w o r s e now"))
    assert n == 3


def test_scores_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r.score for r in toxicity.score(docs, labels).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, labels).count() == 2
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_model_is_a_distribution_and_parts_good_from_bad(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    logs = quality_model.log_probabilities(quality_model.count_grams(docs))
    sums = np.exp(logs.astype(float)).reshape(-1, quality_model.ALPHABET).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)
    odd = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "the", "xx")], "doc_id long, text string, lang string")
    rows = quality_model.judge(docs.select("doc_id", "text", "lang").unionByName(odd), labels).collect()
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = {k: np.mean([r.kept for r in rows if known.get(r.doc_id) == k]) for k in (0, 1)}
    assert kept[1] >= 0.95 and kept[0] <= 0.3
    assert [r.kept for r in rows if r.doc_id == 10**6] == [False]
    assert quality_model.judge(docs.limit(0), labels).count() == 0
