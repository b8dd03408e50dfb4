"""op6: perplexities of the word model against plain loops, and what character grams cannot see."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import quality_model as qm


def _plain(trained, spell):
    """Log probability of a word after two others, from lists of words."""
    counts = [collections.Counter() for _ in range(4)]
    for words in trained:
        padded = ["<s>", "<s>", *words]
        counts[3].update(zip(padded, padded[1:], padded[2:]))
    for k in (2, 1):
        counts[k].update(g[1:] for g in counts[k + 1])

    def cuts(k):
        n = collections.Counter(counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return [0] + [
            min(0.99 * i, max(0.01 * i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[1] else i / 2
            for i in (1, 2, 3)
        ]

    discounts = [None, *(cuts(k) for k in (1, 2, 3))]

    def probability(gram):
        k = len(gram)
        if k == 0:
            raise ValueError
        lower = probability(gram[1:]) if k > 1 else spell(gram[0])
        same = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return lower
        cut = discounts[k]
        spare = sum(cut[min(c, 3)] for c in same.values())
        c = same.get(gram, 0)
        return (c - cut[min(c, 3)]) / total + spare / total * lower

    return lambda gram: math.log(probability(gram))


def _texts():
    rng = random.Random(3)
    names = ["the", "cat", "dog", "sees", "a", "bird", "漢字", "Привет", "."]
    return [" ".join(rng.choices(names, k=rng.randint(1, 30))) for _ in range(24)] + ["new wörds!", "", None, "  "]


def test_perplexities_are_those_of_plain_loops(spark, monkeypatch):
    texts = _texts()
    rows = [(i, i % 5 if t else 0, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "row long, fold int, text string").repartition(3)
    price = lambda w: -1.5 * (len(w) + 1)
    # The spelling alone comes from a table; here every character costs the same.
    table = np.full(qm.ALPHABET**qm.ORDER, -1.5, np.float32)
    monkeypatch.setattr(qm, "log_probabilities", lambda counts: table)
    found = {r.row: r.perplexity for r in qm.perplexities(docs).collect()}
    assert set(found) == {i for i, t in enumerate(texts) if qm.WORD.findall(t or "")}
    for m in qm.MODELS:
        model = _plain(
            [qm.WORD.findall(t or "") for _, f, t in rows if f and f != m], lambda w: math.exp(price(w))
        )
        for i, f, t in rows:
            if f == m and i in found:
                padded = ["<s>", "<s>", *qm.WORD.findall(t)]
                logs = [model(g) for g in zip(padded, padded[1:], padded[2:])]
                assert found[i] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-6)


def test_order_of_words_and_letters_of_any_script_count(spark):
    lines = ["the old house by the river was sold last year", "старый дом у реки был продан в прошлом году"]
    lines = [" . ".join([line] * n) for line in lines for n in range(2, 22)]
    rng = random.Random(1)
    shuffled = []
    for line in lines[10:14] + lines[30:34]:
        words = line.split()
        rng.shuffle(words)
        shuffled.append(" ".join(words))
    other = [line.translate(str.maketrans("аеиостд", "юэъщфхц")) for line in lines[30:34]]
    rows = [(i, t, "x") for i, t in enumerate(lines + shuffled + other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(lines))], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in qm.judge(docs, labels).collect()}
    assert np.mean([kept[i] for i in range(len(lines))]) >= 0.9
    assert not any(kept[i] for i in range(len(lines), len(rows)))


def test_the_model_grows_with_the_texts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("ab cd ef gh ij kl mn op".split(), k=40)) for _ in range(40)]
    sizes = []
    for n in (4, 40):
        docs = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts[:n])], "row long, fold int, text string")
        sizes.append(qm.document_grams(docs).groupBy("w1", "w2", "w3").agg(F.sum("n")).count())
    assert sizes[1] > 2 * sizes[0]


def test_the_threshold_is_the_plain_quantile_of_held_out_perplexities(spark):
    rng = random.Random(11)
    words = {lang: [f"{lang}{i}" for i in range(60)] for lang in ("en", "fr")}
    rows = [(i, " ".join(rng.choices(words[lang], k=25)), lang) for i in range(300) for lang in [("en", "fr")[i % 2]]]
    own = "wholly own words of one text that no other trusted text has at all"
    docs = spark.createDataFrame([*rows, (500, own, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(300), 500]], "doc_id long, quality int")
    found = qm.judge(docs, labels).collect()
    for lang in words:
        ranked = sorted(r.perplexity for r in found if r.lang == lang)
        plain = ranked[math.ceil(qm.QUANTILE * len(ranked)) - 1]
        assert {r.threshold for r in found if r.lang == lang} == {plain}
    # A model that had learned from this text would find it the likeliest of all.
    strange = next(r for r in found if r.doc_id == 500)
    assert strange.perplexity == max(r.perplexity for r in found) and not strange.kept
