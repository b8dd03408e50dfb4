"""op13 against a plain comparison of all words, and its frontier on chosen words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotwise.llm import spelling

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
FIELDS = ("word", "form", "root", "n", "n_near", "form_n")


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(counts, ratio=5):
    form, near = {}, {}
    for word, n in counts.items():
        near[word] = [o for o in counts if one_apart(word, o)]
        best = min(near[word], key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[word] = best
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), counts.get(form.get(word))))
    return sorted(rows, key=str)


def plain_counts(rows, min_letters=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def collected(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=str)


def groups(spark, counts, **settings):
    words = spark.createDataFrame([(w, n, 1, 2) for w, n in counts.items()], "word string, n long, id int, key int")
    return collected(spelling.group_variants(words, **settings))


def test_words_one_edit_apart(spark):
    rng = random.Random(8)
    counts = {}
    for _ in range(120):
        word = "".join(rng.choices("abc", k=rng.randint(1, 7)))
        counts[word] = 5 ** rng.randint(0, 6)
    assert groups(spark, counts) == plain_groups(counts)
    assert groups(spark, counts, hot=7) == plain_groups(counts)  # nodes dealt to many keys


def test_every_place_of_an_edit(spark):
    base = "letters"
    words = {base, base + "x", "x" + base, base[1:], base[:-1], "lexters", "lexxers", "lettters", "leters", "retters", "letterz", "rettersx"}
    counts = {w: 5 ** i for i, w in enumerate(sorted(words))}
    assert groups(spark, counts) == plain_groups(counts)


def test_chains_and_ties(spark):
    counts = {"abcdef": 5**5, "abcdeg": 5**4, "abcdhg": 5**3, "abzdhg": 5**2, "tiesaa": 5, "tiesab": 50, "tiesac": 50, "lonely": 7, "öäüßéà": 40, "öäüßéa": 5}
    rows = groups(spark, counts)
    assert rows == plain_groups(counts)
    found = {r[0]: (r[1], r[2]) for r in rows}
    assert found["abzdhg"] == ("abcdhg", "abcdef") and found["tiesaa"] == ("tiesab", "tiesab")
    assert found["lonely"] == (None, "lonely") and found["öäüßéa"] == ("öäüßéà", "öäüßéà")


def test_documents_against_a_plain_loop(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("nprst", k=rng.randint(5, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=80)).title()) for i in range(120)]
    rows += [(None, "Árbolàs árbolÀs " * 4), (3, None), (4, ""), (5, "x1y2 " * 9), (6, "öffnen" * 20_000), (6, "öffnen" * 20_000)] * 3
    docs = spark.createDataFrame([(*r, 0, "") for r in rows], "doc_id long, text string, n int, word string").repartition(3)
    counts = plain_counts(rows)
    assert any(len(w) > 100_000 for w in counts)
    long = {w for w in counts if len(w) > 1000}
    expected = plain_groups({w: n for w, n in counts.items() if w not in long})
    found = collected(spelling.digest(docs))
    assert [r for r in found if r[0] not in long] == expected
    assert {r[0] for r in found} == set(counts)


def test_equal_hashes_add_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HASH_PRIME", 31)
    rng = random.Random(4)
    counts = {"".join(rng.choices("abcd", k=rng.randint(2, 6))): rng.randint(1, 99) for _ in range(25)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("id", F.monotonically_increasing_id())
    expected = {tuple(sorted((a, b))) for a in counts for b in counts if one_apart(a, b)}
    assert {r[0] for r in groups(spark, counts)} == set(counts)
    assert sum(r[4] for r in groups(spark, counts)) == 2 * len(expected)
    assert words.count() == len(counts)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "few words only")]])
def test_no_words(spark, rows):
    assert collected(spelling.digest(spark.createDataFrame(rows, "doc_id long, text string"))) == []
