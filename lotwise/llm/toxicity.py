"""Toxicity of documents: a string-kernel support vector machine with Nystrom landmarks.

The kernel of two words compares their gapped subsequences of three letters that span
``SPAN`` characters at most, each weighted by ``DECAY`` per character spanned, so letters put
between those of an insult only lessen the match; letters dealt out over single-letter words
are taken together. Accents are folded, digits and signs that stand for letters are read as
such.

Words of the labelled sentences are the training rows; a word counts as toxic where it is
far more frequent in toxic texts than chance allows. Landmarks are the words that tell the labels apart best. Kernel
values with the landmarks, whitened by the landmarks' own kernel matrix, feed a linear
machine. As the kernel has explicit features, the machine folds into one table of a weight
per letter triple, of a fixed size; a word's margin is a sum over its own triples. Margins of
all words of a whole text (the largest, their mean, number and share of those above levels)
then feed a logistic regression, which gives the score.

Null and empty texts have no words and get the score of a text without margins. Ids only
decide which labels are learned; null ids are never learned from. Without labelled rows of
both kinds every score is the share of toxic labels, or 0. Rows that repeat an id are scored
each; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lotwise.llm.common import ROW, carried, map_arrow, restored, small_batches, texts_of
from lotwise.sources.scratch import stored

SAMPLE = 3000  # labelled documents of each kind that are learned from, at most
LANDMARKS = 96
MIN_DOCUMENTS = 2
TELLING = 5.0  # standard errors between the labels from which a word is toxic
MIN_TOXIC = 4
RIDGE = 1e-4
STEPS = 12
SPAN = 5
DECAY = 0.75
THRESHOLD = 0.3
LETTERS = 28  # 0: any other sign, 1-26: letters, 27: other letters
GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
LEVELS = (0.0, 0.6, 0.9)  # margins from which words are counted
# Digits and signs that are read as letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# End of fixed values.


def _letter_table() -> np.ndarray:
    """Class of each UTF-16 code unit: -1 a blank, else 0 to LETTERS - 1."""
    table = np.zeros(1 << 16, np.int8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isspace():
            table[code] = -1
        elif char.isalpha() or char in LOOKALIKES:
            plain = unicodedata.normalize("NFKD", LOOKALIKES.get(char, char)).lower()[:1]
            table[code] = ord(plain) - 96 if "a" <= plain <= "z" else LETTERS - 1
    return table


TABLE = _letter_table()


def classes_of(text: str) -> np.ndarray:
    """Letter classes with a blank (-1) at both ends."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    return np.concatenate([[-1], TABLE[units], [-1]]).astype(np.int64)


def _words(classes: np.ndarray) -> tuple[np.ndarray, int]:
    """Word number at each place, -1 at blanks, and the number of words.

    A blank between two words of one character each does not part them.
    """
    blank = classes < 0
    single = np.zeros(len(classes), bool)
    single[1:-1] = ~blank[1:-1] & blank[:-2] & blank[2:]
    parts = blank.copy()
    parts[1:-1] &= ~(single[:-2] & single[2:])
    starts = parts[:-1] & ~parts[1:]
    number = np.concatenate([[-1], np.cumsum(starts) - 1])
    number[parts] = -1
    return number, int(starts.sum())


def triples(classes: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of gaps: triple ids, word numbers and weight of the matches in one word."""
    clean = np.maximum(classes, 0)
    for a, b in GAPS:
        n = len(classes) - a - b
        if n <= 0:
            continue
        x, y, z = clean[:n], clean[a : a + n], clean[a + b :]
        ok = (x > 0) & (y > 0) & (z > 0) & (number[:n] >= 0)
        ok &= number[:n] == number[a + b :]
        at = np.flatnonzero(ok)
        ids = (x[at] * LETTERS + y[at]) * LETTERS + z[at]
        yield ids, number[at], DECAY ** (a + b + 1)


def word_features(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Triple ids and weights of one word, of length one in all."""
    classes = classes_of(word)
    number = np.where(classes < 0, -1, 0)
    ids, weights = [], []
    for found, _, weight in triples(classes, number):
        ids.append(found)
        weights.append(np.full(len(found), weight))
    flat = np.bincount(np.concatenate(ids), np.concatenate(weights)) if ids else np.zeros(0)
    at = np.flatnonzero(flat)
    return at, flat[at] / max(1e-9, np.sqrt((flat[at] ** 2).sum()))


def landmark_matrix(landmarks: list[str]) -> np.ndarray:
    """A row of explicit kernel features for each landmark."""
    out = np.zeros((len(landmarks), LETTERS**3))
    for i, word in enumerate(landmarks):
        ids, weights = word_features(word)
        out[i, ids] = weights
    return out


def margins(text: str, table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin for every word that has a triple."""
    classes = classes_of(text)
    number, n = _words(classes)
    total, norm = np.zeros(n), np.zeros(n)
    for ids, words, weight in triples(classes, number):
        total += np.bincount(words, table[ids] * weight, n)
        norm += np.bincount(words, minlength=n) * weight**2
    real = norm > 0
    return total[real] / np.sqrt(norm[real]) + bias


def document_features(text: str, table: np.ndarray, bias: float) -> list[float]:
    found = margins(text, table, bias)
    if not len(found):
        return [-2.0, -2.0, *[0.0] * (2 * len(LEVELS) + 1)]
    over = [int((found > level).sum()) for level in LEVELS]
    high = np.sort(found)[-3:]
    shares = [np.sqrt(n / len(found)) for n in over]
    return [
        float(np.clip(found.max(), -2, 2)),
        float(np.clip(high.mean(), -2, 2)),
        *(float(np.log1p(n)) for n in over),
        *map(float, shares),
        float(np.log1p(len(found))),
    ]


def distinct_words(text: str) -> set[str]:
    return {w.strip(".,;:!?\"'()[]|") for w in text.lower().split()} - {""}


def learnable(id_col: str = "doc_id") -> Column:
    """Rows whose label may be learned."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)`` of a bounded sample by hash of the id; labels are joined by id.

    The sampled labels are ``2 * SAMPLE`` rows at most and so may be broadcast.
    """
    known = labels.filter(learnable() & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    parts = [
        known.filter(F.col("toxic") == kind).orderBy(order, "doc_id").limit(SAMPLE) for kind in (0, 1)
    ]
    sample = stored(parts[0].unionByName(parts[1]))
    return stored(
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    )


def _vocabulary(rows: DataFrame) -> DataFrame:
    """``(word, toxic, clean)``: documents of either kind that hold a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            words, toxic = [], []
            for text, kind in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found = distinct_words(text)
                words += found
                toxic += [kind] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(toxic, pa.int32())], names=["word", "kind"]
            )

    return (
        map_arrow(rows, run, "word string, kind int")
        .groupBy("word")
        .agg(F.sum("kind").alias("toxic"), F.sum(1 - F.col("kind")).alias("clean"))
        .filter(F.col("toxic") + F.col("clean") >= MIN_DOCUMENTS)
    )


def _kernel_rows(words: DataFrame, whitened: np.ndarray) -> DataFrame:
    """``words`` (word, toxic, clean, z) with their Nystrom features ``x``."""
    shared = words.sparkSession.sparkContext.broadcast(whitened)
    names = ["word", "toxic", "clean", "z"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                ids, weights = word_features(word)
                rows.append((shared.value[:, ids] @ weights).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.float64()))],
                names=[*names, "x"],
            )

    schema = "word string, toxic long, clean long, z double, x array<double>"
    return map_arrow(words.select(*names), run, schema)


def train_words(rows: DataFrame) -> tuple[np.ndarray, float]:
    """The machine as a weight per triple and a bias."""
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = stored(_vocabulary(rows))
    rate_t, rate_c = F.col("toxic") / n[1], F.col("clean") / n[0]
    pooled = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1])) + 1e-6
    words = words.withColumn("z", (rate_t - rate_c) / spread)
    best = words.orderBy(F.col("z").desc(), "word").limit(LANDMARKS)
    landmarks = landmark_matrix([r.word for r in best.select("word").collect()])
    values, axes = np.linalg.eigh(landmarks @ landmarks.T)
    root = axes / np.sqrt(np.maximum(values, 1e-2))
    whitened = root.T @ landmarks
    label = ((F.col("z") >= TELLING) & (F.col("toxic") >= MIN_TOXIC)).cast("double")
    weight = F.sqrt(F.col("toxic") + F.col("clean"))
    train = stored(_kernel_rows(words, whitened).select("x", label.alias("label"), weight.alias("w")))
    total = {r.label: r.w for r in train.groupBy("label").agg(F.sum("w").alias("w")).collect()}
    if len(total) < 2:
        return np.zeros(LETTERS**3), -1.0
    # Both kinds of words weigh one in all.
    scale = F.when(F.col("label") == 1, 1 / total[1.0]).otherwise(1 / total[0.0])
    machine = fit_machine(train.withColumn("w", F.col("w") * scale), len(whitened))
    return machine[:-1] @ whitened, float(machine[-1])


def fit_machine(train: DataFrame, width: int) -> np.ndarray:
    """Weights and bias that minimise the squared hinge loss, by Newton steps.

    ``train``: (x, label, w). A step sums gradient and Hessian over the rows; each task sends
    one pair of sums, of a size set by the number of landmarks.
    """
    machine = np.zeros(width + 1)
    ridge = np.append(np.full(width, RIDGE), 0.0)
    for _ in range(STEPS):

        def run(batches: Iterator[pa.RecordBatch], machine: np.ndarray = machine) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((width + 1, width + 2))
            for batch in batches:
                x = np.array(batch.column(0).to_pylist()).reshape(-1, width)
                x = np.hstack([x, np.ones((len(x), 1))])
                y = 2 * np.array(batch.column(1).to_pylist()) - 1
                w = np.array(batch.column(2).to_pylist())
                slack = np.maximum(0, 1 - y * (x @ machine))
                held = x[slack > 0] * w[slack > 0, None]
                sums[:, :-1] += held.T @ x[slack > 0]
                sums[:, -1] -= x.T @ (w * y * slack)
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["s"])

        parts = map_arrow(train.select("x", "label", "w"), run, "s binary").collect()
        sums = sum(np.frombuffer(p.s).reshape(width + 1, width + 2) for p in parts)
        step = np.linalg.solve(sums[:, :-1] + np.diag(ridge + 1e-9), sums[:, -1] + ridge * machine)
        machine = machine - step
        if np.abs(step).max() < 1e-6:
            break
    return machine


def _featured(docs: DataFrame, table: np.ndarray, bias: float, carried: list[str]) -> DataFrame:
    """``carried`` columns of ``docs`` with the features of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    rows = docs.select(*carried, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            found = [
                document_features(t, shared.value, bias) for t in texts_of(batch.column(len(carried)))
            ]
            made = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carried)], made], names=[*carried, "_x"]
            )

    schema = rows.select(*carried).schema.add("_x", ArrayType(DoubleType()))
    return map_arrow(rows, run, schema)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Columns of ``docs`` but the text, with ``held_out``, ``score`` and ``predicted``."""
    # Imported by the driver alone: MLlib brings pandas, which every worker would keep in memory.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = training_rows(docs.select(F.col(id_col).alias("doc_id"), "text"), labels)
    shares = labels.filter(learnable() & F.col("toxic").isin(0, 1)).agg(F.avg("toxic").alias("p")).first()
    prior = shares.p or 0.0
    kinds = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    carried = [c for c in docs.columns if c != "text"]
    held_out = F.coalesce(~learnable(id_col), F.lit(False))
    if len(kinds) < 2:
        value = F.lit(float(prior))
        scored = docs.select(*carried)
    else:
        table, bias = train_words(rows)
        sample = _featured(rows, table, bias, ["toxic"]).select(
            F.col("toxic").cast("double").alias("label"), array_to_vector("_x").alias("features")
        )
        # Weights give back the share of toxic labels that the sample has changed.
        weight = F.when(F.col("label") == 1, prior / kinds[1]).otherwise((1 - prior) / kinds[0])
        fitted = LogisticRegression(maxIter=100, regParam=1e-4, weightCol="w").fit(
            stored(sample.withColumn("w", weight * sum(kinds.values())))
        )
        scored = _featured(docs, table, bias, carried)
        linear = F.lit(float(fitted.intercept))
        for i, coefficient in enumerate(fitted.coefficients):
            linear = linear + F.lit(float(coefficient)) * F.element_at("_x", i + 1)
        value = 1 / (1 + F.exp(-linear))
    return (
        scored.withColumn("held_out", held_out)
        .withColumn("score", value)
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
        .drop("_x")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows predicted toxic, with the columns of ``docs``.

    Other columns, whatever their names, come back as they are.
    """
    named = carried(docs, id_col).withColumn(ROW, F.struct("text", ROW))
    kept = score(named, labels).filter("predicted = 0")
    kept = kept.select("doc_id", F.col(f"{ROW}.text").alias("text"), F.col(f"{ROW}.{ROW}").alias(ROW))
    return restored(kept, docs.columns, id_col=id_col)
