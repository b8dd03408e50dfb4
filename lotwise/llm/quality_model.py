"""Quality by perplexity under an interpolated modified Kneser-Ney model of words.

The model is trained on the trusted texts, all of them: n-grams of words (hashed, orders 1 to
3) are counted, and joined with the sums over their contexts and with the order below to
probabilities. The probability of a word that no trusted text has is its spelling's, under a
like model of the characters of the trusted vocabulary; only that table, ``ALPHABET ** ORDER``
numbers, is of a fixed size and broadcast. A document's perplexity is taken over all its words.

Texts are turned once into stored blocks of word numbers with a dictionary, a block for about
``BLOCK`` words, in it a section for each fold. What a section has to know of the corpus it
asks: its distinct n-grams go, as sorted hashes, to the groups that own their range of hashes;
a group counts those of trusted sections and answers each in the order it asked, with whole
numbers for the one model that judges it. So an n-gram costs a section some six bytes
however often it has it, none meets more rows than there are sections, and the answers are a
byte or less. Questions
are dealt out in ``TURNS`` turns by hash, so that the shuffle files of a turn alone lie on disk
(``ask``); blocks are judged from the answers in ``PARTS`` parts for the same reason.

Trusted texts fall into ``FOLDS`` parts by their hash, so equal texts into one, and each is
judged by a model of the other parts; all other documents by the model of all. Documents of a
language stay if their perplexity is at most the ``QUANTILE`` of these held-out perplexities of
the trusted documents of that language.

Words are runs of letters, digits and underscores, ideographs, kana and other signs but spaces
singly; case counts. Texts without words, null among them, have no perplexity (null) and do
not stay. Languages without trusted text, null among them, are held against the quantile of
all. Without any trusted text every document with words stays. Rows that repeat an id are
judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import map_arrow, map_groups, small_batches, table as read_table, texts_of
from lotwise.sources.scratch import discard, stored, together

ORDER = 4
ALPHABET = 40
QUANTILE = 0.99
FOLDS = 4
MODELS = range(FOLDS + 1)  # model 0: all trusted texts; model m: those outside part m
SINGLE = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
WORD = re.compile(f"[{SINGLE}]|[^\\W{SINGLE}]+|[^\\w\\s]")
START = np.uint64(0x5851F42D4C957F2D)
BLOCK = 3 << 20  # words of a block
TURNS = 16
PARTS = 16
GROUP = 1 << 20  # words of the texts for a group of ``ask``, about
LEAST = 128  # groups, where there is more than one
SPREAD = 20  # bits of a hash that a group can be named by
TOP = np.uint64((1 << 64) - (1 << 64 - SPREAD))


def _class_table() -> np.ndarray:
    """Class of each UTF-16 code unit: 1-26 letters, 27 accented, then other kinds; 0 starts a text."""
    table = np.full(1 << 16, 39, np.int64)
    marks = {c: 31 + i for i, c in enumerate(".,;:!?|")}
    for code in range(1 << 16):
        char = chr(code)
        kind = unicodedata.category(char)
        if char == "\n":
            table[code] = 29
        elif char.isspace():
            table[code] = 28
        elif kind[0] == "L":
            plain = char.lower()[:1]
            table[code] = ord(plain) - 96 if "a" <= plain <= "z" else 27
        elif kind[0] == "N":
            table[code] = 30
        elif char in marks:
            table[code] = marks[char]
        elif kind[0] == "P":
            table[code] = 38
    return table


TABLE = _class_table()


def grams_of(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ``order``-grams that end at each character, after starting marks, of all ``texts``.

    And where each text's begin; texts without characters have none.
    """
    whole = "".join(texts)
    units = np.frombuffer(whole.encode("utf-16-le", "surrogatepass"), "<u2")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if len(units) > sizes.sum():  # some characters take two units
        sizes = np.fromiter((len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(units)) - np.repeat(starts, sizes)
    classes = TABLE[units]
    out = classes.copy()
    for i in range(1, order):
        before = np.zeros(len(units), np.int64)
        before[i:] = classes[: len(units) - i]
        before[place < i] = 0
        out += before * ALPHABET**i
    return out, starts


def count_grams(texts: DataFrame) -> DataFrame:
    """``(g, c)``: counts of the n-grams of the highest order, combined per batch and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            grams, counts = np.unique(grams_of(texts_of(batch.column(0)))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], names=["g", "c"])

    return (
        map_arrow(texts.select("text"), run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    )


def _discounts(counts: DataFrame) -> DataFrame:
    """One row: the three discounts of modified Kneser-Ney, from counts of counts."""
    n = [F.sum((F.col("c") == i).cast("double")) for i in range(1, 5)]
    row = counts.agg(*(x.alias(f"n{i}") for i, x in enumerate(n, 1)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(i: int, default: float):
        value = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        usable = (F.col(f"n{i}") > 0) & (F.col("n1") > 0)
        return F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(float(i)), value))).otherwise(F.lit(default))

    with_ansi_safe = row.fillna(0.0)
    return with_ansi_safe.select(
        discount(1, 0.5).alias("d1"), discount(2, 1.0).alias("d2"), discount(3, 1.5).alias("d3")
    )


def log_probabilities(counts: DataFrame) -> np.ndarray:
    """Natural log probability of the last class of every ``ORDER``-gram, given the others.

    Each order joins the counts of n-grams with the sums over their contexts, which are
    shards of the same key space. The lower orders count the distinct classes before an
    n-gram. Only tables bounded by the alphabet reach the driver.
    """
    levels = {ORDER: stored(counts)}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = stored(
            levels[k + 1]
            .groupBy((F.col("g") % ALPHABET**k).alias("g"))
            .agg(F.count(F.lit(1)).alias("c"))
        )
    below = np.full(1, 1.0 / ALPHABET)
    for k in range(1, ORDER + 1):
        d = _discounts(levels[k]).first()
        cut = F.when(F.col("c") == 1, d.d1).when(F.col("c") == 2, d.d2).otherwise(d.d3)
        grams = levels[k].select("g", F.floor(F.col("g") / ALPHABET).alias("ctx"), "c", cut.alias("cut"))
        contexts = grams.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("cut").alias("spare"))
        joined = grams.join(contexts, "ctx").select(
            "g", "ctx", ((F.col("c") - F.col("cut")) / F.col("total")).alias("p"),
            (F.col("spare") / F.col("total")).alias("back"),
        )
        rows = joined.toPandas()
        back = np.ones(ALPHABET ** (k - 1))
        back[rows["ctx"].to_numpy(np.int64)] = rows["back"]
        lower = below[np.arange(ALPHABET**k) % ALPHABET ** (k - 1)] if k > 1 else below
        now = np.repeat(back, ALPHABET) * lower
        now[rows["g"].to_numpy(np.int64)] += rows["p"]
        below = now
    return np.log(np.maximum(below, 1e-12)).astype(np.float32)


def _scattered(x: np.ndarray) -> np.ndarray:
    """Numbers as hashes, all bits alike."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values, each once; several times as fast as ``np.unique`` on hashes."""
    values = np.sort(values)
    return values[_changes(values)]


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each sorted value differs from the one before."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, where one of each is, and the rank of every value among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = _changes(ordered)
    ranks = np.empty(len(values), np.int32)
    ranks[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], ranks


def _kinds() -> np.ndarray:
    """Of each character: 1 where it makes words with its neighbours, 2 where it is one, 0 for spaces."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.zeros(len(every), np.uint8)
    for kind, pattern in ((1, f"[^\\W{SINGLE}]+"), (2, f"(?:[{SINGLE}]|[^\\w\\s])+")):
        for run in re.finditer(pattern, every):
            kinds[run.start() : run.end()] = kind
    return kinds


KINDS = _kinds()
LETTERS = _scattered(np.arange(1, len(KINDS) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str, np.ndarray, np.ndarray]:
    """Hashes of the words that ``WORD`` finds in ``texts``, and how many each text has.

    Then all texts as one, and where in it each word begins and ends.
    """
    whole = "\n".join(texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = KINDS[codes]
    begins = kinds > 0
    at = np.flatnonzero(begins)
    joins = kinds == 1
    begins[1:] &= ~(joins[1:] & joins[:-1])
    first = np.flatnonzero(begins[at])
    sizes = np.diff(first, append=len(at))
    places = _scattered(np.arange(sizes.max(initial=0), dtype=np.uint64) - np.uint64(1 << 40))
    parts = LETTERS[codes[at]] ^ places[np.arange(len(at)) - np.repeat(first, sizes)]
    parts *= np.uint64(0xD6E8FEB86659FD93)
    parts ^= parts >> np.uint64(32)
    hashes = _scattered(np.add.reduceat(parts, first)) if len(first) else np.zeros(0, np.uint64)
    starts = at[first]
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    return hashes, counts, whole, starts, starts + sizes


def pack(*columns: np.ndarray) -> bytes:
    """Columns of floats, or of whole numbers from 0 in as many bytes as the largest takes, compressed."""
    head, body = [len(columns)], []
    for column in columns:
        if column.dtype.kind == "f":
            size, code, column = 8, 9, np.ascontiguousarray(column, "<f8")
        else:
            column = np.ascontiguousarray(column.astype("<u8", copy=False))
            size = code = max(1, (int(column.max(initial=0)).bit_length() + 7) // 8)
        head += [code, len(column)]
        # Bytes of one significance together: the high ones are much alike.
        body.append(column.view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes())
    raw = np.array(head, "<u8").tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    found, at = [], 8 + 16 * n
    for code, length in np.frombuffer(raw, "<u8", 2 * n, 8).reshape(n, 2).tolist():
        size = min(code, 8)
        planes = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        if size <= 4:
            column = planes[0].astype(np.uint32)
            for k in range(1, size):
                column |= planes[k].astype(np.uint32) << np.uint32(8 * k)
        else:
            column = np.zeros((length, 8), np.uint8)
            column[:, :size] = planes.T
            column = column.view("<f8" if code == 9 else "<u8").reshape(length)
        found.append(column)
        at += size * length
    return found


def _steps(keys: np.ndarray) -> np.ndarray:
    """Of sorted keys, what each adds: fewer bytes. ``np.cumsum`` undoes it."""
    return np.diff(keys, prepend=np.uint64(0))


def _found(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` are in sorted ``among``, and whether they are; nothing is at the end of it."""
    at = np.searchsorted(among, keys)
    has = at < len(among)
    has[has] = among[at[has]] == keys[has]
    return np.where(has, at, len(among)), has


def _rows(schema: str, *columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _by_fold(
    batches: Iterator[pa.RecordBatch], row: int | None, fold: int, text: int, limit: int = 1 << 18
) -> Iterator[tuple[int, np.ndarray | None, list[str]]]:
    """Texts of one fold, ``limit`` bytes at most, with their fold and rows."""
    for batch in small_batches(batches, limit):
        folds, texts = batch.column(fold).to_numpy(), texts_of(batch.column(text))
        for value in np.unique(folds).tolist():
            which = np.flatnonzero(folds == value)
            rows = None if row is None else batch.column(row).to_numpy()[which]
            yield value, rows, [texts[i] for i in which]


def document_grams(docs: DataFrame) -> DataFrame:
    """``(row, fold, w1, w2, w3, n)``: distinct word 3-grams of each row of ``docs``, with counts.

    Words are hashes; two starting marks come before the first. Blocks hold the same n-grams
    packed; this is for looking at them.
    """
    schema = "row long, fold int, w1 long, w2 long, w3 long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, rows, texts in _by_fold(batches, 0, 1, 2):
            hashes, sizes, *_ = words_of(texts)
            grams = np.stack([*_before(hashes, sizes), hashes, np.repeat(rows, sizes).view(np.uint64)])
            grams, counts = np.unique(grams, axis=1, return_counts=True)
            w1, w2, w3, own = grams.view(np.int64)
            yield _rows(schema, own, np.full(len(own), fold), w1, w2, w3, counts)

    return map_arrow(docs.select("row", "fold", "text"), run, schema)


def _before(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two words before each word of texts of so many words."""
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    last = np.concatenate([[START], hashes])[:-1]
    last[starts] = START
    second = np.concatenate([[START], last])[:-1]
    second[starts] = START
    return second, last


BLOCKS = "n long, blob binary"


def blocks_of(docs: DataFrame) -> DataFrame:
    """``(block, n, blob)``: texts as numbers of words, the most frequent lowest, by fold."""

    def block(held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        held.sort(key=lambda x: x[0])
        folds = np.repeat([x[0] for x in held], [len(x[2]) for x in held])
        hashes, sizes, rows = (np.concatenate([x[i] for x in held]) for i in (1, 2, 3))
        words, _, ids = _ranked(hashes)
        order = np.argsort(-np.bincount(ids), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        some = sizes > 0
        blob = pack(_steps(words[order]), rank[ids], folds[some], sizes[some], rows[some].view(np.uint64))
        return _rows(BLOCKS, [len(ids)], [blob])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for fold, rows, texts in _by_fold(batches, 0, 1, 2):
            hashes, sizes, *_ = words_of(texts)
            if len(hashes):
                held.append((fold, hashes, sizes, rows))
                n += len(hashes)
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)

    found = map_arrow(docs.select("row", "fold", "text"), run, BLOCKS)
    return found.withColumn("block", F.monotonically_increasing_id()).select("block", "n", "blob")


class _Section:
    """The texts of one fold of a block: ``ids`` of their words and of the ``last`` and ``second`` last before.

    ``words`` are those of the block, the starting mark last. Hashes of pairs begin with bits that
    are cheap to know (``spread``), so that a turn hashes no other pairs than its own.
    """

    def __init__(self, fold: int, words: np.ndarray, ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        self.fold, self.words, self.ids, self.sizes, self.rows = fold, words, ids, sizes, rows
        self.starts = np.cumsum(sizes) - sizes
        self.last = self._before(ids, len(words) - 1)
        self.second = self._before(self.last, len(words) - 1)

    def _before(self, values: np.ndarray, start: int) -> np.ndarray:
        found = np.empty_like(values)
        found[1:] = values[:-1]
        found[self.starts] = start
        return found

    def _ends(self, role: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.last, self.ids) if role else (self.second, self.last)

    def of_turn(self, role: int, turn: int, turns: int) -> np.ndarray | slice:
        """Positions whose pairs, contexts in role 0, are of the turn."""
        if turns == 1:
            return slice(None)
        spread = (self.words >> np.uint64(56)).astype(np.uint8)
        found = spread[self.ids]
        before = self._before(found, spread[-1])
        if role == 0:
            found, before = before, self._before(before, spread[-1])
        found ^= before
        found >>= np.uint8(9 - turns.bit_length())
        return np.flatnonzero(found == turn)

    def keys(self, role: int, which: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of pairs, and of the 3-grams that they are contexts or ends of; one group has both."""
        first, second = (self.words[x[which]] for x in self._ends(role))
        pairs = _mixed(first, second)
        triples = pairs if role == 0 else _mixed(self.words[self.second[which]], first)
        triples = _mixed(triples, self.words[self.ids[which]])
        pairs = pairs >> np.uint64(8)
        pairs |= (first ^ second) & np.uint64(0xFF << 56)
        triples &= ~TOP
        triples |= pairs & TOP
        return pairs, triples

    def used(self) -> np.ndarray:
        """Ids of its words and of the starting mark, in the order of the words' hashes."""
        own = np.zeros(len(self.words), bool)
        own[self.ids] = own[-1] = True
        own = np.flatnonzero(own)
        return own[np.argsort(self.words[own])]


def _sections(blob: bytes) -> list[_Section]:
    steps, ids, folds, sizes, rows = unpack(blob)
    words = np.append(np.cumsum(steps), START)
    ids, sizes, rows = ids.astype(np.int32), sizes.astype(np.int64), rows.astype(np.uint64)
    ends = np.append(0, np.cumsum(sizes))
    bounds = np.append(np.flatnonzero(_changes(folds)), len(folds))
    return [
        _Section(int(folds[a]), words, ids[ends[a] : ends[b]], sizes[a:b], rows[a:b])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]


def _of(group: np.ndarray | int, groups: int) -> np.ndarray:
    """The group, of a power of two, that a hash belongs to."""
    return group >> np.uint64(65 - groups.bit_length()) if groups > 1 else group & np.uint64(0)


ASKED = "to long, block long, blob binary"
ANSWERS = "block long, server long, role int, blob binary"


def ask(blocks: DataFrame, turn: int, turns: int, groups: int) -> DataFrame:
    """``(block, server, role, blob)``: what the blocks ask in a turn, answered.

    Role 0 owns pairs of words as contexts, role 1 as ends of 3-grams; either has the 3-grams
    of its pairs. Rows with the block -1 have counts of counts of the role's order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sections = _sections(row["blob"])
                for role in (0, 1):
                    yield _questions(row["block"], sections, role, turn, turns, groups)

    asked = map_arrow(blocks.select("block", "blob"), run, ASKED)
    return map_groups(asked, "to", _answers, ANSWERS)


def _questions(
    number: int, sections: list[_Section], role: int, turn: int, turns: int, groups: int
) -> pa.RecordBatch:
    """What a block asks in a turn: by fold distinct pairs and, where they are counted or wanted, 3-grams."""
    own = np.arange(turn * (groups // turns), (turn + 1) * (groups // turns) + 1).astype(np.uint64)
    none = np.zeros(0, np.uint64)
    asked: list[list] = [[] for _ in own[1:]]
    sizes = np.zeros((len(asked), 2, len(MODELS)), np.int64)
    for section in sections:
        which = section.of_turn(role, turn, turns)
        keys, triples = section.keys(role, which)
        pairs, of, counts = _distinct(keys), none, none
        if section.fold:
            order = np.argsort(triples)
            triples = triples[order]
            first = np.flatnonzero(_changes(triples))
            counts = np.diff(first, append=len(triples))
            triples, of = triples[first], np.searchsorted(pairs, keys[order[first]])
        else:
            triples = _distinct(triples) if role == 0 else none
        of_pairs = np.searchsorted(_of(pairs, groups), own).tolist()
        of_triples = np.searchsorted(_of(triples, groups), own).tolist()
        for k, some in enumerate(asked):
            a, b, x, y = of_pairs[k], of_pairs[k + 1], of_triples[k], of_triples[k + 1]
            before = sizes[k, 0].sum() - a
            sizes[k, :, section.fold] = b - a, y - x
            some.append((pairs[a:b], triples[x:y], of[x:y] + before, counts[x:y]))
    to, blobs = [], []
    for k, some in enumerate(asked):
        if sizes[k, 0].any():
            pairs, triples, of, counts = (np.concatenate(x) for x in zip(*some, strict=True))
            to.append(2 * int(own[k]) + role)
            blobs.append(pack(sizes[k].ravel(), _steps(pairs), _steps(triples), of, counts))
    return _rows(ASKED, to, [number] * len(to), blobs)


def _answers(asked: pa.Table) -> pa.Table:
    """What one group answers: in role 0 counts of 3-grams and sums over contexts, in role 1 of how
    many words each pair comes after; trusted sections get the latter for all models, each pair once."""
    server, role = divmod(asked.column("to")[0].as_py(), 2)
    questions = []
    for blob in asked.column("blob").to_pylist():
        sizes, pairs, triples, of, counts = unpack(blob)
        sizes = sizes.reshape(2, -1).astype(np.int64)
        questions.append((sizes, np.cumsum(pairs), np.cumsum(triples), of.astype(np.int64), counts))
    # Folds come in order, so those of trusted texts are the last.
    triples = np.concatenate([x[2][x[0][1, 0] :] for x in questions])
    owners = np.concatenate([x[1][x[3]] for x in questions])
    parts = np.concatenate([np.repeat(np.arange(FOLDS), x[0][1, 1:]) for x in questions])
    counts = np.concatenate([x[4] for x in questions]).astype(np.float64)
    order = np.argsort(triples)
    triples = triples[order]
    new = _changes(triples)
    at = np.cumsum(new) - 1
    triples, owners = triples[new], owners[order[new]]
    by_fold = np.bincount(at * FOLDS + parts[order], counts[order], len(triples) * FOLDS)
    by_fold = by_fold.reshape(-1, FOLDS).astype(np.int64)
    total = by_fold.sum(axis=1)
    pairs, _, inverse = _ranked(owners)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(inverse, values, len(pairs)).astype(np.int64), 0)

    # The last entry of each is for what no trusted text has.
    models, stats = [], []
    for m in MODELS:
        c = total - by_fold[:, m - 1] if m else total
        if role == 0:
            sums = [summed(c), *(summed((c == i) if i < 3 else (c > 2)) for i in (1, 2, 3))]
            stats += [np.count_nonzero(c == i) for i in range(1, 5)]
        else:
            sums = [summed(c > 0)]
            stats += [np.count_nonzero(sums[0] == i) for i in range(1, 5)]
        models.append((np.append(c, 0), sums))
    blobs, had = [], np.zeros(len(pairs) + 1, bool)
    for sizes, some, grams, _, _ in questions:
        of_pairs = np.split(_found(some, pairs)[0], np.cumsum(sizes[0])[:-1])
        of_grams = np.split(_found(grams, triples)[0], np.cumsum(sizes[1])[:-1])
        sums = [np.concatenate([models[m][1][i][of_pairs[m]] for m in MODELS]) for i in range(len(models[0][1]))]
        if role == 0:
            counts = np.concatenate([models[m][0][of_grams[m]] for m in MODELS])
            blobs.append(pack(sizes.ravel(), counts, *_shortened(sums)))
        else:
            mine = [np.zeros(0, bool)]
            for where in of_pairs[1:]:
                mine.append(~had[where])
                had[where] = True
            mine = np.concatenate(mine)
            where = np.concatenate(of_pairs[1:])[mine]
            blobs.append(pack(sizes.ravel(), sums[0], mine, *(models[m][1][0][where] for m in MODELS)))
    n = len(blobs)
    return pa.Table.from_batches([
        _rows(ANSWERS, asked.column("block").to_pylist(), [server] * n, [role] * n, blobs),
        _rows(ANSWERS, [-1], [server], [role], [pack(np.array(stats))]),
    ])


def _shortened(sums: list[np.ndarray]) -> list[np.ndarray]:
    """Totals and numbers of ones, twos and more as one column, and more where that does not say it all."""
    total, one, two, more = sums
    plain = (total == one) & (one < 255)
    return [np.where(plain, one, 255), *(x[~plain] for x in (total, one, two, more))]


def _lengthened(short: np.ndarray, *rest: np.ndarray) -> list[np.ndarray]:
    zeros = np.zeros(len(short), np.int64)
    sums = [short.astype(np.int64), short.astype(np.int64), zeros, zeros.copy()]
    for column, some in zip(sums, rest, strict=True):
        column[short == 255] = some
    return sums


def _contexts_heard(blobs: list[bytes]) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """By fold, sums over the contexts of its section and counts of its 3-grams."""
    heard: list[list] = [[] for _ in MODELS]
    for blob in blobs:
        sizes, counts, *short = unpack(blob)
        of_pairs, of_grams = np.cumsum(sizes.reshape(2, -1), axis=1).astype(np.int64)[:, :-1]
        sums = [np.split(x, of_pairs) for x in _lengthened(*short)]
        counts = np.split(counts.astype(np.int32), of_grams)
        for m in MODELS:
            heard[m].append([*(x[m] for x in sums), counts[m]])
    found = [[np.concatenate(x) for x in zip(*some, strict=True)] for some in heard]
    return [(x[:-1], x[-1]) for x in found]


def _ends_heard(blobs: list[bytes]) -> list[np.ndarray]:
    """By fold, of how many words each pair of its section comes after."""
    heard: list[list] = [[] for _ in MODELS]
    for blob in blobs:
        sizes, after, *_ = unpack(blob)
        for m, some in enumerate(np.split(after.astype(np.int32), np.cumsum(sizes[: len(MODELS)])[:-1].astype(np.int64))):
            heard[m].append(some)
    return [np.concatenate(x) for x in heard]


def _owned_heard(blobs: list[bytes]) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """By fold, which pairs its section is to count for all, and of how many words those come after by model."""
    heard: list[list] = [[] for _ in MODELS]
    for blob in blobs:
        sizes, _, mine, *after = unpack(blob)
        mine = np.split(mine > 0, np.cumsum(sizes[1 : len(MODELS)])[:-1].astype(np.int64))
        ends = np.cumsum([x.sum() for x in mine])[:-1]
        after = [np.split(x.astype(np.int64), ends) for x in after]
        for f in range(FOLDS):
            heard[f + 1].append([mine[f], *(x[f] for x in after)])
    found = [[np.concatenate(x) for x in zip(*some, strict=True)] for some in heard]
    return [(x[0], x[1:]) if x else (np.zeros(0, bool), []) for x in found]


def _joined(answers: list[bytes]) -> list[np.ndarray]:
    """Answers of all groups, in the order of the hashes."""
    return [np.concatenate(x) for x in zip(*map(unpack, answers), strict=True)]


def _blobs(rows: pa.Table) -> dict[tuple[int, int], list[bytes]]:
    """The blobs of a block, or of a section, by kind and fold in the order of their servers."""
    found: dict[tuple[int, int], list] = {}
    for r in sorted(rows.to_pylist(), key=lambda r: r["server"]):
        found.setdefault((r["kind"], r["fold"]), []).append(r["blob"])
    return found


def _dealt(words: np.ndarray, groups: int) -> Iterator[tuple[int, slice]]:
    """Of sorted hashes, the slice of each group that has any."""
    bounds = np.searchsorted(_of(words, groups), np.arange(groups + 1).astype(np.uint64))
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        yield k, slice(bounds[k], bounds[k + 1])


WORDS = "to long, kind int, block long, fold int, blob binary"
GATHERED = "block long, kind int, server long, fold int, blob binary"
SELF, CONTEXTS, ENDS, VALUES = range(4)
SUMS, SPELLED, WANTED, STATS = range(4)


def word_sums(blocks: DataFrame, answers: DataFrame, groups: int, parts: int) -> DataFrame:
    """``(to, kind, block, fold, blob)``: for each word and model the sum over the pairs that it begins,
    how many of these count 1, 2, more, and how many words it comes after.

    Rows of the kind ``STATS`` have the counts of counts of the last.
    """
    schema = "to long, blob binary"

    def one(rows: pa.Table) -> pa.Table:
        words, sums = np.zeros(0, np.uint64), []
        blobs = _blobs(rows)
        owned = _owned_heard(blobs[ENDS, -1])
        for section in _sections(blobs[SELF, -1][0]):
            if not section.fold:
                continue
            mine, models = owned[section.fold]
            words, n = section.words, len(section.words)
            first = _ranked(section.keys(1, slice(None))[0])[1][mine]
            a, b = section.last[first], section.ids[first]
            found = []
            for c in models:
                found += [np.bincount(a, x, n).astype(np.int64) for x in (c, c == 1, c == 2, c > 2)]
                found.append(np.bincount(b, c > 0, n).astype(np.int64))
            sums = [x + y for x, y in zip(sums, found, strict=True)] if sums else found
        some = np.flatnonzero(np.any(sums, axis=0)) if sums else np.zeros(0, np.int64)
        some = some[np.argsort(words[some])]
        words, sums = words[some], [x[some] for x in sums]
        to, blobs = [], []
        for k, part in _dealt(words, groups):
            to.append(k)
            blobs.append(pack(_steps(words[part]), *(x[part] for x in sums)))
        return pa.Table.from_batches([_rows(schema, to, blobs)])

    def add(rows: pa.Table) -> pa.Table:
        words, *sums = _gathered(rows.column("blob").to_pylist())
        stats = []
        for m in MODELS:
            after = sums[5 * m + 4]
            stats += [after.sum(), *(np.count_nonzero(after == i) for i in range(1, 5)), np.count_nonzero(after > 2)]
        to = rows.column("to")[0].as_py()
        blobs = [pack(_steps(words), *sums), pack(np.array(stats))]
        return pa.Table.from_batches([_rows(WORDS, [to, to], [SUMS, STATS], [-1, -1], [-1, -1], blobs)])

    found = []
    for part in range(parts):
        rows = _selves(blocks).unionByName(_heard(answers.filter("role = 1"))).filter(_part(part, parts))
        found.append(stored(map_groups(rows, "block", one, schema)))
    sums = stored(map_groups(together(found), "to", add, WORDS))
    for some in found:
        discard(some)
    return sums


def _heard(answers: DataFrame) -> DataFrame:
    kind = F.when(F.col("role") == 0, CONTEXTS).otherwise(ENDS).alias("kind")
    return answers.filter("block >= 0").select("block", kind, "server", F.lit(-1).alias("fold"), "blob")


def _selves(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "block", F.lit(SELF).alias("kind"), F.lit(0).cast("long").alias("server"), F.lit(-1).alias("fold"), "blob"
    )


def _part(part: int, parts: int) -> Column:
    """Whether a row's block is of the part."""
    return F.pmod(F.xxhash64("block"), F.lit(parts)) == part


def _gathered(blobs: list[bytes]) -> list[np.ndarray]:
    """Words of all blobs, each once, with the sums of their columns."""
    parts = [unpack(blob) for blob in blobs]
    hashes = np.concatenate([np.cumsum(x[0]) for x in parts])
    words, _, at = _ranked(hashes)
    return [words] + [
        np.bincount(at, np.concatenate([x[k] for x in parts]).astype(np.float64), len(words)).astype(np.int64)
        for k in range(1, len(parts[0]))
    ]


def vocabulary(docs: DataFrame, groups: int) -> DataFrame:
    """``(to, blob)``: hash and characters of every word, and the sum of ``1 << fold`` over the folds that
    have it."""
    schema = "to long, blob binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[int, str] = {}
        folds: dict[int, int] = {}
        for fold, _, texts in _by_fold(batches, None, 0, 1, 4 << 20):
            hashes, _, whole, starts, ends = words_of(texts)
            distinct, first, _ = _ranked(hashes)
            bit = 1 << fold
            for word, a, b in zip(distinct.tolist(), starts[first].tolist(), ends[first].tolist(), strict=True):
                have = folds.get(word)
                if have is None:
                    names[word] = whole[a:b]
                    folds[word] = bit
                elif not have & bit:
                    folds[word] = have | bit
            if len(folds) > 300_000:
                yield rows(names, folds)
                names, folds = {}, {}
        yield rows(names, folds)

    def rows(names: dict[int, str], folds: dict[int, int]) -> pa.RecordBatch:
        hashes = np.fromiter(names, np.uint64, len(names))
        order = np.argsort(hashes)
        hashes, masks = hashes[order], np.fromiter(folds.values(), np.int64, len(folds))[order]
        words = list(names.values())
        words = [words[i] for i in order.tolist()]
        to, blobs = [], []
        for k, part in _dealt(hashes, groups):
            to.append(k)
            blobs.append(_named(hashes[part], masks[part], words[part]))
        return _rows(schema, to, blobs)

    def merged(rows: pa.Table) -> pa.Table:
        parts = [_names(blob) for blob in rows.column("blob").to_pylist()]
        words, first, at = _ranked(np.concatenate([x[0] for x in parts]))
        masks = np.zeros(len(words), np.int64)
        np.bitwise_or.at(masks, at, np.concatenate([x[1] for x in parts]).astype(np.int64))
        every = [word for x in parts for word in x[2]]
        blob = _named(words, masks, [every[i] for i in first.tolist()])
        return pa.Table.from_batches([_rows(schema, [rows.column("to")[0].as_py()], [blob])])

    return map_groups(map_arrow(docs.select("fold", "text"), run, schema), "to", merged, schema)


def _named(hashes: np.ndarray, masks: np.ndarray, words: list[str]) -> bytes:
    # Words hold no line ends.
    return pack(_steps(hashes), masks, np.frombuffer("\n".join(words).encode(), np.uint8))


def _names(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[str]]:
    steps, masks, letters = unpack(blob)
    return np.cumsum(steps), masks, letters.astype(np.uint8).tobytes().decode().split("\n")


def spelled(words: DataFrame) -> DataFrame:
    """``(to, kind, block, fold, blob)``: log probability of each word's characters and its end, under the
    models that judge texts with it. ``words`` are discarded."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                _, masks, names = _names(blob)
                grams, starts = grams_of([f"{word} " for word in names])
                masks = np.repeat(masks, np.diff(starts, append=len(grams)))
                for m in MODELS:
                    trains = sum(1 << f for f in MODELS if f and f != m)
                    found, counts = np.unique(grams[masks & np.uint64(trains) > 0], return_counts=True)
                    yield _rows("m int, g long, c long", np.full(len(found), m), found, counts)

    grams = map_arrow(words, train, "m int, g long, c long")
    counted = stored(grams.groupBy("m", "g").agg(F.sum("c").alias("c")))
    tables = [log_probabilities(counted.filter(F.col("m") == m).select("g", "c")) for m in MODELS]
    shared = words.sparkSession.sparkContext.broadcast(np.stack(tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, blob in zip(batch.column("to").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                hashes, masks, names = _names(blob)
                grams, starts = grams_of([f"{word} " for word in names])
                logs = []
                for m in MODELS:
                    sums = np.add.reduceat(shared.value[m][grams].astype(np.float64), starts)
                    logs.append(sums[masks >> np.uint64(m) & np.uint64(1) > 0])
                yield _rows(WORDS, [to], [SPELLED], [-1], [-1], [pack(_steps(hashes), masks, *logs)])

    found = stored(map_arrow(words, run, WORDS))
    shared.destroy()  # its copies lie on the disks of all executors
    discard(words)
    return found


def _discounted(n: list[int]) -> list[float]:
    """The three discounts of a model, from its numbers of n-grams that count 1, 2, 3 and 4."""
    n = [0.0, *map(float, n)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    # Every context keeps something for words it has not seen, every seen word something of its own.
    return [
        min(0.99 * i, max(0.01 * i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[1] else i / 2
        for i in (1, 2, 3)
    ]


def _interpolated(
    counts: np.ndarray, total: np.ndarray, left: np.ndarray, cuts: list[float], lower: np.ndarray
) -> np.ndarray:
    """Log probabilities of last words that ``counts`` n-grams have after contexts with ``total``.

    ``left`` is the share that a context leaves to the order below, ``lower`` the log
    probability there. Contexts no text of the model has leave it all.
    """
    cut = np.array([0.0, *cuts])[np.minimum(counts, 3)]
    logs = lower.copy()
    some = total > 0
    rest = some & (counts == 0)
    logs[rest] += np.log(left[rest])
    seen = some & (counts > 0)
    logs[seen] = np.log((counts[seen] - cut[seen]) / total[seen] + left[seen] * np.exp(lower[seen]))
    return logs


def _shares(sums: list[np.ndarray], cuts: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Totals of contexts, and the share of each for words it has not seen."""
    total, *ones = (x.astype(np.float64) for x in sums)
    spare = sum(d * n for d, n in zip(cuts, ones, strict=True))
    return total, spare / np.maximum(total, 1)


def scores(
    blocks: DataFrame, answers: DataFrame, words: DataFrame, groups: int, cuts: dict[str, list]
) -> DataFrame:
    """``(row, total, n)``: sums of log probabilities and numbers of words of the texts of ``blocks``.

    ``cuts`` has the discounts of each order by model, and of words the total and the share left.
    """
    schema = "row long, total double, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for section in _sections(row["blob"]):
                    hashes, to, blobs = section.words[section.used()], [], []
                    for k, part in _dealt(hashes, groups):
                        to.append(k)
                        blobs.append(pack(_steps(hashes[part])))
                    n = len(to)
                    yield _rows(WORDS, to, [WANTED] * n, [row["block"]] * n, [section.fold] * n, blobs)

    def values(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        wanted = [r for r in rows if r["kind"] == WANTED]
        sums = [unpack(r["blob"]) for r in rows if r["kind"] == SUMS]
        known = np.cumsum(sums[0][0]) if sums else np.zeros(0, np.uint64)
        sums = [np.append(x, 0).astype(np.int64) for x in (sums[0][1:] if sums else [known] * 5 * len(MODELS))]
        spellings: list[list] = [[] for _ in MODELS]
        for r in rows:
            if r["kind"] == SPELLED:
                steps, folds, *logs = unpack(r["blob"])
                hashes = np.cumsum(steps)
                for m in MODELS:
                    spellings[m].append((hashes[folds >> np.uint64(m) & np.uint64(1) > 0], logs[m]))
        spelling = {}
        blobs = []
        for r in wanted:
            m, hashes = r["fold"], np.cumsum(unpack(r["blob"])[0])
            if m not in spelling:
                own = spellings[m] or [(known[:0], np.zeros(0))]
                names, logs = (np.concatenate(x) for x in zip(*own, strict=True))
                order = np.argsort(names)
                spelling[m] = names[order], np.append(logs[order], 0.0)
            names, logs = spelling[m]
            at, _ = _found(hashes, known)
            total, left = _shares([sums[5 * m + i][at] for i in range(4)], cuts["second"][m])
            all_words, spare = cuts["words"][m]
            n = len(hashes)
            first = _interpolated(
                sums[5 * m + 4][at], np.full(n, all_words), np.full(n, spare), cuts["first"][m],
                logs[_found(hashes, names)[0]],
            )
            blobs.append(pack(first, total.astype(np.uint64), left[total > 0]))
        n, to = len(wanted), rows[0]["to"]
        return pa.Table.from_batches([
            _rows(GATHERED, [r["block"] for r in wanted], [VALUES] * n, [to] * n, [r["fold"] for r in wanted], blobs)
        ])

    def judged(rows: pa.Table) -> pa.Table:
        found = []
        blobs = _blobs(rows)
        contexts, ends = _contexts_heard(blobs[CONTEXTS, -1]), _ends_heard(blobs[ENDS, -1])
        for section in _sections(blobs[SELF, -1][0]):
            values = _joined(blobs[VALUES, section.fold])
            logs = logs_of(section, values, contexts[section.fold], ends[section.fold])
            sums = np.add.reduceat(logs, section.starts)
            found.append(_rows(schema, section.rows.view(np.int64), sums, section.sizes))
        return pa.Table.from_batches(found)

    def logs_of(
        section: _Section, values: list[np.ndarray], contexts: tuple[list[np.ndarray], np.ndarray], after: np.ndarray
    ) -> np.ndarray:
        m, used, n = section.fold, section.used(), len(section.words)
        values, total, shares = values
        first, totals, left = np.zeros(n), np.zeros(n), np.zeros(n)
        first[used], totals[used], left[used[total > 0]] = values, total, shares
        after = after[_ranked(section.keys(1, slice(None))[0])[2]]
        logs = _interpolated(
            after, totals[section.last], left[section.last], cuts["second"][m], first[section.ids]
        )
        totals, left = _shares(contexts[0], cuts["third"][m])
        pairs, triples = section.keys(0, slice(None))
        at = _ranked(pairs)[2]
        totals, left = totals[at], left[at]
        return _interpolated(contexts[1][_ranked(triples)[2]], totals, left, cuts["third"][m], logs)

    asked = map_arrow(blocks.select("block", "blob"), run, WORDS)
    got = map_groups(words.unionByName(asked), "to", values, GATHERED)
    return map_groups(_selves(blocks).unionByName(_heard(answers)).unionByName(got), "block", judged, schema)


def _summed(rows: DataFrame) -> np.ndarray:
    """Sums of the counts of counts of all groups, a row for each model."""
    sums = [unpack(r.blob)[0].astype(np.int64) for r in rows.select("blob").toLocalIterator()]
    return np.sum(sums, axis=0).reshape(len(MODELS), -1)


def perplexities(docs: DataFrame) -> DataFrame:
    """``(row, perplexity)`` of every row with words, by the model of its ``fold``.

    ``docs`` has ``row``, ``fold`` and ``text``; it is read twice. Rows of one number count as one text.
    """
    blocks = stored(blocks_of(docs))
    number, n = blocks.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not number:
        return blocks.select(F.col("block").alias("row"), F.lit(None).cast("double").alias("perplexity"))
    groups = 1 if n <= GROUP else min(1 << SPREAD, max(LEAST, 1 << (n // GROUP).bit_length()))
    turns, parts = min(TURNS, groups), max(1, min(PARTS, number // 6))
    dealt = max(1, groups // 8)
    spellings = spelled(stored(vocabulary(docs, dealt)))
    answers = together([stored(ask(blocks, turn, turns, groups)) for turn in range(turns)])
    sums = word_sums(blocks, answers, dealt, parts)
    counted = answers.filter("block < 0")
    cuts = {
        "third": [_discounted(x) for x in _summed(counted.filter("role = 0")).tolist()],
        "second": [_discounted(x) for x in _summed(counted.filter("role = 1")).tolist()],
    }
    cuts |= _word_cuts(sums)
    words = sums.filter(F.col("kind") == SUMS).unionByName(spellings)
    found = []
    for part in range(parts):
        own = _part(part, parts)
        found.append(stored(scores(blocks.filter(own), answers.filter(own), words, dealt, cuts)))
    totals = together(found).groupBy("row").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return totals.select("row", F.exp(-F.col("total") / F.col("n")).alias("perplexity"))


def _word_cuts(sums: DataFrame) -> dict[str, list]:
    """Discounts of single words by model, and their total and the share left to spelling."""
    rows = sums.filter(F.col("kind") == STATS)
    found: dict[str, list] = {"first": [], "words": []}
    stats = _summed(rows).tolist() if not rows.isEmpty() else [[0] * 6 for _ in MODELS]
    for total, *n, more in stats:
        cuts = _discounted(n)
        spare = cuts[0] * n[0] + cuts[1] * n[1] + cuts[2] * more
        found["first"].append(cuts)
        found["words"].append((total, spare / max(total, 1)))
    return found


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, lang, trusted, perplexity, threshold, kept)`` for every row of ``docs``.

    Trusted texts are all documents labelled of good quality.
    """
    # Ids are a few bytes where texts are thousands: sent to the texts, which stay where they are.
    good = F.broadcast(labels.filter("quality = 1").select(F.col("doc_id").alias(id_col)).distinct())
    part = (1 + F.pmod(F.xxhash64("text"), F.lit(FOLDS))).cast("int")
    # Equal texts that are trusted alike have one perplexity, so a row is named by what it holds.
    marked = (
        docs.select(id_col, "lang", "text")
        .join(good.withColumn("trusted", F.lit(True)), id_col, "left")
        .withColumn("trusted", F.coalesce("trusted", F.lit(False)))
        .withColumn("fold", F.when(F.col("trusted"), part).otherwise(F.lit(0)))
        .withColumn("row", F.xxhash64("text", "trusted"))
    )
    scored = stored(
        marked.select("row", id_col, "lang", "trusted").join(perplexities(marked), "row", "left")
    )
    trusted = scored.filter("trusted and perplexity is not null")
    quantile = F.percentile_approx("perplexity", QUANTILE, 10_000)
    by_language = trusted.groupBy("lang").agg(quantile.alias("own"))
    overall = trusted.agg(quantile.alias("p")).first().p
    limit = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return scored.join(by_language, "lang", "left").select(
        F.col(id_col),
        "lang",
        "trusted",
        "perplexity",
        limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"),
    )


def judge_tables(spark, folder: str) -> DataFrame:
    return judge(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
