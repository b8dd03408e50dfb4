"""Exact Jaccard join of documents on word shingles, by token-combination prefixes.

Words are runs of characters other than ASCII white space, A-Z in lower case; a set holds
the distinct shingles of ``WORDS`` words, or the whole sequence where there are fewer
words. Two documents link when ``100 * shared >= percent * union``. Shingles are 64-bit
hashes. Null and blank texts have no shingles and no links. Of rows that
repeat an id with different words, one takes part in links. A row without an id takes the
component of an equal set, if there is one, and has no other links. An empty table gives an
empty result.

How the links are found:

1. Documents with equal sets collapse to one representative.
2. A cheap round links representatives to a leader that shares one of their least hashed
   shingles; its components are the classes of the exact round, so a family of near
   copies, however large, counts as one class there.
3. Exact round. Shingles are ordered, rare ones first, then by hash. Two sets that share
   ``a`` shingles share ``k`` of their first ``size - a + k``. So a set is indexed under
   every rare shingle of that prefix, singly, and under pairs of its frequent ones. Which
   shingles are frequent changes costs only, never results. Pairs are formed within
   ``k - 1`` hash classes of shingles, as k shared ones must meet in one of them, which
   keeps their number in proportion to the document.
4. A key of few documents gives pairs, verified on whole sets. A key of many gives none:
   documents that such keys connect form a family, whose members are compared in blocks of
   bounded size by matrix products, and a block returns only links that join classes.
   Pairs within one class are never looked at. Links of both kinds join the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import components, map_arrow, map_groups, small_batches
from lotwise.sources.scratch import stored

WORDS = 5
PERCENT = 80
FREQUENT = 16
BLOCK = 256
LEADER_KEYS = 6
MIX = np.uint64(0x9E3779B97F4A7C15)
# Words are hashed this many bytes at a time.
CHUNK = 256 << 10
BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A number for every byte, a letter's the same in both cases; zero for blanks."""
    values = _mixed(np.arange(1, 257, dtype=np.uint64) * MIX)
    values[0x41:0x5B] = values[0x61:0x7B]
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


_VALUES = _byte_values()
_BLANK = _VALUES == 0


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""
    factors = np.full((2, n + 1), 1, np.uint64)
    factors[0, 1:], factors[1, 1:] = BASE, pow(BASE, -1, 1 << 64)
    up, down = np.cumprod(factors, axis=1)
    return up, down


def _word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` in order, and how many start before each of ``cuts``.

    A word ends at blanks and at ``cuts``. Its hash is a polynomial of its bytes, taken as a
    difference of running sums that is shifted back to the word's start.
    """
    word = ~_BLANK[data]
    opens = np.ones(len(data) + 1, bool)
    opens[1:] = ~np.append(word[:-1], False) if len(data) else True
    opens[cuts] = True
    starts = np.flatnonzero(word & opens[:-1])
    ends = np.flatnonzero(word & (np.append(~word[1:], True) | opens[1:])) + 1
    up, down = _powers(CHUNK) if len(data) <= CHUNK else _powers.__wrapped__(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX)
    return hashes, np.searchsorted(starts, cuts)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts ``data`` into pieces of about ``CHUNK`` bytes, at ends of texts or at blanks."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(end, at + CHUNK)
        if to < end:
            whole = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if whole > at:
                to = whole
            else:
                inside = np.flatnonzero(_BLANK[data[at:to]])
                if len(inside):
                    to = at + int(inside[-1]) + 1
                else:  # a word that is longer than a piece
                    text_end = int(offsets[np.searchsorted(offsets, at, "right")])
                    after = np.flatnonzero(_BLANK[data[to:text_end]])
                    to = to + int(after[0]) if len(after) else text_end
        yield at, to
        at = to


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text; none for null and blank ones."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts) + 1, np.int64)
    done = 0
    for at, to in _pieces(data, offsets):
        cuts = np.unique(np.clip(offsets, at, to)) - at
        found, before = _word_hashes(data[at:to], cuts)
        # Words that start before each text's offset, in this piece and the earlier ones.
        place = np.searchsorted(cuts, np.clip(offsets, at, to) - at)
        counts = np.where(offsets > at, done + before[place], counts)
        done += len(found)
        hashes.append(found)
    words = np.concatenate(hashes)
    n = max(0, len(words) - WORDS + 1)
    rolled = np.full(n, np.uint64(WORDS), np.uint64)
    for k in range(WORDS):
        rolled = rolled * MIX + words[k : k + n]
    rolled = _mixed(rolled)
    return [_distinct(words, rolled, a, b) for a, b in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True)]


def _distinct(words: np.ndarray, rolled: np.ndarray, first: int, last: int) -> np.ndarray:
    """Distinct shingles of the text that has the words from ``first`` to before ``last``."""
    n = last - first
    if n >= WORDS:
        found = np.sort(rolled[first : last - WORDS + 1])
        return found[np.append(True, found[1:] != found[:-1])]
    if not n:
        return np.zeros(0, np.uint64)
    whole = np.full(1, np.uint64(n), np.uint64)
    for word in words[first:last]:
        whole = whole * MIX + word
    return _mixed(whole)


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """Shingles that a set of this size shares with any linked one, at least."""
    return -(-percent * size // 100)


def hash_classes(level: int) -> int:
    """Hash classes that frequent shingles of sets of 2**level or more are dealt to."""
    return max(1, (1 << level) // 16)


def levels(size: int, percent: int) -> list[int]:
    """Size levels of the larger set in a link that a set of this size may have."""
    return list(range(size.bit_length() - 1, (100 * size // percent).bit_length()))


def prefix_keys(ordered: np.ndarray, frequent: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Index keys of a set. ``ordered``: hashes, rare ones first; ``frequent``: which are not.

    A rare shingle is its own key. The key of a pair also holds the level it is formed at.
    """
    spare = size - least_overlap(size, percent)
    keys = []
    longest = 0
    for level in levels(size, percent):
        groups = hash_classes(level)
        length = min(size, spare + groups + 1)
        longest = max(longest, length)
        common = ordered[:length][frequent[:length]]
        if len(common) < 2:
            continue
        group = (_mixed(common + np.uint64(level)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        common, group = common[order], group[order]
        for step in range(1, int(np.bincount(group).max())):
            same = group[step:] == group[:-step]
            low = np.minimum(common[step:], common[:-step])[same]
            high = np.maximum(common[step:], common[:-step])[same]
            keys.append(_mixed(_mixed(low * MIX + np.uint64(level)) + high))
    rare = ordered[:longest][~frequent[:longest]]
    return np.unique(np.concatenate([rare, *keys]))


def prefix_length(size: int, percent: int) -> int:
    """Length of the longest prefix that ``prefix_keys`` looks at."""
    most = max(hash_classes(level) for level in levels(size, percent))
    return min(size, size - least_overlap(size, percent) + most + 1)


def _as_longs(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _emit(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, s1, s2, k0..)``: size, 128-bit hash of the set, leader keys."""
    names = ["doc_id", "n_shingles", "s1", "s2", *(f"k{i}" for i in range(LEADER_KEYS))]
    seeds = [np.uint64(((i + 1) * 0xD6E8FEB86659FD93 | 1) % 2**64) for i in range(LEADER_KEYS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            rows = []
            for found in shingle_sets(batch.column(1)):
                least = [int((found * seed).min()) if len(found) else 0 for seed in seeds]
                rows.append((len(found), *_signature(found), *least))
            columns = [np.array(c, np.uint64).view(np.int64) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], names=names
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text))
    return map_arrow(rows, run, ", ".join(f"{n} long" for n in names))


def _signature(found: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh128_intdigest(found.tobytes())
    return whole >> 64, whole & (1 << 64) - 1


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` representatives with their whole texts, stored."""
    return stored(docs.join(wanted, "rep").select(*wanted.columns, "text"))


def _verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the threshold."""
    pairs = stored(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = _texts(docs, reps.select("rep", "s1").join(wanted, "rep", "left_semi"))
    side = lambda n: sets.select(
        F.col("rep").alias(n), F.col("s1").alias(f"s{n}"), F.col("text").alias(f"t{n}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "sa", "ta", "b", "sb", "tb")

    def own(texts: pa.Array, signatures: pa.Array) -> list[np.ndarray | None]:
        """Each row's set, unless the text is of another row with its id; equal texts share one."""
        coded = texts.dictionary_encode()
        sets = shingle_sets(coded.dictionary)
        signed = [_signature(found)[0] for found in sets]
        rows = zip(coded.indices.to_pylist(), signatures.to_pylist(), strict=True)
        return [sets[i] if i is not None and signed[i] == s % 2**64 else None for i, s in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            a, sa, ta, b, sb, tb = batch.columns
            out = []
            for m, x, n, y in zip(a.to_pylist(), own(ta, sa), b.to_pylist(), own(tb, sb), strict=True):
                if x is None or y is None:
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    out.append((m, n))
            if out:
                yield _emit(["a", "b"], list(map(np.array, zip(*out, strict=True))))

    return map_arrow(joined, run, "a long, b long")


def _leader_pairs(reps: DataFrame) -> DataFrame:
    """Every representative with a leader among those that share a key: linear in rows.

    The leader is the one whose keys are the most common, such as the original of many
    edited copies, then the smallest.
    """
    keys = F.array(
        *(F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(LEADER_KEYS))
    )
    keyed = reps.select("rep", F.explode(keys).alias("key")).select("rep", "key.i", "key.k")
    sizes = keyed.groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keyed.join(sizes, ["i", "k"]))
    typical = shared.groupBy("rep").agg(F.sum("n").alias("score"))
    scored = shared.join(typical, "rep")
    leaders = scored.groupBy("i", "k").agg(
        F.min(F.struct((-F.col("score")).alias("score"), "rep")).alias("best")
    )
    pairs = scored.join(leaders, ["i", "k"]).select("rep", F.col("best.rep").alias("leader"))
    return (
        pairs.filter("rep != leader")
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
        .distinct()
    )


def _prefixes(docs: DataFrame, percent: int) -> DataFrame:
    """``(rep, s1, size, room, tokens)``: the hash-ordered prefix of each document.

    ``room``: frequent shingles that it may hold and still have a rare prefix for k = 1.
    """
    names = ["rep", "s1", "size", "room", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            sets = shingle_sets(batch.column(1))
            parts = [s[: prefix_length(len(s), percent)] if len(s) else s for s in sets]
            offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array([_signature(s)[0] for s in sets], np.uint64).view(np.int64)),
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.array(
                        np.array(
                            [len(p) - 1 - len(s) + least_overlap(len(s), percent) for s, p in zip(sets, parts, strict=True)],
                            np.int64,
                        )
                    ),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(_as_longs(np.concatenate(parts)))),
                ],
                names=names,
            )

    return map_arrow(
        docs.select("rep", "text"), run, "rep long, s1 long, size long, room long, tokens array<long>"
    )


def _whole(texts: DataFrame) -> DataFrame:
    """``(rep, class, size, token)`` for all shingles of ``texts`` (rep, s1, class, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            sets = shingle_sets(batch.column(3))
            for rep, s1, cls, found in zip(*(c.to_pylist() for c in batch.columns[:3]), sets, strict=True):
                if _signature(found)[0] == s1 % 2**64:
                    n = len(found)
                    yield _emit(
                        ["rep", "class", "size", "token"],
                        [np.full(n, rep), np.full(n, cls), np.full(n, n), _as_longs(found)],
                    )

    return map_arrow(
        texts.select("rep", "s1", "class", "text"), run, "rep long, class long, size long, token long"
    )


def _ordered_keys(texts: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """``(rep, class, size, token)``: keys of crowded sets, without shingles of their plain prefix."""
    joined = texts.join(marks, "rep").select("rep", "s1", "class", "text", "common")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            sets = shingle_sets(batch.column(3))
            rows = zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)), sets, strict=True)
            for rep, s1, cls, common, found in rows:
                if _signature(found)[0] != s1 % 2**64:
                    continue
                is_common = np.isin(found, np.array(common, np.int64).view(np.uint64))
                order = np.argsort(is_common, kind="stable")
                keys = prefix_keys(found[order], is_common[order], len(found), percent)
                plain = found[: prefix_length(len(found), percent)]
                keys = keys[~np.isin(keys, plain)]
                n = len(keys)
                yield _emit(
                    ["rep", "class", "size", "token"],
                    [np.full(n, rep), np.full(n, cls), np.full(n, len(found)), _as_longs(keys)],
                )

    return map_arrow(joined, run, "rep long, class long, size long, token long")


def _open(index: DataFrame) -> DataFrame:
    """``(token, n)``: keys whose documents are of more than one class."""
    return (
        index.groupBy("token")
        .agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("n"))
        .filter("lo < hi")
        .select("token", "n")
    )


def _key_pairs(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs of different classes under keys of few documents, if their sizes allow a link."""
    few = posted.filter(F.col("n") <= 2 * FREQUENT).drop("n")
    other = few.select(
        "token", F.col("rep").alias("b"), F.col("size").alias("size_b"), F.col("class").alias("class_b")
    )
    fits = (F.col("rep") < F.col("b")) & (F.col("class") != F.col("class_b"))
    sizes = (percent * F.greatest("size", "size_b")) <= 100 * F.least("size", "size_b")
    return few.join(other, "token").filter(fits & sizes).select(F.col("rep").alias("a"), "b").distinct()


def _block_links(posted: DataFrame, docs: DataFrame, reps: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between classes within the families that keys of many documents connect."""
    many = posted.filter(F.col("n") > 2 * FREQUENT).select("token", "rep")
    least = many.groupBy("token").agg(F.min("rep").alias("a"))
    star = many.join(least, "token").select("a", F.col("rep").alias("b")).distinct()
    families = stored(
        components(star, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("family"))
    )
    placed = families.join(classes.select("rep", "class"), "rep")
    # A class that fills blocks of its own is not compared with itself.
    of_class = placed.groupBy("family", "class").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") >= BLOCK, F.col("class"))
    groups = of_class.withColumn("own", own).groupBy("family", "own").agg(F.sum("n").alias("n"))
    groups = groups.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    big = of_class.filter(F.col("n") >= BLOCK).select("family", "class", F.col("class").alias("own"))
    located = placed.join(big, ["family", "class"], "left")
    mine = located["own"].eqNullSafe(groups["own"]) & (located["family"] == groups["family"])
    located = stored(
        located.join(groups, mine).select(
            "rep",
            "class",
            located["family"],
            F.xxhash64(located["own"], F.pmod(F.xxhash64("rep"), F.col("blocks"))).alias("block"),
            located["own"],
        )
    )
    blocks = located.select("family", "block", "own").distinct()
    other = blocks.select("family", F.col("block").alias("block_b"), F.col("own").alias("own_b"))
    tasks = blocks.join(other, "family").filter(
        (F.col("block") <= F.col("block_b")) & ~F.coalesce(F.col("own") == F.col("own_b"), F.lit(False))
    )
    tasks = tasks.select("family", F.xxhash64("family", "block", "block_b").alias("task"), F.array_distinct(F.array("block", "block_b")).alias("both"))
    dealt = tasks.select("family", "task", F.explode("both").alias("block"))
    texts = _texts(docs, reps.select("rep", "s1").join(located.select("rep", "class"), "rep"))
    rows = (
        texts.join(located.select("rep", "family", "block"), "rep")
        .join(dealt, ["family", "block"])
        .select("task", "rep", "s1", "class", "text")
    )

    def compare(block: pa.Table) -> pa.Table:
        sets, kept = [], []
        found_sets = shingle_sets(block["text"].cast(pa.large_string()).combine_chunks())
        for i, (s1, found) in enumerate(zip(block["s1"].to_pylist(), found_sets, strict=True)):
            if _signature(found)[0] == s1 % 2**64:
                sets.append(found)
                kept.append(i)
        rep, cls = block["rep"].to_numpy()[kept], block["class"].to_numpy()[kept]
        pairs = np.array(list(_joining(sets, cls, percent)), np.int64).reshape(-1, 2)
        return pa.table({"a": rep[pairs[:, 0]], "b": rep[pairs[:, 1]]})

    return map_groups(rows, "task", compare, "a long, b long")


def _joining(sets: list[np.ndarray], classes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Linked positions that join classes not yet joined by earlier ones."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    tokens, column, count = np.unique(np.concatenate(sets) if n else [], return_inverse=True, return_counts=True)
    useful = count[column] > 1
    owner, column = owner[useful], column[useful]
    shared = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, len(tokens), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        if a < b:
            part = np.zeros((n, 4096), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            shared += part @ part.T
    both = np.rint(shared).astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    linked &= classes[:, None] != classes[None, :]
    root = {c: c for c in classes.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(int(classes[i])), find(int(classes[j]))
        if x != y:
            root[x] = y
            yield int(i), int(j)


def link_documents(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    signed = stored(signatures(docs, id_col, text))
    rows = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text).alias("text"))
    one_set = (
        signed.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*signed.columns[1:])).alias("s"))
        .select("doc_id", "s.*")
    )
    reps = stored(
        one_set.groupBy("n_shingles", "s1", "s2").agg(
            F.min("doc_id").alias("rep"),
            *(F.min(f"k{i}").alias(f"k{i}") for i in range(LEADER_KEYS)),
        )
    )
    quick = stored(_verify(_leader_pairs(reps), rows, reps, percent))
    classes = _with_class(reps.select("rep", "s1"), components(quick, "a", "b"))
    prefixes = stored(
        _prefixes(rows, percent)
        .join(classes, ["rep", "s1"])
        .select("rep", "class", "size", "room", F.explode("tokens").alias("token"))
    )
    many = F.col("n") > FREQUENT
    often = stored(_open(prefixes).filter(many).select("token"))
    touched = _crowded(prefixes, often)
    texts = _texts(rows, classes.join(touched, "rep", "left_semi"))
    often = stored(often.unionByName(_open(_whole(texts)).filter(many).select("token")).distinct())
    touched = stored(_crowded(prefixes, often))
    texts = _texts(rows, classes.join(touched, "rep", "left_semi"))
    marks = (
        _whole(texts)
        .join(often, "token", "left_semi")
        .groupBy("rep")
        .agg(F.collect_list("token").alias("common"))
    )
    # Keys that touched documents have beyond their plain prefix; frequent ones fall out with
    # the keys, so that the large index is shuffled twice only.
    index = prefixes.drop("room").unionByName(_ordered_keys(texts, marks, percent))
    keys = stored(_open(index).join(often, "token", "left_anti"))
    posted = stored(index.join(keys, "token"))
    pairs = _verify(_key_pairs(posted, percent), rows, reps, percent)
    links = stored(
        quick.unionByName(pairs).unionByName(_block_links(posted, rows, reps, classes, percent))
    )
    linked = _with_class(reps.select("rep", "s1"), components(links, "a", "b"))
    by_set = reps.join(linked.select("rep", "class"), "rep").select(
        "n_shingles", "s1", "s2", F.col("class").alias("component_id")
    )
    return signed.join(by_set, ["n_shingles", "s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _crowded(prefixes: DataFrame, often: DataFrame) -> DataFrame:
    """Documents whose prefix has too many frequent shingles to be indexed by rare ones alone."""
    return (
        prefixes.join(often, "token", "left_semi")
        .groupBy("rep")
        .agg(F.count(F.lit(1)).alias("n"), F.first("room").alias("room"))
        .filter("n > room")
        .select("rep")
    )


def _with_class(reps: DataFrame, found: DataFrame) -> DataFrame:
    """``(rep, s1, class)``; a representative without links is its own class."""
    return stored(
        reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "rep", "s1", F.coalesce("component", "rep").alias("class")
        )
    )


def keep_first(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without those that link to a document of smaller id, directly or not."""
    found = link_documents(docs, percent, id_col)
    gone = (
        found.filter(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias(id_col))
        .distinct()
    )
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
