"""Removal of every byte covered by a string of ``LENGTH`` bytes that starts twice.

Texts are UTF-8 bytes; a string counts wherever else it starts, in the same document too,
and never across documents. Null text is empty; texts below ``LENGTH`` bytes keep all;
equal texts, so also repeated rows, share one result; ids play no part and may be null;
an empty table gives an empty result.

How equal strings meet without a shuffle of all of them:

1. A window of ``LENGTH`` bytes has a key, the least hash of its ``GRAMS[0]``-byte grams, so
   equal windows have equal keys. Neighbouring windows mostly share theirs: a run of them
   is one segment, of which only key, hash and place are shuffled.
2. A key with one segment is unique. A key with several equal ones is repeated as a whole.
3. Only the distinct segments of other keys are cut from the texts. They are dealt by key
   to blocks of bounded size. A block's Burrows-Wheeler transform is extended backwards,
   breadth first, which yields the common prefixes of neighbouring suffixes by increasing
   value; the intervals that stay undivided at ``LENGTH`` are the repeated strings.
4. A key of more than ``MOST`` distinct segments is split by the same steps with longer grams;
   at grams of ``LENGTH`` bytes a segment is one window and nothing is left to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import (
    ROW,
    carried,
    hash128,
    map_arrow,
    map_groups,
    restored,
    small_batches,
    text_or_empty,
)
from lotwise.sources.scratch import stored

LENGTH = 200
GRAMS = (64, 136, 176, 200)
MOST = 4096  # about a megabyte
LONGEST_RUN = 1024
BLOCK_BYTES = 256 << 10
SEPARATOR = b"\xff"  # no byte of UTF-8
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACE = "h1 long, h2 long, lo long, n long"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size``-byte gram: polynomials joined by doubling their width."""
    block, width, power = data.astype(np.uint64) + np.uint64(1), 1, BASE
    found, done = None, 0
    while True:
        if size & width:
            if found is None:
                found = block
            else:
                n = len(block) - done
                found = found[:n] * power + block[done:]
            done += width
        if done == size:
            return _mixed(found[: len(data) - size + 1])
        block = block[:-width] * power + block[width:]
        with np.errstate(over="ignore"):
            power = power * power
        width *= 2


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    out, w = values, 1
    while 2 * w <= width:
        out = np.minimum(out[:-w], out[w:])
        w *= 2
    rest = width - w
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def runs(data: bytes, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows and window counts of the runs of equal keys, and how often the
    gram of the key lies in the run's bytes: only where twice can two of its windows be equal."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    hashes, width = gram_hashes(np.frombuffer(data, np.uint8), gram), LENGTH - gram + 1
    keys = window_minima(hashes, width)
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    counts = np.diff(np.append(starts, len(keys)))
    if counts.max() > LONGEST_RUN:
        starts = np.concatenate(
            [np.arange(s, s + c, LONGEST_RUN) for s, c in zip(starts, counts, strict=True)]
        )
        counts = np.diff(np.append(starts, len(keys)))
    own = keys[starts]
    distinct = np.unique(own)
    slot = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
    at = np.flatnonzero(distinct[slot] == hashes)
    n = len(data) + 1
    found = np.sort(slot[at] * n + at)
    base = np.searchsorted(distinct, own) * n + starts
    times = np.searchsorted(found, base + counts + width - 1) - np.searchsorted(found, base)
    return own, starts.astype(np.int64), counts.astype(np.int64), np.minimum(times, 2)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first ``depth`` bytes at least."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if width >= depth or int(rank[order[-1]]) == n - 1:
            return order
        ahead = np.zeros(n, np.uint64)
        ahead[: n - width] = rank[width:] + np.uint64(1)
        key = rank * np.uint64(n + 1) + ahead
        width *= 2


def undivided(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and for each rank whether it shares ``length`` bytes with the one before.

    Common prefixes below the seed width are read off the first bytes of neighbours. From
    there, intervals of suffixes with a common prefix of ``value`` bytes are extended by the
    byte before (the transform); the right end of each new interval that has no value yet gets
    ``value``, and only such intervals are extended further.
    """
    n = len(data)
    order = suffix_array(data, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    seed = 8
    value = np.full(n + 1, -1, np.int64)  # common prefix with the rank before; -1: not yet known
    value[0] = value[n] = 0
    padded = np.concatenate([data, np.zeros(seed, np.uint8)])
    same = np.ones(n - 1, bool)
    for i in range(seed):
        inside = (order[1:] + i < n) & (order[:-1] + i < n)
        differ = same & ~(inside & (padded[order[1:] + i] == padded[order[:-1] + i]))
        value[1:n][differ] = i
        same &= ~differ
    ends = np.flatnonzero(value >= 0)
    right = ends[value[ends] == seed - 1]
    left = ends[np.searchsorted(ends, right) - 1]
    for known in range(seed, length):
        if not len(left):
            break
        sizes = right - left
        owner = np.repeat(np.arange(len(left)), sizes)
        ranks = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - left, sizes)
        before = order[ranks] - 1
        owner, before = owner[before >= 0], before[before >= 0]
        image = place[before]
        by_image = np.argsort(image, kind="stable")
        image, owner, byte = image[by_image], owner[by_image], data[before[by_image]]
        first = np.flatnonzero(
            np.concatenate([[True], (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])])
        ) if len(image) else np.zeros(0, np.int64)
        left = image[first]
        right = left + np.diff(np.append(first, len(image)))
        new = value[right] < 0
        left, right = left[new], right[new]
        value[right] = known
    return order, value[:n] < 0


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """For each segment, which of its windows occur anywhere else in the segments."""
    data = np.frombuffer(SEPARATOR.join(segments), np.uint8)
    order, joined = undivided(data)
    repeated = np.zeros(len(data), bool)
    repeated[order] = joined | np.append(joined[1:], False)
    marks, at = [], 0
    for segment in segments:
        marks.append(repeated[at : at + len(segment) - LENGTH + 1])
        at += len(segment) + 1
    return marks


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


def _segments(texts: DataFrame, gram: int, data: bool) -> DataFrame:
    """``(m, sh, h1, h2, lo, n, k[, seg])`` for the runs of ``texts`` (h1, h2, lo, text or seg)."""
    names = ["m", "sh", "h1", "h2", "lo", "n", "k"] + (["seg"] if data else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            columns: list[list] = [[] for _ in names]
            for h1, h2, low, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text if isinstance(text, bytes) else text.encode()
                keys, starts, counts, times = runs(text, gram)
                if not len(keys):
                    continue
                parts = [
                    text[s : s + c + LENGTH - 1]
                    for s, c in zip(starts.tolist(), counts.tolist(), strict=True)
                ]
                hashes = np.array([xxhash.xxh64_intdigest(p) for p in parts], np.uint64)
                made = [
                    keys.view(np.int64), hashes.view(np.int64), np.full(len(keys), h1),
                    np.full(len(keys), h2), starts + low, counts, times,
                ]
                for column, values in zip(columns, made, strict=False):
                    column.append(values)
                if data:
                    columns[-1] += parts
            if columns[0]:
                arrays = [pa.array(np.concatenate(c)) for c in columns[:7]]
                if data:
                    arrays.append(pa.array(columns[-1], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"m long, sh long, {PLACE}, k long" + (", seg binary" if data else "")
    return map_arrow(texts, run, schema)


def _cut(segments: DataFrame, texts: DataFrame) -> DataFrame:
    """``segments`` with their bytes, from one text of each hash."""
    wanted = segments.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("m", "sh", "lo", "n", "d")).alias("parts")
    )
    one = texts.groupBy("h1", "h2").agg(F.min(F.struct("_id")).alias("one"))
    wanted = wanted.join(one, ["h1", "h2"]).select("h1", "h2", F.col("one._id").alias("_one"), "parts")
    rows = (
        texts.join(wanted, ["h1", "h2"])
        .filter(F.col("_id").eqNullSafe(F.col("_one")))
        .select("h1", "h2", "text", "parts")
    )
    names = ["m", "sh", "lo", "n", "d", "h1", "h2", "seg"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            out = []
            for h1, h2, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                for p in parts:
                    seg = data[p["lo"] : p["lo"] + p["n"] + LENGTH - 1]
                    out.append((p["m"], p["sh"], p["lo"], p["n"], p["d"], h1, h2, seg))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out, strict=True)], names=names
                )

    return map_arrow(
        rows, run, "m long, sh long, lo long, n long, d long, h1 long, h2 long, seg binary"
    )


def _block_spans(segments: DataFrame) -> DataFrame:
    """Spans of repeated windows among segments, blocks of which are dealt by key."""
    segments = stored(segments)
    size = segments.agg(F.sum(F.length("seg"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES

    def compare(block: pa.Table) -> pa.Table:
        # The first row of each key and segment hash: numpy's sort is stable.
        keys = np.stack([block["m"].to_numpy(), block["sh"].to_numpy()], axis=1)
        block = block.take(np.sort(np.unique(keys, axis=0, return_index=True)[1]))
        h1, h2, low = (block[name].to_numpy() for name in ("h1", "h2", "lo"))
        spans = [_spans(marks) for marks in repeated_windows(block["seg"].to_pylist())]
        row = np.repeat(np.arange(len(spans)), [len(starts) for starts, _ in spans])
        starts, counts = (np.concatenate(part) for part in zip(*spans, strict=True))
        return pa.table({"h1": h1[row], "h2": h2[row], "lo": low[row] + starts, "n": counts})

    dealt = segments.withColumn("block", F.pmod(F.xxhash64("m"), F.lit(blocks)))
    return map_groups(dealt, "block", compare, PLACE)


def _resolve(light: DataFrame, texts: DataFrame | None, spans: list[DataFrame]) -> DataFrame:
    """Adds spans of the segments ``light`` that are decided; returns those of large keys.

    ``texts`` gives the bytes where ``light`` does not carry them.
    """
    place = ["h1", "h2", "lo", "n"]
    keys = (
        light.groupBy("m")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("k").alias("times"),
            F.min("sh").alias("a"),
            F.max("sh").alias("b"),
        )
        .filter("times > 1")
        .select("m", ((F.col("rows") > 1) & (F.col("a") == F.col("b"))).alias("equal"))
    )
    repeated = stored(light.join(keys, "m"))
    spans.append(repeated.filter("equal").select(*place))
    mixed = repeated.filter("not equal")
    # One place for each distinct segment; the same segment elsewhere makes it all repeated.
    rest = ["seg"] if texts is None else []
    first = F.min(F.struct("h1", "h2", "lo", "n")).alias("p")
    data = [F.first(c).alias(c) for c in rest]
    distinct = stored(
        mixed.groupBy("m", "sh").agg(F.count(F.lit(1)).alias("c"), first, *data).select("m", "sh", "c", "p.*", *rest)
    )
    several = distinct.filter("c > 1").select("m", "sh")
    spans.append(mixed.join(several, ["m", "sh"], "left_semi").select(*place))
    counted = distinct.join(
        distinct.groupBy("m").agg(F.count(F.lit(1)).alias("d")), "m"
    ).select("m", "sh", *place, "d", *rest)
    segments = stored(counted if texts is None else _cut(counted, texts))
    spans.append(stored(_block_spans(segments.filter(F.col("d") <= MOST))))
    return segments.filter(F.col("d") > MOST).select("h1", "h2", "lo", "seg")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``(h1, h2, spans)``: covered byte ranges by hash of the text, overlaps not merged.

    ``texts``: (_id, text, h1, h2).
    """
    spans: list[DataFrame] = []
    whole = texts.select("h1", "h2", F.lit(0).cast("long").alias("lo"), "text")
    light = stored(_segments(whole.filter(F.octet_length("text") >= LENGTH), GRAMS[0], False))
    large = _resolve(light, texts, spans)
    for gram in GRAMS[1:]:
        if large.isEmpty():
            break
        large = _resolve(stored(_segments(large, gram, True)), None, spans)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    ranges = F.struct("lo", (F.col("lo") + F.col("n") + (LENGTH - 1)).alias("hi"))
    return every.groupBy("h1", "h2").agg(F.collect_set(ranges).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", as_text: bool = False) -> DataFrame:
    """``docs`` with ``kept``, ``n_bytes``, ``n_removed``, ``n_spans``.

    ``kept`` is binary, or with ``as_text`` a string: bytes of a split character go too.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans"]
    names = [c for c in docs.columns if c not in added]
    h1, h2 = hash128(text_or_empty())
    hashed = docs.select(*names, h1.alias("_h1"), h2.alias("_h2"))
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty().alias("text"), h1, h2)
    spans = stored(repeated_spans(texts)).select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("spans").alias("_spans")
    )
    rows = hashed.join(spans, ["_h1", "_h2"], "left").select(*names, "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(names.index("text")).to_pylist()
            out = []
            for text, spans in zip(texts, batch.column(len(names)).to_pylist(), strict=True):
                data = (text or "").encode()
                if not spans:
                    out.append((data, len(data), 0, 0))
                    continue
                edges = np.zeros(len(data) + 1, np.int32)
                np.add.at(edges, [s["lo"] for s in spans], 1)
                np.add.at(edges, [s["hi"] for s in spans], -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((kept, len(data), int(gone.sum()), len(_spans(gone)[0])))
            if as_text:
                out = [(kept.decode("utf-8", "ignore"), *rest) for kept, *rest in out]
            types = [pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *made], names=[*names, *added]
            )

    schema = hashed.select(*names).schema
    for name, kind in zip(added, ("string" if as_text else "binary", *["long"] * 3), strict=True):
        schema = schema.add(name, kind)
    return map_arrow(rows, run, schema)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, null where it was null, and its ``n_chars``.

    Other columns, whatever their names, come back as they are.
    """
    left = remove_repeats(carried(docs), as_text=True)
    untouched = F.col("n_removed") == 0
    changed = {"text": F.when(untouched, F.col("text")).otherwise(F.col("kept"))}
    if "n_chars" in docs.columns:
        n = F.when(untouched, F.col(ROW).getField("n_chars")).otherwise(F.length("kept"))
        changed["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    return restored(left, docs.columns, changed)
