"""Byte-level BPE: texts to token ids and back.

Each match of the pre-token pattern is a word; ranked merges fold its bytes, the lowest
rank first and the leftmost of equals. A task folds each distinct word once, the new words of
a batch many at a time, and remembers words and the chunks they make in memos of bounded size;
ids of a text are the concatenated ids of its words.
Decoding concatenates the byte pieces of the ids. Null text is empty and gives no ids;
repeated rows are encoded alike; other columns are carried along; an id outside the
vocabulary makes decoding fail.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from lotwise.llm.common import map_arrow, small_batches, texts_of

CHUNK_ENTRIES, WORD_ENTRIES = 300_000, 200_000
MEMO_CHARS = 64
FOLD_BYTES = 32  # longer words are folded one by one
FOLD_CELLS = 1 << 18  # bytes of the words folded at once
UNSAFE_SPACE = regex.compile(r"\s ")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def fold_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word. A heap of mergeable neighbours keeps long words near linear."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # a part is word[start:end[start]]; end 0 marks a merged start
    left = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n and (rank := ranks.get(word[start : end[middle]])) is not None:
            heapq.heappush(heap, (rank, start, end[middle]))

    for start in range(n - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            left[stop] = start
        offer(start)
        if left[start] >= 0:
            offer(left[start])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def chunks_of(text: str) -> list[str]:
    """Pieces of the text that no match of a `` ?word`` pattern can straddle.

    A new match starts at every space between non-blanks. Texts with a blank before a
    space stay whole.
    """
    if UNSAFE_SPACE.search(text):
        return [text]
    first, *others = text.split(" ")
    return ([first] if first else []) + [" " + other for other in others]


class Folder:
    """Folds words of equal length together, a merge of each word a step."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        symbols = {bytes([b]): b - 256 for b in range(256)} | ranks
        merges = [
            (symbols[token[:i]] + 256 << 32 | symbols[token[i:]] + 256, rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in symbols and token[i:] in symbols
        ]
        table = np.array(sorted(merges), np.int64).reshape(-1, 2)
        # A last key above all others, so that a search always ends at one.
        self.keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.merged = np.append(table[:, 1], -1)
        self.none = max(ranks.values(), default=0) + 1  # above the rank of any merge
        self.byte = np.array([symbols[bytes([b])] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left + 256 << 32) | (right + 256)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys.take(at) == key, self.merged.take(at), self.none)

    def fold(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids by word."""
        found: dict[str, bytes] = {}
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            if data in self.ranks:
                found[word] = pack_ids([self.ranks[data]])
            elif len(data) > FOLD_BYTES:
                found[word] = pack_ids(fold_merges(data, self.ranks))
            else:
                by_length.setdefault(len(data), []).append((word, data))
        for length, pairs in by_length.items():
            step = FOLD_CELLS // length
            for at in range(0, len(pairs), step):
                some = pairs[at : at + step]
                found.update(zip((w for w, _ in some), self._fold_equal([d for _, d in some], length)))
        return found

    def _fold_equal(self, words: list[bytes], length: int) -> list[bytes]:
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8).reshape(-1, length)]
        # A column more than there are pairs: the last part has no right neighbour.
        rank = np.full(ids.shape, self.none)
        rank[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        rows, done, sizes = np.arange(len(ids)), np.zeros(ids.shape, np.int64), np.zeros(len(ids), np.int64)
        width = length
        while len(rows):
            best = rank.argmin(axis=1)  # the leftmost of equals
            lines = np.arange(len(rows))
            lowest = rank[lines, best]
            ended = lowest == self.none
            if ended.any():
                done[rows[ended], :width] = ids[ended]
                sizes[rows[ended]] = width
                going = ~ended
                rows, ids, rank, best, lowest = (a[going] for a in (rows, ids, rank, best, lowest))
                lines = np.arange(len(rows))
            if not len(rows):
                break
            # Every word loses one part: those after the merged one move up.
            width -= 1
            columns = np.arange(width)
            source = columns + (columns > best[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            rank = np.take_along_axis(rank, source, axis=1)
            ids[lines, best] = lowest
            last = best == width - 1
            right = ids[lines, np.minimum(best + 1, width - 1)]
            rank[lines, best] = np.where(last, self.none, self.rank(lowest, right))
            inner = np.flatnonzero(best > 0)
            before = best[inner] - 1
            rank[inner, before] = self.rank(ids[inner, before], lowest[inner])
        if (done < 0).any():
            raise KeyError("A byte of a word is not in the vocabulary")
        packed = done.astype(np.uint32).tobytes()
        starts = range(0, 4 * length * len(words), 4 * length)
        return [packed[a : a + 4 * n] for a, n in zip(starts, sizes.tolist(), strict=True)]


class Encoder:
    """Packed ids of texts by one rank map and pattern, with the memos of a worker.

    A memo that holds too much once a batch is done is emptied; long texts leave it at once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.folder, self.pattern = Folder(ranks), regex.compile(pattern)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        rows = [chunks_of(text) for text in texts]
        findall = self.pattern.findall
        parts = {chunk: findall(chunk) for chunk in set().union(*rows).difference(self.chunks)}
        folded = self.folder.fold(list(set().union(*parts.values()).difference(self.words)))
        self.words.update(folded)
        ids_of = self.words.__getitem__
        fresh = {
            chunk: ids_of(words[0]) if len(words) == 1 else b"".join(map(ids_of, words))
            for chunk, words in parts.items()
        }
        self.chunks.update(fresh)
        encoded = [b"".join(map(self.chunks.__getitem__, row)) for row in rows]
        trim(self.words, folded, WORD_ENTRIES)
        trim(self.chunks, fresh, CHUNK_ENTRIES)
        return encoded


def trim(memo: dict[str, bytes], fresh: dict[str, bytes], entries: int) -> None:
    """Keep a memo bounded after it took ``fresh``."""
    if len(memo) > entries:
        memo.clear()
    else:
        for text in [text for text in fresh if len(text) > MEMO_CHARS]:
            del memo[text]


_encoders: dict[str, Encoder] = {}


def pack_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def encode_texts(texts: list[str], ranks: dict[bytes, int], key: str, pattern: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers. ``key`` names the rank map."""
    encoder = _encoders.get(f"{key} {pattern}")
    if encoder is None:
        _encoders.clear()
        encoder = _encoders[f"{key} {pattern}"] = Encoder(ranks, pattern)
    return encoder.encode(texts)


def with_binary(
    df: DataFrame, source: str, target: str, function: Callable[[pa.Array], list[bytes]]
) -> DataFrame:
    """``df`` with a binary column made from ``source``; replaces a column of that name."""
    names = [c for c in df.columns if c != target]
    schema = StructType([f for f in df.schema if f.name != target]).add(target, BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4 << 20):
            made = pa.array(function(batch.column(batch.schema.get_field_index(source))), pa.binary())
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*names, target])

    return map_arrow(df, run, schema)


def encode(
    docs: DataFrame, ranks: Broadcast, pattern: str, text: str = "text", target: str = "ids"
) -> DataFrame:
    """``docs`` with the ids of ``text`` as packed binary. ``ranks``: a broadcast rank map,
    which is as large as the vocabulary, whatever the data."""
    key = f"{ranks.id if hasattr(ranks, 'id') else id(ranks)}"

    def function(column: pa.Array) -> list[bytes]:
        return encode_texts(texts_of(column), ranks.value, key, pattern)

    return with_binary(docs, text, target, function)


def decode(df: DataFrame, ranks: Broadcast, ids: str = "ids", target: str = "decoded") -> DataFrame:
    """``df`` with the concatenated byte pieces of ``ids``."""

    def function(column: pa.Array) -> list[bytes]:
        pieces = {rank: piece for piece, rank in ranks.value.items()}
        return [
            b"".join(map(pieces.__getitem__, memoryview(packed or b"").cast("I").tolist()))
            for packed in column.to_pylist()
        ]

    return with_binary(df, ids, target, function)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Hashes of the ids and of what they decode to, for every document."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    both = decode(encode(docs.select("doc_id", "text"), ranks, pattern).drop("text"), ranks)
    return both.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
