"""Packing of tokenised examples into training sequences: vector bin packing.

A sequence holds at most ``Limits.tokens`` tokens, ``segments`` pieces and ``loss`` loss-
bearing tokens at once. Every task packs the examples of its partition as they stream
by: from a pool of bounded size, the piece with the largest dot product of its own needs
and the room left is placed next; where none fits whole, one is cut to fill the sequence.
A sequence that no limit lets be full is cut back to a power of two, its excess returns to
the pool. So every sequence is full or a power of two long and none needs padding. No
shuffle, and a task's memory depends on neither its rows nor their lengths in total.

Null text is empty: only the end id. Repeated rows are examples of their own; ids may be
null; other columns are left out; an empty table gives an empty result. Sequence ids are
unique and gapless within a partition.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.byte_bpe import pack_ids, with_binary
from lotwise.llm.common import map_arrow, small_batches, texts_of

END_ID = 1
POOL = 512
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    """``segments`` and ``loss`` bound what one sequence may mix and learn from."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    loss: np.ndarray  # 0 or 1 per token
    doc_tokens: int
    bearing: int = field(init=False)

    def __post_init__(self) -> None:
        self.bearing = int(self.loss.sum())

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:length], self.loss[:length], self.doc_tokens),
            Piece(
                self.doc_id, self.start + length, self.ids[length:], self.loss[length:], self.doc_tokens
            ),
        )

    def longest(self, tokens: int, loss: int) -> int:
        """Tokens from the start that keep to both limits."""
        if self.bearing <= loss or tokens <= loss:
            return min(tokens, len(self.ids))
        return min(tokens, int(np.searchsorted(np.cumsum(self.loss), loss, "right")))


class Packer:
    """Sequences out of a stream of examples, from a pool of bounded size."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.pool: list[Piece] = []
        self.needs = np.zeros((POOL, 3))
        self.scale = np.array([limits.tokens, limits.segments, max(limits.loss, 1)], float)

    def _put(self, piece: Piece) -> None:
        if len(self.pool) == len(self.needs):
            self.needs = np.vstack([self.needs, np.zeros_like(self.needs)])
        self.needs[len(self.pool)] = len(piece.ids), 1, piece.bearing
        self.pool.append(piece)

    def _take(self, at: int) -> Piece:
        piece, last = self.pool[at], self.pool.pop()
        if at < len(self.pool):
            self.pool[at] = last
            self.needs[at] = self.needs[len(self.pool)]
        return piece

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        whole = self.limits.tokens
        while len(piece.ids) >= whole and piece.longest(whole, self.limits.loss) == whole:
            head, piece = piece.cut(whole)
            yield [head]
        if len(piece.ids):
            self._put(piece)
        while len(self.pool) >= POOL:
            yield self._fill()

    def rest(self) -> Iterator[list[Piece]]:
        while self.pool:
            yield self._fill()

    def _fill(self) -> list[Piece]:
        room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        taken: list[Piece] = []
        while self.pool and room[0] and room[1]:
            needs = self.needs[: len(self.pool)]
            fits = (needs[:, 0] <= room[0]) & (needs[:, 2] <= room[2])
            value = np.where(fits, needs @ (room / self.scale**2), -1.0)
            best = int(value.argmax())
            if value[best] < 0:
                # As many tokens as the loss limit leaves always fit; only beyond are they counted.
                lengths = np.minimum(needs[:, 0], room[0]).astype(int)
                for i in np.flatnonzero((lengths > room[2]) & (needs[:, 2] > room[2])):
                    lengths[i] = self.pool[i].longest(int(room[0]), int(room[2]))
                best = int(lengths.argmax())
                if not lengths[best]:
                    break
                head, tail = self._take(best).cut(int(lengths[best]))
                self._put(tail)
            else:
                head = self._take(best)
            taken.append(head)
            room -= (len(head.ids), 1, head.bearing)
        length = int(self.limits.tokens - room[0])
        if not length:
            raise ValueError("Limits must let a sequence hold a token.")
        excess = 0 if length == self.limits.tokens else length - (1 << length.bit_length() - 1)
        while excess:
            piece = taken.pop()
            if len(piece.ids) > excess:
                piece, tail = piece.cut(len(piece.ids) - excess)
                taken.append(piece)
                self._put(tail)
                break
            excess -= len(piece.ids)
            self._put(piece)
        return taken


def pack(examples: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id") -> DataFrame:
    """A row per piece of ``examples``: where it comes from and where it lies.

    ``ids`` holds packed token ids; an optional binary column ``loss_mask`` has a byte per
    token, 1 where it bears loss. Without it, or where it is null, every token does.
    """
    if "loss_mask" not in examples.columns:
        examples = examples.withColumn("loss_mask", F.lit(None).cast("binary"))
    rows = examples.select(F.col(id_col).cast("long").alias("doc_id"), "ids", "loss_mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence = Packer(limits), TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def write(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                n, crc = len(p.ids), zlib.crc32(p.ids.tobytes())
                out.append((p.doc_id, p.start, n, crc, p.doc_tokens, sequence, offset, p.bearing))
                offset += n
            sequence += 1

        def flush() -> pa.RecordBatch:
            names = [c.split()[0] for c in PIECES.split(",")]
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in small_batches(batches):
            for doc_id, packed, mask in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(packed or b"", "<u4")
                loss = np.ones(len(ids), "u1") if mask is None else np.frombuffer(mask, "u1")
                for pieces in packer.add(Piece(doc_id, 0, ids, loss, len(ids))):
                    write(pieces)
            if out:
                yield flush()
        for pieces in packer.rest():
            write(pieces)
        if out:
            yield flush()

    return map_arrow(rows, run, PIECES)


def ranks_of(definition: str) -> dict[bytes, int]:
    """The rank map of a byte-level tokenizer file whose ids follow its merges.

    For such a file the merges by rank give the ids that the ``tokenizers`` library gives,
    several times faster. Other files are refused.
    """
    parts = json.loads(definition)
    model, split = parts["model"], parts["pre_tokenizer"]
    if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"]:
        raise ValueError("Not a plain byte-level tokenizer.")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in parts["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"][a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError("Ids do not follow the merges.")
    return {
        bytes(byte_of[c] for c in token): rank
        for token, rank in model["vocab"].items()
        if token not in special
    }


def special_ids(definition: str) -> dict[str, int]:
    """The ids of the added tokens, which the ``tokenizers`` library cuts out of a text first.

    Files whose added tokens take spaces or word bounds into account, begin alike or are not
    special are refused.
    """
    added = json.loads(definition)["added_tokens"]
    names = [t["content"] for t in added]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or not t["special"] for t in added):
        raise ValueError("Not plain special tokens.")
    if any(a != b and a.startswith(b) for a in names for b in names):
        raise ValueError("A special token begins with another.")
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=2)
def _encoding(definition: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "own",
        pat_str=pattern,
        mergeable_ranks=ranks_of(definition),
        special_tokens=special_ids(definition),
    )


def tokenize(
    docs: DataFrame,
    path: str,
    text: str = "text",
    end_id: int | None = END_ID,
    target: str = "ids",
    encode_special_tokens: bool = True,
) -> DataFrame:
    """``docs`` with packed ids of a byte-level tokenizer file, then ``end_id``.

    ``encode_special_tokens`` is the switch of that name of ``tokenizers``: with it strings of
    special tokens in a text are ordinary text, without it (the default there, and the way of
    op2 and the pipeline) they become their ids. The definition is broadcast; its size does
    not depend on the data.
    """
    allowed = set() if encode_special_tokens else "all"
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    end = pack_ids([end_id]) if end_id is not None else b""

    def function(column: pa.Array) -> list[bytes]:
        encoding = _encoding(definition.value, PATTERN)
        return [
            encoding.encode_to_numpy(t, allowed_special=allowed, disallowed_special=()).tobytes() + end
            for t in texts_of(column)
        ]

    return with_binary(docs, text, target, function)


def conversation_examples(conversations: DataFrame, path: str, id_col: str = "conv_id") -> DataFrame:
    """An example per conversation: its turns in order, loss on the assistant's tokens only.

    A turn without text is empty; turns that tie are ordered by role and text.
    """
    turns = tokenize(conversations.select(id_col, "turn", "role", "text"), path)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "ids")))
    one = turns.groupBy(id_col).agg(ordered.alias("_turns"))
    mask = F.transform(
        "_turns",
        lambda t: F.unhex(
            F.repeat(
                F.when(t["role"] == "assistant", F.lit("01")).otherwise(F.lit("00")),
                (F.length(t["ids"]) / 4).cast("int"),
            )
        ),
    )
    joined = lambda parts: F.aggregate(
        parts, F.lit(b""), lambda done, part: F.concat(done, part)
    )
    return one.select(
        F.col(id_col).alias("doc_id"),
        joined(F.transform("_turns", lambda t: t["ids"])).alias("ids"),
        joined(mask).alias("loss_mask"),
    )


def pack_documents(
    docs: DataFrame, path: str, limits: Limits = Limits(), encode_special_tokens: bool = True
) -> DataFrame:
    """The pieces of all documents, each tokenised whole and ended by id 1."""
    ids = tokenize(
        docs.select("doc_id", "text"), path, encode_special_tokens=encode_special_tokens
    )
    return pack(ids.drop("text"), limits)
