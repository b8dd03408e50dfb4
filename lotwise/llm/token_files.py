"""Token ids in compressed, checksummed binary files, in ascending order of ids of documents.

Rows are range-partitioned and sorted by document id; each task encodes its documents as they
stream by and emits *segments* of whole documents, which Spark's text writer puts one after
the other, so that lost tasks are repeated and committed as those of any table. A file:

    segment, line feed, segment, line feed, ...

A segment (little-endian; sizes in bytes):

    magic 4, version 2, ids per block 2, documents 4, ids 8, different ids 4, blocks 4,
    directory size 4, crc32 of what follows up to the payloads 4,
    directory: zlib of document ids (8 each), whether they are null (1 each), ids per document (8 each),
    symbols: the different ids (2 each), most frequent first, and their frequencies (4 each),
    blocks: payload size 4 and crc32 of the payload 4 each,
    payloads

Blocks are coded by ``range_coder``, each from a fresh model, and can be decoded alone by
``read_block``. A wrong checksum raises an error that names the block. A task holds one segment:
``SEGMENT_IDS`` ids, or those of a single longer document.

Null text is empty: it has the end id alone. Documents with equal or null ids are all written,
null ids first, equal ids in the order of their texts. Other columns are left out. An empty
table writes no segment and reads back as an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm import range_coder
from lotwise.llm.common import map_arrow, small_batches, texts_of
from lotwise.llm.word_bpe import WordEncoder
from lotwise.sources.scratch import new_path, stored

END_ID = 2
SEGMENT_IDS = 4 << 20
SEGMENTS_PER_FILE = 4
MAGIC, VERSION = b"TIDS", 1
HEAD = struct.Struct("<4sHHIQIIII")
PAYLOAD = struct.Struct("<II")
DOCUMENTS = "file string, place long, doc_id long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class Segment:
    doc_ids: np.ndarray  # int64
    unknown: np.ndarray  # bool: the id is null
    lengths: np.ndarray  # int64
    symbols: np.ndarray  # uint16 ids by symbol
    frequencies: np.ndarray
    payloads: list[memoryview]
    checksums: list[int]
    length: int

    def checked(self, block: int) -> bytes:
        payload = bytes(self.payloads[block])
        if zlib.crc32(payload) != self.checksums[block]:
            raise ValueError(f"Checksum of block {block} does not match")
        return payload

    def ids(self) -> np.ndarray:
        """All ids of the segment, as unsigned 16-bit integers."""
        payloads = [self.checked(i) for i in range(len(self.payloads))]
        return self.symbols[range_coder.decode(payloads, self.length, self.frequencies)]

    def read_block(self, block: int) -> np.ndarray:
        """The ids of one block, without looking at any other."""
        held = min(range_coder.BLOCK, self.length - block * range_coder.BLOCK)
        return self.symbols[range_coder.decode([self.checked(block)], held, self.frequencies)]


def pack_segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """``ids``: of each document, packed as unsigned 16-bit integers."""
    lengths = np.array([len(i) // 2 for i in ids], "<i8")
    flat = np.frombuffer(b"".join(ids), "<u2")
    counts = np.bincount(flat, minlength=1 << 16)
    present = np.flatnonzero(counts)
    symbols = present[np.argsort(-counts[present], kind="stable")]
    symbol_of = np.zeros(1 << 16, np.int32)
    symbol_of[symbols] = np.arange(len(symbols))
    payloads = range_coder.encode(symbol_of[flat], counts[symbols])
    directory = zlib.compress(
        np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + np.array([d is None for d in doc_ids], np.uint8).tobytes()
        + lengths.tobytes()
    )
    middle = b"".join(
        [
            directory,
            symbols.astype("<u2").tobytes(),
            counts[symbols].astype("<u4").tobytes(),
            *(PAYLOAD.pack(len(p), zlib.crc32(p)) for p in payloads),
        ]
    )
    sizes = len(doc_ids), len(flat), len(symbols), len(payloads), len(directory)
    head = HEAD.pack(MAGIC, VERSION, range_coder.BLOCK, *sizes, zlib.crc32(middle))
    return head + middle + b"".join(payloads)


def unpack_segment(data: memoryview) -> tuple[Segment, int]:
    """The segment at the start of ``data`` and its size."""
    magic, version, block, n, length, distinct, blocks, size, checksum = HEAD.unpack_from(data)
    if (magic, version, block) != (MAGIC, VERSION, range_coder.BLOCK):
        raise ValueError(f"Not a segment of this format: {magic!r}, {version}, {block}")
    at = HEAD.size
    stop = at + size + 6 * distinct + PAYLOAD.size * blocks
    if zlib.crc32(data[at:stop]) != checksum:
        raise ValueError("Checksum of the segment's directory does not match")
    directory = zlib.decompress(data[at : at + size])
    at += size
    symbols = np.frombuffer(data, "<u2", distinct, at)
    frequencies = np.frombuffer(data, "<u4", distinct, at + 2 * distinct).astype(np.int64)
    heads = [PAYLOAD.unpack_from(data, stop - PAYLOAD.size * (blocks - i)) for i in range(blocks)]
    payloads, at = [], stop
    for held, _ in heads:
        payloads.append(data[at : at + held])
        at += held
    found = Segment(
        np.frombuffer(directory, "<i8", n),
        np.frombuffer(directory, np.uint8, n, 8 * n).astype(bool),
        np.frombuffer(directory, "<i8", n, 9 * n),
        symbols,
        frequencies,
        payloads,
        [c for _, c in heads],
        length,
    )
    return found, at


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
    segments_per_file: int = SEGMENTS_PER_FILE,
) -> None:
    """Write the ids of ``text``, each document closed by ``end_id``, in order of ``doc_id``."""
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_segment(doc_ids, ids)], pa.binary())], ["value"])

        for batch in small_batches(batches, 4 << 20):
            encoded = encoder.encode(texts_of(batch.column(1)))
            for doc_id, packed in zip(batch.column(0).to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                ids.append(packed + end)
                held += len(packed) // 2 + 1
                if held >= segment_ids:
                    yield segment()
                    doc_ids, ids, held = [], [], 0
        if ids:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    segments = map_arrow(placed, run, "value binary")
    # A cast keeps the bytes as they are, and the writer puts them as they are.
    segments.select(F.col("value").cast("string")).write.option("lineSep", "\n").option(
        "compression", "none"
    ).option("maxRecordsPerFile", segments_per_file).text(path)


def segments_of(content: bytes | memoryview) -> Iterator[Segment]:
    """The segments of a file in turn."""
    data, at = memoryview(content), 0
    while at < len(data):
        segment, size = unpack_segment(data[at:])
        yield segment
        at += size + 1  # the line feed


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, doc_id, ids``: every document's ids, packed as unsigned 16-bit integers;
    ``place`` counts the documents of a file from 0."""

    def rows(place: int, segment: Segment, ids: np.ndarray) -> list[pa.Array]:
        ends = np.cumsum(segment.lengths)
        parts = [ids[a:b].tobytes() for a, b in zip(ends - segment.lengths, ends, strict=True)]
        return [pa.array(parts, pa.binary())]

    return _read(spark, path, rows, "file string, place long, doc_id long, ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``DOCUMENTS``: length and crc32 of every document's ids as unsigned 32-bit integers."""

    def rows(place: int, segment: Segment, ids: np.ndarray) -> list[pa.Array]:
        wide = memoryview(ids.astype("<u4").tobytes())
        ends = 4 * np.cumsum(segment.lengths)
        bounds = zip((ends - 4 * segment.lengths).tolist(), ends.tolist(), strict=True)
        return [pa.array(segment.lengths), pa.array([zlib.crc32(wide[a:b]) for a, b in bounds], pa.int64())]

    return _read(spark, path, rows, DOCUMENTS)


def _read(spark: SparkSession, path: str, rows, schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                place = 0
                for segment in segments_of(content.as_buffer()):
                    n = len(segment.lengths)
                    columns = [
                        pa.array([file.rpartition("/")[2]] * n, pa.string()),
                        pa.array(np.arange(place, place + n)),
                        pa.array(segment.doc_ids, mask=segment.unknown),
                        *rows(place, segment, segment.ids()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    place += n

    return map_arrow(_files(spark, path), run, schema)


def with_start(documents: DataFrame) -> DataFrame:
    """``documents`` of ``read_digests`` with ``start``, the ids of all documents before.

    Running sums within a file, which is bounded; and over the files, a row each, whose names
    hold the number of the writing partition and that of the file within it.
    """
    number = [F.regexp_extract("file", r"^part-(\d+)-.*?(?:-c(\d+))?\.", g).cast("int") for g in (1, 2)]
    files = documents.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    ordered = Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, -1)
    before = files.select(
        F.col("file").alias("_file"), F.coalesce(F.sum("_n").over(ordered), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        documents.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(before, F.col("file") == F.col("_file"))
        .withColumn("start", F.col("_before") + F.col("_within"))
        .drop("_file", "_before", "_within")
    )


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of ``docs``, read the files back: place, length and checksum a document."""
    spark = docs.sparkSession
    path = new_path(spark)
    write_token_ids(docs, path, tokenizer)
    return with_start(stored(read_digests(spark, path))).select("doc_id", "start", "n_tokens", "ids_crc32")
