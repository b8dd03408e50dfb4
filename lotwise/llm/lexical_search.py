"""Ranked lexical search: Block-Max MaxScore over shards of an inverted index.

``build_index`` deals documents, as they stream by, to shards of bounded size. A row of the
index is one term's list in one shard: compressed blocks of ``BLOCK`` postings, and for each
block what bounds its scores: the shortest document with the term once, the shortest with it
more often, and the largest count. A row without term holds the shard's documents. Bounds are
kept as counts and lengths, so the index needs no statistics of the whole collection.

``search`` takes the queries in blocks of bounded size. For each shard and query it adds up
whole lists, the one with the largest bound first, until the lists that are left cannot lift
a new document to the k-th score; those are non-essential. Of them a list is only read where a
document's score so far, and the maxima of the blocks that it lies in, could reach the k-th
score: other blocks are never decompressed. The k best of the shards are merged.

Scores are integers. A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n
terms has m = 100 - 90 + (90 n N) div L; a term found tf times adds its weight times
(10^9 tf) div (1000 tf + 8 m).

Every row is a document of its own, also with an equal or null id; null text has no terms and
is never found. Equal scores rank by ascending id, null ids last. Every row of the queries is
a query of its own; a null text finds nothing. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from lotwise.llm.common import ROOT, map_arrow, small_batches
from lotwise.sources.scratch import stored

K = 10
BLOCK = 128
SHARD_TERMS = 4 << 20
QUERIES, QUERY_BYTES = 4096, 4 << 20  # of one block of queries
DENSITY = 10**9
INDEX = "shard long, term binary, documents long, occurrences long, blocks binary, postings binary"
# A block: its last document, postings, bytes of gaps and of counts, the least length of its
# documents with the term once and more often, and the largest count.
BLOCKS = np.dtype(
    [("last", "<u4"), ("n", "<u2"), ("gaps", "<u2"), ("counts", "<u2"), ("once", "<u4"), ("more", "<u4"), ("most", "<u4")]
)
NONE = np.uint32(0xFFFFFFFF)
# Bytes of terms, A-Z lowered; all others part terms. Bytes above 0x7F belong to terms.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


# --- Varints -----------------------------------------------------------------------


def pack_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low ones first; and the bytes of each value."""
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= 1 << bits
    starts = np.cumsum(sizes) - sizes
    packed = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        more = (sizes[has] > k + 1).astype(np.int64) << 7
        packed[starts[has] + k] = values[has] >> 7 * k & 127 | more
    return packed, sizes


def unpack_varints(packed: np.ndarray) -> np.ndarray:
    last = packed < 128
    if last.all():
        return packed.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    values = np.zeros(len(ends), np.int64)
    for k in range(int((ends - starts).max()) + 1):
        has = np.flatnonzero(ends - starts >= k)
        values[has] |= (packed[starts[has] + k].astype(np.int64) & 127) << 7 * k
    return values


# --- Index -------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers terms in order of appearance."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive slices of ``data`` as binary values."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


def index_shard(shard: int, doc_ids: list[int | None], terms: list[np.ndarray], words: dict[bytes, int]) -> pa.RecordBatch:
    """Index rows of a shard. ``terms``: numbers of each document's terms by ``words``."""
    lengths = np.array([len(t) for t in terms], np.int64)
    documents = np.concatenate(
        [
            np.array([d or 0 for d in doc_ids], "<i8").view(np.uint8),
            lengths.astype("<i8").view(np.uint8),
            np.array([d is None for d in doc_ids], np.uint8),
        ]
    )
    keys = np.concatenate(terms).astype(np.int64) * len(terms) + np.repeat(np.arange(len(terms)), lengths)
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys))
    term, doc = np.divmod(keys[first], len(terms))
    starts = np.flatnonzero(np.diff(term, prepend=-1))  # of the lists
    df = np.diff(starts, append=len(term))

    place = np.arange(len(term)) - np.repeat(starts, df)
    blocks = np.flatnonzero(place % BLOCK == 0)
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = doc[starts] + 1
    packed_gaps, gap_sizes = pack_varints(gaps)
    packed_counts, count_sizes = pack_varints(counts)
    n = np.diff(blocks, append=len(term))
    table = np.zeros(len(blocks), BLOCKS)
    length = lengths[doc]
    table["last"], table["n"] = doc[blocks + n - 1] if len(blocks) else 0, n
    table["gaps"], table["counts"] = _sums(gap_sizes, blocks), _sums(count_sizes, blocks)
    if len(blocks):
        table["once"] = np.minimum.reduceat(np.where(counts == 1, length, int(NONE)), blocks)
        table["more"] = np.minimum.reduceat(np.where(counts > 1, length, int(NONE)), blocks)
        table["most"] = np.maximum.reduceat(counts, blocks)

    # A list's bytes are all its gaps, then all its counts.
    gap_bytes, count_bytes = _sums(gap_sizes, starts), _sums(count_sizes, starts)
    size = gap_bytes + count_bytes
    begin = np.cumsum(size) - size
    postings = np.empty(len(packed_gaps) + len(packed_counts), np.uint8)
    at_gaps = np.repeat(begin - (np.cumsum(gap_bytes) - gap_bytes), gap_bytes)
    postings[np.arange(len(packed_gaps)) + at_gaps] = packed_gaps
    at_counts = np.repeat(begin + gap_bytes - (np.cumsum(count_bytes) - count_bytes), count_bytes)
    postings[np.arange(len(packed_counts)) + at_counts] = packed_counts

    names = list(words)
    blocks_of = -(-df // BLOCK)
    rows = len(starts) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, shard)),
            pa.array([None, *(names[t] for t in term[starts].tolist())], pa.binary()),
            pa.array(np.concatenate([[np.count_nonzero(lengths)], df])),
            pa.array(np.concatenate([[lengths.sum()], _sums(counts, starts)])),
            _binary(np.concatenate([documents, table.view(np.uint8)]), np.concatenate([[len(documents)], blocks_of * BLOCKS.itemsize])),
            _binary(postings, np.concatenate([[0], size])),
        ],
        names=[part.split()[0] for part in INDEX.split(", ")],
    )


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``INDEX`` rows of all documents, shard by shard. A shard closes at ``shard_terms`` terms;
    its number is that of the partition and a count within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Numbers()
        doc_ids: list[int | None] = []
        terms: list[np.ndarray] = []
        held, shard = 0, None

        for batch in small_batches(batches):
            partition = batch.column(2)[0].as_py() << 32
            shard = partition if shard is None else shard
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                numbers = np.array(list(map(words.__getitem__, terms_of(text))), np.int32)
                doc_ids.append(doc_id)
                terms.append(numbers)
                held += len(numbers) + 16
                if held >= shard_terms:
                    yield from _rows(index_shard(shard, doc_ids, terms, words))
                    words, doc_ids, terms, held, shard = _Numbers(), [], [], 0, shard + 1
        if doc_ids:
            yield from _rows(index_shard(shard, doc_ids, terms, words))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("partition")
    )
    return map_arrow(rows, run, INDEX)


def _rows(batch: pa.RecordBatch, at_once: int = 50_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, at_once):
        yield batch.slice(at, at_once)


# --- Search ------------------------------------------------------------------------


@dataclass
class PostingList:
    """One term's list in a shard, with the largest score of each block."""

    blocks: np.ndarray
    postings: np.ndarray
    weight: int
    maxima: np.ndarray  # per block
    bound: int

    def read(self, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and counts of the blocks at ``wanted``, or of all."""
        table = self.blocks
        gap_sizes, count_sizes = table["gaps"].astype(np.int64), table["counts"].astype(np.int64)
        cut = int(gap_sizes.sum())
        gaps, counts = self.postings[:cut], self.postings[cut:]
        before = np.concatenate([[-1], table["last"][:-1].astype(np.int64)])
        n = table["n"].astype(np.int64)
        if wanted is not None:
            keep = np.zeros(len(table), bool)
            keep[wanted] = True
            gaps, counts = gaps[np.repeat(keep, gap_sizes)], counts[np.repeat(keep, count_sizes)]
            before, n = before[keep], n[keep]
        docs = np.cumsum(unpack_varints(gaps))
        ends = np.cumsum(n)
        done = np.concatenate([[0], docs[ends[:-1] - 1]])  # the running sum before each block
        return docs + np.repeat(before - done, n), unpack_varints(counts)


class Shard:
    """The lists of a shard that queries ask for."""

    def __init__(self, rows: pa.Table, weights: dict[bytes, int], documents: int, terms: int):
        self.lists: dict[bytes, PostingList] = {}
        self.read: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.documents, self.terms = documents, terms
        blobs = list(zip(*(rows.column(c).to_pylist() for c in ("term", "blocks", "postings")), strict=True))
        of_all = next(b for t, b, _ in blobs if t is None)
        n = len(of_all) // 17
        self.doc_ids = np.frombuffer(of_all, "<i8", n)
        self.share = self.length_share(np.frombuffer(of_all, "<i8", n, 8 * n))
        self.unknown = np.frombuffer(of_all, np.uint8, n, 16 * n)
        for term, blocks, postings in blobs:
            if term is not None and weights[term] > 0:
                table = np.frombuffer(blocks, BLOCKS)
                maxima = weights[term] * np.maximum(
                    self._bound(np.uint32(1), table["once"]), self._bound(table["most"], table["more"])
                )
                self.lists[term] = PostingList(
                    table, np.frombuffer(postings, np.uint8), weights[term], maxima, int(maxima.max())
                )

    def length_share(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 90 + 90 * lengths.astype(np.int64) * self.documents // self.terms

    def _bound(self, count: np.ndarray, shortest: np.ndarray) -> np.ndarray:
        """The largest density of documents with up to ``count`` and from ``shortest`` on."""
        there = shortest != NONE
        return density(count, self.length_share(np.where(there, shortest, 1))) * there

    def _whole(self, term: bytes) -> tuple[np.ndarray, np.ndarray]:
        """All documents of a list and their scores; queries share what has been read."""
        if term not in self.read:
            found = self.lists[term]
            docs, counts = found.read()
            self.read[term] = docs, found.weight * density(counts, self.share[docs])
        return self.read[term]

    def best(self, terms: list[bytes], k: int) -> list[tuple[int, int]]:
        """``(place, score)`` of the k best documents, best first, among all with a score."""
        lists = sorted((t for t in terms if t in self.lists), key=lambda t: (-self.lists[t].bound, t))
        bounds = [self.lists[t].bound for t in lists]
        left = sum(bounds)
        scores = np.zeros(len(self.doc_ids), np.int64)
        least = 1  # the k-th best score so far: what a document must reach
        at = 0
        while at < len(lists) and left >= least:
            docs, added = self._whole(lists[at])
            scores[docs] += added
            left -= bounds[at]
            at += 1
            if left < int(scores.max()):
                least = kth(scores, k)
        places = np.flatnonzero(scores)
        if at < len(lists):
            places = places[scores[places] + left >= least]
            rest = [self.lists[t] for t in lists[at:]]
            places = self._finish(places, scores, rest, least, k)
        ranked = sorted((-int(scores[p]), int(self.unknown[p]), int(self.doc_ids[p]), int(p)) for p in top(places, scores, k))
        return [(p, -s) for s, _, _, p in ranked[:k]]

    def _finish(
        self, places: np.ndarray, scores: np.ndarray, rest: list[PostingList], least: int, k: int
    ) -> np.ndarray:
        """Adds the non-essential lists to ``scores`` of candidates; returns those left."""
        of_block = []  # per list: each candidate's block, and that block's maximum
        for found in rest:
            block = np.searchsorted(found.blocks["last"], places)
            inside = block < len(found.blocks)
            of_block.append((block, np.where(inside, found.maxima[np.minimum(block, len(found.blocks) - 1)], 0)))
        hope = sum((m for _, m in of_block), np.zeros(len(places), np.int64))
        alive = np.flatnonzero(scores[places] + hope >= least)
        for found, (block, maxima) in zip(rest, of_block, strict=True):
            if not len(alive):
                break
            asked = alive[maxima[alive] > 0]
            if len(asked):
                docs, counts = found.read(np.unique(block[asked]))
                mine = places[asked]
                at = np.minimum(np.searchsorted(docs, mine), len(docs) - 1)
                hit = docs[at] == mine
                scores[mine[hit]] += found.weight * density(counts[at[hit]], self.share[mine[hit]])
            hope = hope - maxima
            least = max(least, kth(scores[places[alive]], k))
            alive = alive[scores[places[alive]] + hope[alive] >= least]
        return places[alive]


def density(counts: np.ndarray, share: np.ndarray) -> np.ndarray:
    counts = counts.astype(np.int64)
    return DENSITY * counts // (1000 * counts + 8 * share)


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, 1 where fewer documents have any."""
    if len(scores) < k:
        return 1
    return max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))


def top(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places that reach the k-th score, ties included."""
    own = scores[places]
    return places[own >= kth(own, k)]


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _query_blocks(queries: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Queries as ``(item_id, distinct terms)``, in blocks that stay small on the driver."""
    block, held = [], 0
    for row in queries.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        block.append((row.item_id, sorted(set(terms_of(bytes(row.text or b""))))))
        held += len(row.text or b"")
        if len(block) >= QUERIES or held >= QUERY_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each row of ``queries``.

    ``index`` is read twice a block of queries, so it should be a stored table."""
    spark = index.sparkSession
    schema = StructType(
        [
            StructField("query", LongType()),
            StructField("item_id", queries.schema["item_id"].dataType),
            StructField("doc_id", LongType()),
            StructField("score", LongType()),
        ]
    )
    documents, terms = index.filter("term IS NULL").agg(
        F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("occurrences"), F.lit(0))
    ).first()
    everything, first = spark.createDataFrame([], schema), 0
    for block in _query_blocks(queries) if documents else []:
        everything = everything.unionByName(
            stored(_search_block(index, block, first, k, (documents, terms), schema))
        )
        first += len(block)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = everything.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_block(
    index: DataFrame,
    block: list[tuple[int | None, list[bytes]]],
    first: int,
    k: int,
    totals: tuple[int, int],
    schema: StructType,
) -> DataFrame:
    """The k best documents of every shard for each query; ``first`` numbers the queries."""
    spark = index.sparkSession
    arrow = to_arrow_schema(schema)
    # Bounded by QUERIES and QUERY_BYTES, whatever the documents.
    asked = sorted({t for _, terms in block for t in terms})
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in asked], "term binary"))
    lists = index.join(wanted, "term", "left_semi").select("shard", "term", "documents", "blocks", "postings")
    df = lists.groupBy("term").agg(F.sum("documents").alias("df")).collect()
    weights = {bytes(row.term): weight(totals[0], row.df) for row in df}
    shared = spark.sparkContext.broadcast((block, weights))

    def run(rows: pa.Table) -> pa.Table:
        queries, weights = shared.value
        shard = Shard(rows, weights, *totals)
        found = [
            (first + q, item, None if shard.unknown[place] else int(shard.doc_ids[place]), score)
            for q, (item, terms) in enumerate(queries)
            for place, score in shard.best(terms, k)
        ]
        columns = zip(*found, strict=True) if found else [[]] * len(arrow)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    rows = lists.unionByName(index.filter("term IS NULL").select(*lists.columns)).drop("documents")
    return rows.groupBy("shard").applyInArrow(run, schema)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Index ``docs``, store the index, search it."""
    return search(stored(build_index(docs)), queries, k)
