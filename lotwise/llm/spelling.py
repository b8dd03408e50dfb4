"""Spelling variants: words one edit apart, found by a frontier over a trie of all words.

The trie is a table of edges: ``(node, label, child)``, where a node is a prefix at which words
part or end, and a label the letters up to the next such prefix. Level by level the frontier of
states ``(word, position, node, edits)`` is joined with it:

* without an edit so far, a state follows its own word's edge; at any other edge of the
  node the two words part, and the edit must lie there: a replaced letter (label after its
  first letter equals the word after its next) or a left-out one (label equals the word after
  its next letter);
* after the edit a state follows the edge that equals the word.

A state with one edit that has used up its word at a node where a word ends is a pair of
neighbours. Inserted letters are the left-out ones seen from the other word, and of two words
that replace each other only the one with the smaller letter looks, so each pair is found
once. A state lives as long as some word shares its prefix: long words cost no more levels
than there are partings on their way.

Nodes are named by hashes of their prefixes. Equal hashes of different prefixes can only add
paths; pairs are checked letter by letter at the end. A node that many words pass is dealt to
several keys, each with its own copy of the node's edges, which the alphabet bounds.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import map_arrow, small_batches
from lotwise.sources.scratch import stored

ONE_IN = 199  # of (document, run) pairs lose a letter
MIN_LETTERS = 6
MIN_COUNT = 5
FREQUENCY_RATIO = 5
HOT = 20_000  # words through a node that share a key
FLUSH_BYTES = 16 << 20  # of text between two partial counts
ROOT_NODE = 0
HASH_PRIME = (1 << 61) - 1
HASH_FACTOR = 0x5DEECE66D1234567 % HASH_PRIME


# --- Words -------------------------------------------------------------------------


def spelled(run: str, h: int) -> str:
    """The run as it counts in a document; ``h``: crc32 of ``<id>:<run>``."""
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of all words with enough letters and occurrences.

    Null text has no words; a null id spells as an empty one; rows that repeat an id count
    again. Occurrences are added up in the tasks before the shuffle, so a frequent word
    costs a row a few megabytes of text.
    """

    # Shorter runs cannot become words. UTF-8 lowered as bytes lowers A-Z alone.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_letters)
    crc32 = zlib.crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)
        chars = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        for batch in small_batches(batches, 4 << 20):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                start = crc32(b"%d:" % doc_id if doc_id is not None else b":")
                for token, n in Counter(runs.findall((text or b"").lower().decode())).items():
                    h = crc32(token.encode(), start)
                    if h % ONE_IN:
                        held[token] += n
                    elif len(word := spelled(token, h)) >= min_letters:
                        held[word] += n
                chars += len(text or b"")
                if chars > FLUSH_BYTES:  # no more words than letters have been read
                    yield flush()
                    held, chars = defaultdict(int), 0
        yield flush()

    counted = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- Trie --------------------------------------------------------------------------


def prefix_rows(words: DataFrame) -> DataFrame:
    """``id, node, depth, follows`` for every prefix of every word; ``follows`` is the next
    letter, empty at the word's end. A prefix's hash is made from that of the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            ids, nodes, depths, follows = [], [], [], []
            for number, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                node = ROOT_NODE
                for depth, letter in enumerate(word):
                    ids.append(number)
                    nodes.append(node)
                    depths.append(depth)
                    follows.append(letter)
                    node = (node * HASH_FACTOR + ord(letter)) % HASH_PRIME
                ids.append(number)
                nodes.append(node)
                depths.append(len(word))
                follows.append("")
            columns = [pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(depths, pa.int32()), pa.array(follows)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "depth", "follows"])

    return map_arrow(words.select("id", "word"), run, "id long, node long, depth int, follows string")


def trie_edges(rows: DataFrame, words: DataFrame, hot: int = HOT) -> tuple[DataFrame, int]:
    """``node, key, label, letter, child, child_keys, ends`` and the number of the root's keys.

    ``rows``: the stored ``prefix_rows`` of ``words``; ``letter``: the label's first; ``ends``:
    a word ends at the child. A node has a key for every ``hot`` words that pass it.
    """
    nodes = (
        rows.groupBy("node", "follows")
        .agg(F.count(F.lit(1)).alias("passing"))
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("ways"),
            F.sum("passing").alias("passing"),
            F.max(F.col("follows") == "").alias("ends"),
        )
        .filter((F.col("ways") > 1) | F.col("ends") | (F.col("node") == ROOT_NODE))
        .select("node", F.ceil(F.col("passing") / hot).cast("int").alias("keys"), "ends")
    )
    nodes = stored(nodes)
    path = (
        rows.select("id", "node", "depth")
        .join(nodes, "node")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node", "keys", "ends"))).alias("path"))
        .join(words, "id")
        .select(
            "word",
            F.explode(
                F.arrays_zip(
                    F.expr("slice(path, 1, size(path) - 1)").alias("a"),
                    F.expr("slice(path, 2, size(path) - 1)").alias("b"),
                )
            ).alias("e"),
        )
    )
    label = F.expr("substring(word, e.a.depth + 1, e.b.depth - e.a.depth)")
    edges = (
        path.select(
            F.col("e.a.node").alias("node"),
            F.col("e.a.keys").alias("keys"),
            label.alias("label"),
            F.col("e.b.node").alias("child"),
            F.col("e.b.keys").alias("child_keys"),
            F.col("e.b.ends").alias("ends"),
        )
        .distinct()
        .withColumn("key", F.explode(F.expr("sequence(0, keys - 1)")))
        .withColumn("letter", F.substring("label", 1, 1))
        .drop("keys")
    )
    root = nodes.filter(F.col("node") == ROOT_NODE).first()
    return stored(edges), root.keys if root else 1


def _key(keys: Column | str) -> Column:
    return F.pmod(F.hash("id"), F.col(keys) if isinstance(keys, str) else keys).cast("int")


_MOVED = ("id", "rest", "child", "child_keys", "edited", "ends")


def second_letters(edges: DataFrame) -> DataFrame:
    """``edges`` by ``second``, the letter that can follow the first one; '' where a word may end.

    An edge of one letter has a row for each edge of its child, and one if a word ends there.
    """
    long = edges.filter(F.length("label") > 1).withColumn("second", F.substring("label", 2, 1))
    short = edges.filter(F.length("label") == 1)
    next_letters = edges.select(F.col("node").alias("child"), F.col("letter").alias("second")).distinct()
    return (
        long.unionByName(short.join(next_letters, "child"))
        .unionByName(short.filter("ends").withColumn("second", F.lit("")))
        .select(*edges.columns, "second")
    )


def one_edit_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``a, b``: ids of words one edit apart, each pair once, and pairs of equal hashes, if any.

    ``words``: a stored table ``id, word, n``. A state meets the edges that start with its next
    letter, or with the one after if it leaves a letter out; a replaced letter is met by the
    letter that follows it. So no state is joined with all edges of a node.
    """
    rows = stored(prefix_rows(words))
    edges, root_keys = trie_edges(rows, words, hot)
    replacing = stored(second_letters(edges))
    frontier = words.select(
        "id",
        F.col("word").alias("rest"),
        F.lit(ROOT_NODE).cast("long").alias("node"),
        _key(F.lit(root_keys)).alias("key"),
        F.lit(False).alias("edited"),
    )
    first, second = F.substring("rest", 1, 1), F.substring("rest", 2, 1)
    # Letters to look for, and how many of the word are left out before them.
    followed = F.struct(first.alias("letter"), F.lit(0).alias("skipped"))
    left_out = F.struct(second.alias("letter"), F.lit(1).alias("skipped"))
    may_skip = ~F.col("edited") & (second != "") & (second != first)
    probes = F.when(may_skip, F.array(followed, left_out)).otherwise(F.array(followed))
    pairs = None
    while True:
        probing = frontier.select("*", F.inline(probes))
        along = probing.join(edges, ["node", "key", "letter"]).filter(
            F.expr("substring(rest, 1 + skipped, length(label)) = label")
        )
        changed = (
            frontier.filter(~F.col("edited"))
            .withColumn("second", second)
            .join(replacing, ["node", "key", "second"])
            .filter(F.col("letter") > first)
            .filter(F.expr("length(rest) >= length(label) AND substring(rest, 2, length(label) - 1) = substring(label, 2)"))
        )
        moved = stored(
            along.withColumn("edited", F.col("edited") | (F.col("skipped") == 1))
            .withColumn("used", F.length("label") + F.col("skipped"))
            .select(*_MOVED, "used")
            .unionByName(
                changed.withColumn("edited", F.lit(True)).withColumn("used", F.length("label")).select(*_MOVED, "used")
            )
            .select(
                "id",
                F.expr("substring(rest, used + 1)").alias("rest"),
                F.col("child").alias("node"),
                _key("child_keys").alias("key"),
                "edited",
                "ends",
            )
        )
        # A word is used up after its edit, or its last letter is left out.
        ended = F.when(F.col("edited"), F.col("rest") == "").otherwise(F.length("rest") == 1)
        met = moved.filter(ended & F.col("ends")).select(F.col("id").alias("a"), "node")
        pairs = met if pairs is None else pairs.unionByName(met)
        frontier = moved.filter(F.col("rest") != "").drop("ends")
        if frontier.isEmpty():
            last = rows.filter(F.col("follows") == "").select("node", F.col("id").alias("b"))
            return pairs.join(last, "node").select("a", "b").distinct()


# --- Groups ------------------------------------------------------------------------


def group_variants(words: DataFrame, ratio: int = FREQUENCY_RATIO, hot: int = HOT) -> DataFrame:
    """``word, n, form, form_n, n_near, root`` for each row of ``words``: ``word, n``, words distinct.

    A word's form is the most frequent word one edit away (of equals the first in code-point
    order), if it is ``ratio`` times as frequent; its root is where its forms lead.
    """
    words = stored(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    left, right = (
        words.select(F.col("id").alias(c), F.col("word").alias(f"word_{c}"), F.col("n").alias(f"n_{c}"))
        for c in ("a", "b")
    )
    pairs = (
        one_edit_pairs(words, hot)
        .join(left, "a")
        .join(right, "b")
        .filter(F.levenshtein("word_a", "word_b", 1) == 1)
    )
    near = stored(pairs)
    near = near.select(F.col("a").alias("id"), F.col("b").alias("other"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        near.select(F.col("b").alias("id"), F.col("a").alias("other"), F.col("word_a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near", "other")).alias("best")
    counted = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    often = -F.col("best.less") >= ratio * F.col("n")
    grouped = stored(
        words.join(counted, "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best.near")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
            F.when(often, F.col("best.other")).alias("form_id"),
        )
    )
    return grouped.join(_roots(grouped), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(grouped: DataFrame) -> DataFrame:
    """``id, root`` for words with a form. Each round doubles the steps taken; a form is more
    frequent than its word, so no way leads back."""
    reach = stored(grouped.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("at")))
    while True:
        ahead = reach.select(F.col("id").alias("at"), F.col("at").alias("next"))
        moved = stored(reach.join(ahead, "at", "left").select("id", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("moved")))
        reach = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            names = grouped.select(F.col("id").alias("at"), F.col("word").alias("root"))
            return reach.join(names, "at").select("id", "root")


def digest(docs: DataFrame) -> DataFrame:
    """The words of ``docs`` with their forms and roots."""
    return group_variants(count_words(docs))
