"""Operators against plain loops over small tables with nulls, ties, repeats and odd columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lotwise.llm import byte_bpe, exact_dedup, line_dedup, ngram_join, packing, suffix_dedup, warc

SCHEMA = "doc_id long, text string, _text string, n long, lang string"


def documents(spark, *texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def mixed():
    """Copies, near copies, shared passages and lines, junk, null and empty texts."""
    rng = random.Random(5)
    passage = " ".join(words(rng, 70))
    out = [None, "", " \n\t", "One", "one", "ü" * 500, "ab" * 400, "In. " * 300]
    for _ in range(12):
        base = words(rng, 90)
        out += [" ".join(base), " ".join(base)]
        for _ in range(3):
            near = list(base)
            for _ in range(rng.randint(1, 3)):
                near[rng.randrange(90)] = "x"
            out.append(" ".join(near))
    out += ["\n".join([" Shared LINE\t", " ".join(words(rng, 9)), passage]) for _ in range(11)]
    out += ["shared line"]
    return out


def test_frequent_lines_go(spark, mixed):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    counts = collections.Counter()
    for text in mixed:
        counts.update({key(line) for line in (text or "").split("\n")})
    rows = {r.doc_id: r for r in line_dedup.digest(documents(spark, *mixed)).collect()}
    assert len(rows) == len(mixed)
    for i, text in enumerate(mixed):
        lines = (text or "").split("\n")
        kept = [line for line in lines if not key(line) or counts[key(line)] < 10]
        assert (rows[i].n_lines, rows[i].n_dropped) == (len(lines), len(lines) - len(kept))
        assert rows[i].kept_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()
    assert sum(r.n_dropped for r in rows.values()) >= 12


def test_copies_keep_the_largest_id(spark, mixed):
    groups = collections.defaultdict(list)
    for i, text in enumerate(mixed):
        groups[text or ""].append(i)
    docs = documents(spark, *mixed)
    for r in exact_dedup.mark_copies(docs).collect():
        members = groups[mixed[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(members), len(members), r.doc_id == max(members))
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(max(m) for m in groups.values())


def test_repeated_rows_and_null_ids_leave_one_row(spark):
    docs = documents(spark, "a", "a", "b", "b", "c", ids=[1, 1, None, None, 2])
    assert sorted(r.text for r in exact_dedup.drop_copies(docs).collect()) == ["a", "b", "c"]


def test_shingle_components_match_all_pairs(spark, mixed):
    def shingles(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    sets = [shingles(t) for t in mixed]
    root = list(range(len(mixed)))
    for i in range(len(mixed)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    docs = documents(spark, *mixed)
    rows = ngram_join.link_documents(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (len(sets[i]), root[i]) for i in range(len(mixed))
    }
    assert len(set(root)) < len(root) - 20


def test_index_keys_meet_for_every_linked_pair():
    """Whatever shingles count as frequent, linked sets share a key."""
    rng = np.random.default_rng(2)
    for size in (5, 12, 40, 130, 700):
        for _ in range(30):
            whole = np.unique(rng.integers(0, 2**63, size * 2).astype(np.uint64))
            x = np.sort(rng.permutation(whole)[:size])
            gone = rng.integers(0, size // 9 + 1)
            y = np.unique(np.concatenate([x[rng.permutation(size)[gone:]], rng.integers(0, 2**63, gone).astype(np.uint64)]))
            shared = len(np.intersect1d(x, y))
            if 100 * shared < 80 * (len(x) + len(y) - shared):
                continue
            frequent = set(rng.permutation(whole)[: rng.integers(0, len(whole) + 1)].tolist())
            keys = []
            for s in (x, y):
                common = np.array([t in frequent for t in s.tolist()])
                order = np.argsort(common, kind="stable")
                keys.append(ngram_join.prefix_keys(s[order], common[order], len(s), 80))
            assert len(np.intersect1d(*keys))


def test_block_comparison_joins_all_linked_classes():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 2**63, k).astype(np.uint64)])) for k in range(12)]
    found = list(ngram_join._joining(sets, np.arange(12), 80))
    assert len(found) == 11
    assert not list(ngram_join._joining(sets, np.zeros(12, int), 80))


def test_repeated_bytes_go(spark, mixed):
    data = [(t or "").encode() for t in mixed]
    counts = collections.Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    docs = documents(spark, *mixed)
    for r in suffix_dedup.digest(docs).collect():
        d = data[r.doc_id]
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if counts[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed) == (len(d), gone.sum())
        assert r.n_spans == sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup.drop_repeats(docs).columns == docs.columns


def test_large_keys_are_split_to_the_same_result(spark, mixed, monkeypatch):
    docs = documents(spark, *mixed)
    rows = sorted(suffix_dedup.digest(docs).collect())
    monkeypatch.setattr(suffix_dedup, "MOST", 1)
    assert sorted(suffix_dedup.digest(docs).collect()) == rows


def test_repeats_in_random_blocks():
    rng = random.Random(7)
    base = bytes(rng.choices(b"abc ", k=1500))
    for _ in range(15):
        segments = []
        for _ in range(rng.randint(1, 8)):
            at = rng.randint(0, 900)
            part = bytearray(base[at : at + rng.randint(200, 600)])
            part[rng.randrange(len(part))] = 65
            segments.append(bytes(part))
        counts = collections.Counter(s[i : i + 200] for s in segments for i in range(len(s) - 199))
        for segment, marks in zip(segments, suffix_dedup.repeated_windows(segments), strict=True):
            assert marks.tolist() == [counts[segment[i : i + 200]] > 1 for i in range(len(segment) - 199)]


ODD = ["  two", "a  b\n c \n\n d", " x  y \x1c z", "don't'll 12½ <|endoftext|>", "漢字 😀😀", "é" * 3000]


def test_ids_are_those_of_the_libraries(spark, mixed):
    texts = mixed + ODD
    docs = documents(spark, *texts)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    expected = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in byte_bpe.digest(docs, path, public_tokenizers.PATTERN).collect():
        text = texts[r.doc_id] or ""
        ids = np.array(expected.encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    limits = packing.Limits()
    pieces = packing.pack_documents(docs, path, limits).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        _check_sequence(parts, limits)


def _check_sequence(parts, limits):
    at = 0
    for p in sorted(parts, key=lambda p: p.offset):
        assert p.offset == at
        at += p.length
    assert at & (at - 1) == 0 and at <= limits.tokens
    assert len(parts) <= limits.segments and sum(p.loss_tokens for p in parts) <= limits.loss


def test_packing_keeps_to_all_limits(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 3, 50, 700])
        rows.append((i, np.arange(n, dtype="<u4").tobytes(), bytes(rng.random() < 0.5 for _ in range(n))))
    examples = spark.createDataFrame(rows, "doc_id long, ids binary, loss_mask binary")
    limits = packing.Limits(256, 5, 100)
    pieces = packing.pack(examples, limits).collect()
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    for parts in by_sequence.values():
        _check_sequence(parts, limits)
    assert sum(p.length for p in pieces) == sum(len(r[1]) // 4 for r in rows)
    assert sum(p.loss_tokens for p in pieces) == sum(sum(r[2]) for r in rows)


def test_conversations_bear_loss_on_answers(spark):
    turns = [(1, 1, "assistant", "yes it is"), (1, 0, "user", "is it"), (2, 0, "user", None)]
    rows = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    found = packing.conversation_examples(rows, public_tokenizers.path("byte_bpe_50k.json")).collect()
    one = {r.doc_id: r for r in found}[1]
    n = len(one.ids) // 4
    assert len(one.loss_mask) == n and 0 < sum(one.loss_mask) < n and one.loss_mask[-1] == 1


def test_archives_resolve_revisits(spark):
    pages = [
        (5, "http://a/ b\n", "<p>x</p>"), (3, None, "<p>x</p>"), (9, "u", None), (2, "u", ""),
        (7, "u", "ends\r\n"), (8, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (1, "u", "é" * 9),
        (None, "u", "<p>x</p>"),
    ]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, n string")
    rows = {r.page_id: r for r in warc.round_trip(table).collect()}
    assert len(rows) == len(pages)
    first = {}
    for i, _, html in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", i)
    for i, _, html in pages:
        data, original = (html or "").encode(), first[html or ""]
        r = rows[i]
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if i == original else ("revisit", original))


def test_empty_tables(spark):
    docs = documents(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    for found in (
        line_dedup.digest(docs), exact_dedup.mark_copies(docs), exact_dedup.drop_copies(docs),
        ngram_join.link_documents(docs), suffix_dedup.digest(docs), packing.pack_documents(docs, path),
        warc.round_trip(pages),
    ):
        assert found.count() == 0
