"""op11: exact round trips of the coder and of the files, ids as those of tokenizers."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lotwise.llm import range_coder, token_files
from lotwise.llm.word_bpe import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("distinct", [1, 16, 17, 49408])
@pytest.mark.parametrize("length", [1, 2048, 4097])
def test_blocks_decode_to_what_was_coded(distinct, length):
    rng = np.random.default_rng(length + distinct)
    for symbols in (
        rng.integers(0, distinct, length),
        np.minimum(rng.geometric(0.4, length) - 1, distinct - 1),
        np.arange(length) % min(distinct, 7),
    ):
        prior = np.bincount(symbols, minlength=distinct)
        payloads = range_coder.encode(symbols, prior)
        assert len(payloads) == -(-length // range_coder.BLOCK)
        assert np.array_equal(range_coder.decode(payloads, length, prior), symbols)


def test_every_order_earns_its_place():
    """Random ids cost their entropy; a repeated phrase costs next to nothing."""
    rng = np.random.default_rng(5)
    noise, phrase = rng.integers(0, 256, 20_480), np.tile(rng.integers(0, 256, 100), 205)
    size = {}
    for name, symbols in (("noise", noise), ("phrase", phrase)):
        payloads = range_coder.encode(symbols, np.bincount(symbols, minlength=256))
        size[name] = 8 * sum(map(len, payloads)) / len(symbols)
    assert 8.0 < size["noise"] < 8.6
    assert size["phrase"] < 1.0


def test_a_block_is_read_alone_and_damage_is_named():
    ids = [np.arange(5000).astype("<u2").tobytes(), np.full(10, 2, "<u2").tobytes()]
    data = bytearray(token_files.pack_segment([4, None], ids))
    segment = next(token_files.segments_of(data))
    assert np.array_equal(segment.read_block(1), np.arange(2048, 4096))
    assert segment.unknown.tolist() == [False, True] and segment.lengths.tolist() == [5000, 10]
    data[-1] ^= 1
    segment = next(token_files.segments_of(data))
    assert np.array_equal(segment.read_block(0), np.arange(2048))
    with pytest.raises(ValueError, match="block 2"):
        segment.ids()
    data[token_files.HEAD.size] ^= 1
    with pytest.raises(ValueError, match="directory"):
        next(token_files.segments_of(data))


ODD = ["Don't, we'LL  x", "ÀÉÎ œuvre ﬁne İ Σας ΣΑΣ", "á  b c\x1cd\x85e", "<|endoftext|>a <|startoftext|>",
       "x<|endoftext|>y", "\0 a\0b", "1234 3½ ²", "漢字 仮名 абв", "😀!!! ??", " \n\t ", "", "it's'S 're", "A" * 300, "ß ẞ µ ª º"]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    encoder = WordEncoder(PATH)
    for texts in (ODD, ODD[::-1]):
        found = [np.frombuffer(p, "<u2").tolist() for p in encoder.encode(texts)]
        assert found == [plain_ids(tokenizer, t)[:-1] for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x3FF, exclude_categories=["Cs"]) | st.sampled_from("ab 'st,."), max_size=40), max_size=4))
def test_ids_of_any_text(tokenizer, texts):
    found = [np.frombuffer(p, "<u2").tolist() for p in WordEncoder(PATH).encode(texts)]
    assert found == [plain_ids(tokenizer, t)[:-1] for t in texts]


def expected_rows(tokenizer, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain_ids(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_a_plain_loop(spark, tokenizer, tmp_path):
    rows = [(i, f"Document {i} says: " + "over and over " * (i % 5)) for i in range(0, 90, 3)]
    rows += [(7, None), (8, ""), (8, "twice"), (8, "twice"), (None, "no id"), (None, None), (-5, "before"), (40, "long " * 9000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n_tokens int, file string").repartition(3)
    found = token_files.digest(docs, PATH).collect()
    expected = expected_rows(tokenizer, rows)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected

    path = str(tmp_path / "ids")  # small segments and files
    token_files.write_token_ids(docs, path, PATH, segment_ids=50, segments_per_file=2)
    found = token_files.with_start(token_files.read_digests(spark, path))
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in found.collect() if r.doc_id) == sorted(
        r for r in expected if r[0]
    )
    read = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in token_files.read_token_ids(spark, path).collect()}
    assert read[40] == plain_ids(tokenizer, "long " * 9000)
    assert read[7] == [2]


def test_an_empty_table(spark):
    found = token_files.digest(spark.createDataFrame([], SCHEMA), PATH)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() == 0
