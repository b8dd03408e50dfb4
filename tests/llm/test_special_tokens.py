"""op2 and the pipeline's last stage: ids as ``tokenizers`` gives them, special tokens included."""

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import queries

TEXTS = [
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "  <|endoftext|>  ",
    "<|endoftext| >", "don't <|ENDOFTEXT|>", "é<|endoftext|>漢字 " * 900, "", None,
]


def test_special_tokens_have_their_ids(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = list(enumerate(TEXTS))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    tokenizer = Tokenizer.from_file(queries.PACKING_TOKENIZER)
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    made = (
        queries.queries()["op2_packing"](spark, str(tmp_path)),
        corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(path), str(tmp_path)),
    )
    for pieces in made:
        by_doc = collections.defaultdict(list)
        for p in pieces.collect():
            by_doc[p.doc_id].append(p)
        for i, text in rows:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(ids))
                assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
