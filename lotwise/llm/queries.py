"""Named queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import (
    byte_bpe,
    embedding_links,
    exact_dedup,
    lexical_search,
    line_dedup,
    ngram_join,
    packing,
    quality_model,
    spelling,
    suffix_dedup,
    token_files,
    toxicity,
    warc,
)
from lotwise.llm.common import table

PACKING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda s, d: table(s, d, "documents")
    return {
        "op1_line_dedup": lambda s, d: line_dedup.digest(docs(s, d)),
        "op2_packing": lambda s, d: packing.pack_documents(
            docs(s, d), PACKING_TOKENIZER, encode_special_tokens=False
        ),
        "op3_embedding_links": lambda s, d: embedding_links.link_vectors(table(s, d, "embeddings")),
        "op4_toxicity": lambda s, d: toxicity.score(
            docs(s, d).select("doc_id", "text"), table(s, d, "labels")
        ),
        "op5_ngram_join": lambda s, d: ngram_join.link_documents(docs(s, d)),
        "op6_quality_model": quality_model.judge_tables,
        "op7_byte_bpe": lambda s, d: byte_bpe.digest(docs(s, d), BPE_RANKS, public_tokenizers.PATTERN),
        "op8_warc": lambda s, d: warc.round_trip(table(s, d, "pages")),
        "op9_suffix_dedup": lambda s, d: suffix_dedup.digest(docs(s, d)),
        "op10_exact_dedup": lambda s, d: exact_dedup.mark_copies(docs(s, d)),
        "op11_token_files": lambda s, d: token_files.digest(docs(s, d), WORD_TOKENIZER),
        "op12_lexical_search": lambda s, d: lexical_search.rank_documents(
            docs(s, d), table(s, d, "benchmark")
        ),
        "op13_spelling": lambda s, d: spelling.digest(docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the rows of the queries that SQL can express."""
    stripped = r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"
    lowered = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    terms = rf"unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    lower = "translate(key, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return {
        "op1_line_dedup": f"""
            WITH split AS (
                SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
                FROM documents),
            stripped AS (SELECT doc_id, pos, line, {stripped} AS key FROM split),
            keyed AS (SELECT doc_id, pos, line, {lower} AS key FROM stripped),
            often AS (SELECT key FROM keyed WHERE length(key) >= 1
                      GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
            marked AS (SELECT doc_id, pos, line, key IN (SELECT key FROM often) AS gone FROM keyed)
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
            FROM marked GROUP BY doc_id""",
        "op8_warc": """
            WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
            grouped AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS original FROM payloads),
            hashed AS (SELECT page_id, html, original, sha1(html) AS hex FROM grouped),
            bits AS (SELECT page_id, html, original,
                            (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                    1 + (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::integer
                                         >> (15 - 5 * (i % 4))) % 32, 1), '' ORDER BY i)
                             FROM range(32) r(i)) AS digest FROM hashed)
            SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
                   CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN page_id <> original THEN original END AS refers_to FROM bits""",
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
                   doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW copies AS (PARTITION BY coalesce(text, ''))""",
        "op12_lexical_search": f"""
            WITH words AS (SELECT doc_id, translate({terms}, {lowered}) AS term FROM documents),
            counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
            lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
            totals AS (SELECT count(*) AS docs, sum(n)::bigint AS total FROM lengths),
            weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint AS w
                        FROM counted, totals GROUP BY term, docs),
            asked AS (SELECT DISTINCT item_id, translate({terms}, {lowered}) AS term FROM benchmark),
            scored AS (SELECT item_id, doc_id,
                              sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::bigint
                                  AS score
                       FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
                       GROUP BY item_id, doc_id)
            SELECT item_id, rank::integer AS rank, doc_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored)
            WHERE rank <= 10 AND score > 0""",
    }
