"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (alignment, conversations, decontaminate, fingerprint, langid, line_dedup, lm, mixing, quality, simhash_dedup,
               token_counts, toxicity, warc)
from .common import fold, table


def op1_quality(spark, sf_dir):
    """Operator 1: quality of every document; learns labels from ids whose crc32 modulo 5 is not 0."""
    held = fold("doc_id", 5) == 0
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held, held)


def op2_token_counts(spark, sf_dir):
    """Operator 2: tokens of every document, by a scan of the token files written from them."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark, sf_dir):
    """Operator 3: fingerprint and near-duplicate class of every document."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark, sf_dir):
    """Operator 4: fingerprints, likenesses, and for every 20th id the documents within the radius."""
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_language(spark, sf_dir):
    """Operator 5: language of every document; learns from ids whose crc32 modulo 4 is not 2."""
    held = fold("doc_id", 4) == 2
    return langid.predict_language(table(spark, sf_dir, "documents"), ~held, held)


def op6_decontaminate(spark, sf_dir):
    """Operator 6: every benchmark item that a document holds."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark, sf_dir):
    """Operator 7: toxicity of every document; learns labels from ids whose crc32 modulo 3 is not 1."""
    held = fold("doc_id", 3) == 1
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held, held)


def op8_line_dedup(spark, sf_dir):
    """Operator 8: every document without the lines that repeat, and which lines stay for them."""
    return line_dedup.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_lm_score(spark, sf_dir):
    """Operator 9: lattice and base scores; learns from ids whose crc32 modulo 10 is not 0."""
    held = fold("doc_id", 10) == 0
    return lm.score_documents(table(spark, sf_dir, "documents"), ~held, held)


def op10_source_mix(spark, sf_dir):
    """Operator 10: words the mix takes of every document."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_token_alignment(spark, sf_dir):
    """Operator 11: groups and links of two tokenizers' tokens in every document."""
    found = alignment.align_corpus(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.coalesce("groups", F.lit("")).alias("groups_sha256"))


def op12_conversation_repair(spark, sf_dir):
    """Operator 12: faults planted in every conversation, and the cheapest repair."""
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(damaged, present=F.col("kept")))


def op13_warc(spark, sf_dir):
    """Operator 13: every page through WARC archives and their merged index; captured a second apart by page id."""
    at = F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10 ** 9))
    return warc.archive_pages(table(spark, sf_dir, "pages"), at=at)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_language": op5_language,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_line_dedup": op8_line_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_source_mix": op10_source_mix,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_warc": op13_warc,
}

_FOLD_CASE = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD_CASE}, '[^\x20\x09-\x0D]+')"


def _shingles(table_: str, id_col: str) -> str:
    """Distinct five-word shingles of every row."""
    return f"""
    SELECT DISTINCT {id_col}, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT {id_col}, w, unnest(range(1, len(w) - 3)) AS i
          FROM (SELECT {id_col}, {_WORDS} AS w FROM {table_}) WHERE len(w) >= 5)"""


ORACLE_SQL: dict[str, str] = {
    "op6_decontaminate": f"""
WITH i AS ({_shingles("benchmark", "item_id")}),
     n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id),
     d AS ({_shingles("documents", "doc_id")}),
     m AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles::DOUBLE AS containment
FROM m JOIN n USING (item_id)
WHERE shared >= ceil(0.8 * item_shingles - 1e-9)""",
}
