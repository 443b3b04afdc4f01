"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .common import table
from .exact_dedup import exact_dedup
from .langid import fit as fit_languages
from .langid import language
from .licenses import scan_licenses
from .mixing import mix
from .preference import preference_pairs, reply_pairs
from .quality import quality_rules
from .simhash import simhash_components
from .toxicity import fit as fit_toxicity
from .toxicity import toxicity
from .warc import warc_roundtrip


#: Name of the tokenizer's vocabulary file; its folder comes from the installed vocabulary package.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(reply_pairs(table(spark, sf_dir, "conversations")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_roundtrip(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    emitted = mix(table(spark, sf_dir, "documents"))
    return emitted.select("doc_id", "source", *(c for c in emitted.columns if c.startswith("mix_")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language(docs, fit_languages(docs))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_chat_preference, op3_simhash_near_dedup, op4_warc, op5_toxicity, op6_license_scan, op7_quality_rules, op8_mixing, op9_language_id, op10_exact_dedup)}


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_chat_preference": """
        WITH u AS (SELECT conv_id AS pair_id, turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS said
                   FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
        l AS (SELECT pair_id, max(turn) AS last, arg_max(said.text, turn) AS reply FROM u WHERE said.role = 'assistant' GROUP BY pair_id),
        w AS (SELECT u.*, l.last, d.reply AS other FROM u LEFT JOIN l USING (pair_id) LEFT JOIN l d ON d.pair_id = xor(u.pair_id, 1)),
        t AS (SELECT pair_id, 'c' AS side, turn, said FROM w WHERE last IS NULL OR turn <= last
              UNION ALL
              SELECT pair_id, 'r', turn, CASE WHEN turn = last THEN {'role': 'assistant', 'text': other} ELSE said END FROM w WHERE other IS NOT NULL AND turn <= last),
        x AS (SELECT *, '<|im_start|>' || said.role || chr(10) || said.text || '<|im_end|>' || chr(10) AS whole,
                     length('<|im_start|>' || said.role) + 1 AS a, length(said.text) + 11 AS b FROM t),
        y AS (SELECT *, CASE WHEN said.role = 'assistant' THEN a || '-' || b || '+' ELSE (a + b) || '-' END AS mask FROM x),
        s AS (SELECT pair_id, min(turn) FILTER (WHERE n < 2 OR lo <> hi) AS split, bool_or(c) AS c, bool_or(r) AS r
              FROM (SELECT pair_id, turn, count(*) AS n, min(said) AS lo, max(said) AS hi, bool_or(side = 'c') AS c, bool_or(side = 'r') AS r
                    FROM t GROUP BY ALL) GROUP BY pair_id)
        SELECT pair_id,
               count(*) FILTER (WHERE side = 'c' AND (split IS NULL OR turn < split)) AS n_prompt_turns,
               coalesce(string_agg(whole, '' ORDER BY turn) FILTER (WHERE side = 'c' AND (split IS NULL OR turn < split)), '') AS prompt,
               CASE WHEN any_value(c) THEN coalesce(string_agg(whole, '' ORDER BY turn) FILTER (WHERE side = 'c' AND turn >= split), '') END AS chosen,
               CASE WHEN any_value(c) THEN coalesce(string_agg(mask, '' ORDER BY turn) FILTER (WHERE side = 'c' AND turn >= split), '') END AS chosen_mask,
               CASE WHEN any_value(r) THEN coalesce(string_agg(whole, '' ORDER BY turn) FILTER (WHERE side = 'r' AND turn >= split), '') END AS rejected,
               CASE WHEN any_value(r) THEN coalesce(string_agg(mask, '' ORDER BY turn) FILTER (WHERE side = 'r' AND turn >= split), '') END AS rejected_mask
        FROM y JOIN s USING (pair_id) GROUP BY pair_id""",
    "op4_warc": """
        WITH t AS (SELECT page_id, sha256(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n FROM pages)
        SELECT page_id, n AS payload_bytes, h AS payload_digest,
               CASE WHEN n >= 100 AND page_id > min(page_id) OVER g THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id > min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to
        FROM t WINDOW g AS (PARTITION BY h)""",
    "op10_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({LOWERED}) AS h FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, h AS text_sha256
        FROM t WINDOW g AS (PARTITION BY h)""",
}
