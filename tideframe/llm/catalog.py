"""Registered queries of the training-data operators, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm import alignment, bpe, chat, collocations, decontaminate, exactdedup, fingerprint, html, licenses, linededup, neardup, secrets, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    marked = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    return chat.chat_digests(chat.read_chats(chat.format_chats(turns)))


ORACLE["op1_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?INST\]|/?s>|</?SYS>>)', '\1\\\2\3', 'g') AS escaped,
         CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) THEN 0 ELSE 1 END AS opens
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(length(escaped)) + sum(CASE WHEN opens = 1
            THEN length('<|turn|>' || role || chr(10) || '<|end|>' || chr(10))
                 + CASE WHEN role = 'assistant' THEN length('<|loss|><|/loss|>') ELSE 0 END
            ELSE length('<|part|>') END))::BIGINT AS formatted_chars,
       sum(opens)::BIGINT AS n_messages
FROM marked GROUP BY conv_id
"""


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as tokens of the public byte-level vocabulary, and back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the score of the convolutional classifier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(~toxicity.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.secret_digests(secrets.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of exact and near copies."""
    return neardup.duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the stretch."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose templates recur in earlier documents."""
    kept = linededup.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("kept_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its edited text, with their fingerprints and likenesses."""
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return html.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses that it or its lines are."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _canonical_sql(text: str) -> str:
    plain = f"regexp_replace(lower(regexp_replace({text}, '{licenses.COPYRIGHT}', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')"
    for found, put in licenses.SPELLINGS:
        plain = f"replace({plain}, '{found}', '{put}')"
    return f"md5(trim({plain}))"


_KNOWN_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in licenses.KNOWN)
ORACLE["op2_license_scan"] = f"""
WITH known AS (
  SELECT {_canonical_sql("text")} AS digest, min(license) AS license FROM (VALUES {_KNOWN_ROWS}) t(license, text) GROUP BY 1
), units AS (
  SELECT doc_id, TRUE AS whole, coalesce(text, '') AS unit FROM documents
  UNION ALL SELECT doc_id, FALSE, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
), found AS (
  SELECT doc_id, max(license) FILTER (whole) AS text_license,
         coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (NOT whole), '') AS licenses, count(*) FILTER (NOT whole) AS n_lines
  FROM units JOIN known ON {_canonical_sql("unit")} = digest GROUP BY doc_id
)
SELECT d.doc_id, text_license, coalesce(licenses, '') AS licenses, coalesce(n_lines, 0) AS n_lines
FROM documents d LEFT JOIN found USING (doc_id)
"""


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the groups and links of two public tokenizers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(docs, *paths, keep_text=False)


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    found = exactdedup.duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), every_digest=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op12_exact_dedup"] = """
WITH digested AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), grouped AS (
  SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM digested
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language whose words keep together most."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (VALUES (1), (2), (3), (4), (5)) s(k)
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM placed GROUP BY ALL HAVING count(*) >= 100
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, n, x.cut, h.a AS l, t.a AS r, ((1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM f c JOIN sizes USING (lang) JOIN (VALUES (1), (2), (3), (4)) x(cut) ON x.cut < c.k
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(string_split(c.phrase, ' ')[1:x.cut], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(string_split(c.phrase, ' ')[x.cut + 1:], ' ')
), least AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM least c WHERE NOT EXISTS (
    SELECT 1 FROM f b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
