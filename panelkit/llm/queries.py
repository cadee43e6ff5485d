"""The queries of the operators on the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (
    bradley_terry, chat, decontaminate, mixing, nn_descent, partenum, patience, shards, skip_chain, token_alignment,
    token_counts, warc, whitening,
)
from panelkit.llm.common import table
from panelkit.runtime import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register ``run`` under its name; the workers of its session can import this package."""

    @wraps(run)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return token_counts.document_counts(table(spark, folder, "documents"), "doc_id", "text").select("doc_id", "n_tokens")


@query
def op2_partenum_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near copies by Jaccard similarity."""
    found = partenum.jaccard_components(table(spark, folder, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op3_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    plan = mixing.copies(table(spark, folder, "documents"), "doc_id", "text", "source")
    return mixing.taken(plan).withColumnRenamed("id", "doc_id")


@query
def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages, read back from deduplicated archives."""
    return warc.resolved(table(spark, folder, "pages"))


@query
def op5_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors of equal labels."""
    return nn_descent.near_duplicates(table(spark, folder, "embeddings"))


@query
def op6_chat_template(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of control strings, read back from their formatted text."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.formatted(turns.unionByName(probe)))


@query
def op7_bradley_terry(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    return bradley_terry.scores(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id", "text", "quality")


@query
def op8_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that share a passage with a benchmark item, and the passage."""
    return decontaminate.overlaps(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text", "item_id", "text"
    )


@query
def op9_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, read back from the shards."""
    docs = shards.shards(table(spark, folder, "documents"), "doc_id", "text", 16)
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_patience_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices and texts in all documents."""
    return patience.licenses(table(spark, folder, "documents"), "doc_id", "text")


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings, whitened by the refined eigenvectors of their covariance."""
    return whitening.components(table(spark, folder, "embeddings"), "vec_id", "embedding")


@query
def op12_run_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """Token groups and links of two vocabularies in all documents."""
    return token_alignment.alignments(table(spark, folder, "documents"), "doc_id", "text")


@query
def op13_skip_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    return skip_chain.personal_data(table(spark, folder, "documents"), "doc_id", "text")


_CONTROLS = "|".join("".join("\\" + c if c in "\\|[]<>/()" and c not in "<>/" else c for c in s) for s in (*chat.CONTROLS, chat.SIGN))
_MARKS = len(chat.START) + len(chat.MIDDLE) + len(chat.END) + 1
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, {5 * half + 1}, 5))::BIGINT >> {15 - 5 * k}) & 31)::INT + 1, 1)"
    for half in range(8)
    for k in range(4)
)

ORACLES: dict[str, str] = {
    "op2_partenum_join": r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q USING (sh) WHERE p.doc_id <> q.doc_id GROUP BY ALL) x
  JOIN n m ON m.doc_id = x.a JOIN n o ON o.doc_id = x.b WHERE 100 * c >= 75 * (m.n + o.n - c)
), r AS (
  SELECT doc_id AS id, doc_id AS node FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.node
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(node) AS component_id FROM r GROUP BY id) c ON c.id = w.doc_id""",
    "op4_warc_revisits": f"""
SELECT page_id, bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS hex,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)""",
    "op5_nn_descent": """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
g AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (SELECT vec_id AS id, vec_id AS node FROM v UNION SELECT r.id, g.b FROM r JOIN g ON g.a = r.node)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM g GROUP BY a) d ON d.a = v.vec_id
JOIN (SELECT id, min(node) AS component_id FROM r GROUP BY id) c ON c.id = v.vec_id""",
    "op6_chat_template": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum({_MARKS} + length(role) + length(text) + len(regexp_extract_all(role || chr(0) || text, '{_CONTROLS}')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
}
