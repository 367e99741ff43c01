"""Registered queries of the operators, with SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.bpe import encode_documents
from citeweave.llm.centroids import cluster
from citeweave.llm.chat_pairs import neighbour_pairs, preference_turns
from citeweave.llm.exact_dedup import exact_duplicates
from citeweave.llm.fill_middle import UNIT, fill_in_middle, restored
from citeweave.llm.fingerprints import fingerprints
from citeweave.llm.language_id import identify
from citeweave.llm.line_dedup import without_repeated_lines
from citeweave.llm.lm_scoring import score_documents
from citeweave.llm.minhash_dedup import near_duplicates
from citeweave.llm.mixing import mix
from citeweave.llm.pii import pseudonymised
from citeweave.llm.token_files import documents_in, write_token_files

TOKENIZER = "word_bpe_49k.json"
# Stands for the secret that a deployment passes in.
PII_KEY = "replace-in-production"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "shards", "places")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs).select("doc_id", "_lines.n_lines", "_lines.n_dropped", "_lines.kept_sha256")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                            digests=True, written=True)


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, PII_KEY).select("doc_id", "text", F.size("_pii").alias("n_values"),
                                               F.col("_pii").alias("pseudonyms"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), written=True)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op10_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return preference_turns(turns, neighbour_pairs(turns))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_in(write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {run.__name__: run for run in (
    op1_mix_sources, op2_line_dedup, op3_bpe, op4_pii_pseudonyms, op5_lm_scores, op6_fingerprints, op7_language,
    op8_near_duplicates, op9_exact_duplicates, op10_chat_preferences, op11_fill_middle, op12_token_files,
    op13_centroids)}


def _centroid_sql(rounds: int = 10) -> str:
    """Each round as one assignment and one table of centroids; ``//`` cuts towards zero, so the rest is taken off first."""
    steps = ["""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS k, v AS c
            FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 8))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := list_sum(list_transform(
                list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, k := k)) AS best
            FROM kept, c{i} GROUP BY row)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT k, coalesce(fresh.c, old.c) AS c FROM c{i} AS old LEFT JOIN (
                SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j)::BIGINT[] AS c
                FROM (SELECT best.k AS k, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS t(j) GROUP BY ALL)
                GROUP BY k) AS fresh USING (k))""")
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, best.k AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
            (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON best.k = k"""


SQL: dict[str, str] = {
    "op2_line_dedup": rf"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        numbered AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM split),
        keyed AS (
            SELECT doc_id, i, lines[i] AS line, {_LOWER.format(
                "regexp_replace(lines[i], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} AS line_key
            FROM numbered),
        repeated AS (
            SELECT line_key, max(doc_id) AS keep_id FROM keyed WHERE length(line_key) >= 20
            GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
        judged AS (
            SELECT keyed.*, coalesce(keep_id <> doc_id, false) AS gone
            FROM keyed LEFT JOIN repeated USING (line_key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op9_exact_duplicates": f"""
        WITH n AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM n WINDOW same AS (PARTITION BY body)""",
    "op10_chat_preferences": """
        WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
        pairs AS (
            SELECT conv_id // 2 AS pair_id, min(conv_id) AS chosen_id, max(conv_id) AS rejected_id
            FROM ids GROUP BY ALL HAVING count(*) = 2),
        sides AS (
            SELECT *, 'chosen' AS side, chosen_id AS conv_id FROM pairs
            UNION ALL SELECT *, 'rejected', rejected_id FROM pairs),
        met AS (
            SELECT pair_id, chosen_id, rejected_id, side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations JOIN sides USING (conv_id)),
        at_turn AS (
            SELECT pair_id, turn,
                list_sort(list({'r': role, 't': text}) FILTER (side = 'chosen'))
                    IS DISTINCT FROM list_sort(list({'r': role, 't': text}) FILTER (side = 'rejected')) AS differs
            FROM met GROUP BY ALL),
        ends AS (SELECT pair_id, min(turn) AS prompt_end FROM at_turn WHERE differs GROUP BY ALL),
        parts AS (
            SELECT met.*, CASE WHEN prompt_end IS NULL OR turn < prompt_end THEN 'prompt' ELSE side END AS part
            FROM met LEFT JOIN ends USING (pair_id))
        SELECT pair_id, chosen_id, rejected_id, part, turn, role,
            '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered,
            CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 13 + length(role) ELSE 0 END::INTEGER AS learn_from,
            CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 23 + length(role) + length(text) ELSE 0 END::INTEGER
                AS learn_to
        FROM parts WHERE part <> 'prompt' OR side = 'chosen'""",
    "op11_fill_middle": f"""
        WITH bodies AS (
            SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
        units AS (
            SELECT *, regexp_extract_all(body, '{UNIT}') AS u, ('0x' || hex[1:8])::BIGINT AS h1,
                ('0x' || hex[9:16])::BIGINT AS h2, ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
            FROM bodies),
        cuts AS (
            SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
                greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM units),
        parts AS (
            SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
                array_to_string(u[b + 1:n], '') AS s
            FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(body) AS restored_sha256
        FROM parts""",
    "op13_centroids": _centroid_sql(),
}
