"""Text, abstracts, lists, identifiers, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import doi, orders, with_documents, work_id
from citeweave.functions import abstracts, embedding, ids, text
from citeweave.plans import features as plan
from citeweave.session import ship_package
from citeweave.sources.tables import sort_by_id, spread

CLEANED = r"trim(regexp_replace(translate(lower({0}), '()[]{{}}', '      '), '\s+', ' ', 'g'))"


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query(f"SELECT doc_id, {CLEANED.format('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(f"""
SELECT o_orderkey, {CLEANED.format("coalesce(d.source, '') || ' ' || coalesce(d.text, '')")} AS title_abstract
FROM orders LEFT JOIN documents d ON o_orderkey = d.doc_id
WHERE trim(coalesce(d.source, '') || ' ' || coalesce(d.text, '')) <> ''""")
def title_abstract(spark, sf_dir):
    works = with_documents(spark, sf_dir).select("o_orderkey", "doc_source", "text")
    return plan.add_title_abstract(works, "doc_source", "text").select("o_orderkey", "title_abstract")


@query("SELECT doc_id, text AS abstract_text FROM documents")
def deinvert_abstract(spark, sf_dir):
    indexed = spread(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", abstracts.invert_text(F.col("text")).alias("abstract_inverted_index"))
    return indexed.select("doc_id", abstracts.deinvert_abstract(
        F.col("abstract_inverted_index")).alias("abstract_text"))


@query("SELECT o_orderkey, '10.5555/' || o_orderkey AS doi FROM orders")
def normalize_doi(spark, sf_dir):
    works = orders(spark, sf_dir).select("o_orderkey", doi("o_orderkey").alias("doi"))
    return works.withColumn("doi", ids.normalize_doi(F.col("doi")))


@query("SELECT o_orderkey AS work_number, o_totalprice FROM orders")
def id_to_int(spark, sf_dir):
    works = orders(spark, sf_dir).select(work_id("o_orderkey").alias("id_OpenAlex"), "o_totalprice")
    return works.select(ids.work_number(F.col("id_OpenAlex")).alias("work_number"), "o_totalprice")


# All words of a text, cut only at quotes and backslashes, which end or escape an entry of a printed list.
ENTRY = r"[^\x00-\x20\x27\x5C]+"


def word_lists(spark, sf_dir):
    """Each document's words as a printed list."""
    words = F.regexp_extract_all("text", F.lit(ENTRY), F.lit(0))
    return documents(spark, sf_dir).select(
        "doc_id",
        F.when(F.size(words) > 0, F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']")))
        .otherwise("[]").alias("literal"))


@query(f"""
SELECT doc_id, md5(array_to_string(w, '|')) AS list_md5, w[1] AS first_entry, w[len(w)] AS last_entry
FROM (SELECT doc_id, regexp_extract_all(text, '{ENTRY}') AS w FROM documents)""")
def parse_ref_list(spark, sf_dir):
    parsed = word_lists(spark, sf_dir).select("doc_id", ids.parse_list(F.col("literal")).alias("w"))
    return parsed.select("doc_id", F.md5(F.array_join("w", "|")).alias("list_md5"),
                         F.get("w", F.lit(0)).alias("first_entry"),
                         F.try_element_at("w", F.lit(-1)).alias("last_entry"))


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{ENTRY}'))::INTEGER AS n_refs FROM documents")
def ref_count(spark, sf_dir):
    return word_lists(spark, sf_dir).select("doc_id", ids.list_length(F.col("literal")).alias("n_refs"))


HASHED = r"""
WITH words AS (
  SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents
), buckets AS (
  SELECT doc_id, (('0x' || substr(md5(word), 1, 8))::BIGINT % 384)::INTEGER AS dim, count(*)::DOUBLE AS n
  FROM words WHERE word <> '' GROUP BY 1, 2
), lengths AS (
  SELECT doc_id, sqrt(sum(n * n)) AS length FROM buckets GROUP BY 1
), hashed AS (
  SELECT doc_id, dim, (n / length)::FLOAT::DOUBLE AS weight FROM buckets JOIN lengths USING (doc_id)
)"""


def embedded(spark, sf_dir):
    ship_package(spark)
    # Sorted first: the documents lie in few files, and the encoder's work is spread with them.
    ordered = sort_by_id(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return plan.embedded(ordered, embedding.HashingEncoder, text="text").drop("text")


@query(f"{HASHED} SELECT doc_id, dim, weight FROM hashed")
def embed_text(spark, sf_dir):
    return (embedded(spark, sf_dir)
            .select("doc_id", F.posexplode("embedding").alias("dim", "weight"))
            .where("weight <> 0")
            .withColumn("weight", F.col("weight").cast("double")))


@query(f"""{HASHED}
SELECT d.doc_id, {', '.join(f"coalesce(max(weight) FILTER (dim = {i}), 0) AS embedding_{i}"
                           for i in range(embedding.EMBEDDING_WIDTH))}
FROM documents d LEFT JOIN hashed h ON d.doc_id = h.doc_id GROUP BY d.doc_id""")
def embedding_wide(spark, sf_dir):
    wide = embedding.embedding_wide(embedded(spark, sf_dir))
    return wide.selectExpr("doc_id", *[f"CAST({c} AS DOUBLE) AS {c}" for c in wide.columns[1:]])


@query("""
SELECT doc_id, (i - 1)::INTEGER AS dim, embedding[i]::DOUBLE AS weight
FROM documents LEFT JOIN (
  SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings
) ON doc_id = vec_id""")
def attach_vectors(spark, sf_dir):
    joined = embedding.attach_vectors(documents(spark, sf_dir).select("doc_id"),
                                      table(spark, sf_dir, "embeddings"), "doc_id", "vec_id")
    return (joined.select("doc_id", F.posexplode_outer("embedding").alias("dim", "weight"))
            .withColumn("weight", F.col("weight").cast("double")))
