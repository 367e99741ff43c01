"""Response pages of the search and detail services as rows.

Each page is one JSON text, bounded by the service's page size, so exploding it
never leaves the task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.schemas import (
    CROSSREF_PAGE,
    OPENALEX_SEARCH_PAGE,
    S2_DETAIL_PAGE,
    S2_SEARCH_PAGE,
)


def crossref_dois(pages: DataFrame, body: str = "body") -> DataFrame:
    items = F.from_json(body, CROSSREF_PAGE)["message"]["items"]
    return pages.select(F.explode(items).alias("item")).select(F.col("item.DOI").alias("doi"))


def s2_search_hits(pages: DataFrame, body: str = "body") -> DataFrame:
    papers = F.from_json(body, S2_SEARCH_PAGE)["data"]
    return pages.select(F.explode(papers).alias("paper")).select(
        F.col("paper.paperId").alias("s2_paper_id"),
        F.col("paper.externalIds.DOI").alias("doi"),
    )


def s2_details(pages: DataFrame, body: str = "body", order: str | Column = "page_no") -> DataFrame:
    """Details per paper; entries the service did not find are skipped.

    Of several entries for one paper the last stays (by page, then place).
    """
    order = F.col(order) if isinstance(order, str) else order
    entries = (pages
               .select(order.alias("page"), F.posexplode(F.from_json(body, S2_DETAIL_PAGE))
                       .alias("place", "paper"))
               .where(F.col("paper.paperId").isNotNull()))
    last = W.partitionBy("s2_paper_id").orderBy(F.desc("page"), F.desc("place"))
    citing = F.coalesce(F.col("paper.citations"),
                        F.array().cast("array<struct<paperId:string>>"))
    return (entries
            .select("page", "place",
                    F.col("paper.paperId").alias("s2_paper_id"),
                    F.col("paper.abstract").alias("s2_abstract"),
                    F.col("paper.referenceCount").alias("s2_reference_count"),
                    F.col("paper.citationCount").alias("s2_citation_count"),
                    F.transform(citing, lambda c: c["paperId"]).alias("s2_citing_papers"))
            .withColumn("nth", F.row_number().over(last))
            .where("nth = 1")
            .drop("page", "place", "nth"))


def openalex_search_hits(pages: DataFrame, body: str = "body") -> DataFrame:
    hits = F.from_json(body, OPENALEX_SEARCH_PAGE)["results"]
    return pages.select(F.explode(hits).alias("work")).select(
        F.col("work.id").alias("id_OpenAlex"),
        F.col("work.doi").alias("doi"),
    )
