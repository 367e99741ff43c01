"""Table contracts: column names and types at each stage boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the stage tables.
RAW_WORK = T.StructType([
    T.StructField("id_OpenAlex", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("open_access", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("citation_count_OpenAlex", T.IntegerType()),
    T.StructField("cited_by_percentile_year_OpenAlex", T.DoubleType()),
    T.StructField("citation_normalized_percentile_OpenAlex", T.DoubleType()),
    T.StructField("referenced_works_OpenAlex", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract_OpenAlex", T.StringType()),
    T.StructField("topics", T.StringType()),
    T.StructField("publication_date", T.StringType()),
])

INTEGRATED_WORK = T.StructType([
    T.StructField("id_OpenAlex", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("referenced_works_OpenAlex", T.StringType()),
])

FEATURE_WORK = T.StructType([
    T.StructField("id_OpenAlex", T.LongType()),
    T.StructField("publication_date", T.DateType()),
    T.StructField("doi", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("open_access", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("citation_count_OpenAlex", T.DoubleType()),
    T.StructField("cited_by_percentile_year_OpenAlex", T.DoubleType()),
    T.StructField("citation_normalized_percentile_OpenAlex", T.DoubleType()),
    T.StructField("referenced_works_OpenAlex", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract_OpenAlex", T.StringType()),
    T.StructField("topics", T.StringType()),
    T.StructField("publication_year", T.LongType()),
    T.StructField("publication_date_int", T.LongType()),
    T.StructField("median_citation_count_year", T.DoubleType()),
    T.StructField("higher_than_median_year", T.LongType()),
    T.StructField("title_abstract", T.StringType()),
])

KNOWN_IDS = T.StructType([
    T.StructField("doi", T.StringType()),
    T.StructField("id_OpenAlex", T.StringType()),
])

# The common shape of a work that several services describe.
MERGED_WORK = T.StructType([
    T.StructField("doi", T.StringType()),
    T.StructField("id_OpenAlex", T.StringType()),
    T.StructField("s2_paper_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("citation_count", T.LongType()),
    T.StructField("reference_count", T.LongType()),
])

# Common name -> a service's own name, for the rows this package makes of its answers.
SERVICE_FIELDS = {
    "openalex": {"doi": "doi", "id_OpenAlex": "id_OpenAlex", "title": "title", "abstract": "abstract_OpenAlex",
                 "publication_date": "publication_date", "citation_count": "citation_count_OpenAlex",
                 "reference_count": "reference_count_OpenAlex"},
    "semantic_scholar": {"doi": "doi", "s2_paper_id": "s2_paper_id", "abstract": "s2_abstract",
                         "citation_count": "s2_citation_count", "reference_count": "s2_reference_count"},
    "crossref": {"doi": "doi"},
}

# One work as the API returns it.  Nested objects that later stages only carry
# along (open_access, topics) stay JSON text.
WORK_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("open_access", T.StringType()),
    T.StructField("topics", T.StringType()),
    T.StructField("cited_by_count", T.LongType()),
    T.StructField("referenced_count", T.LongType()),
    T.StructField("referenced_works", T.ArrayType(T.StringType())),
    T.StructField("publication_date", T.StringType()),
    T.StructField("publication_year", T.IntegerType()),
    T.StructField("abstract_inverted_index",
                  T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
    T.StructField("source", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("is_oa", T.BooleanType()),
    ])),
    T.StructField("locations", T.ArrayType(T.StructType([
        T.StructField("source", T.StructType([T.StructField("id", T.StringType())])),
    ]))),
])

# Response pages of the search and detail services.
CROSSREF_PAGE = T.StructType([
    T.StructField("message", T.StructType([
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("DOI", T.StringType()),
        ]))),
    ])),
])
S2_SEARCH_PAGE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("paperId", T.StringType()),
        T.StructField("externalIds", T.StructType([T.StructField("DOI", T.StringType())])),
    ]))),
])
S2_DETAIL_PAGE = T.ArrayType(T.StructType([
    T.StructField("paperId", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("referenceCount", T.LongType()),
    T.StructField("citationCount", T.LongType()),
    T.StructField("citations", T.ArrayType(T.StructType([
        T.StructField("paperId", T.StringType()),
    ]))),
]))
OPENALEX_SEARCH_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("doi", T.StringType()),
    ]))),
])
