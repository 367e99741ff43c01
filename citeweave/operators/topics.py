"""Topics of works by latent Dirichlet allocation over their words."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.sources.tables import spread, staged

# Words of the vocabulary, the most frequent ones: with the number of topics this bounds the model.
VOCABULARY = 20_000


class Topics(NamedTuple):
    # topic, place (from 0), term, weight: the terms of each topic, heaviest first.
    terms: DataFrame
    # The works' columns with topic and topic_share; null for works without a word of the vocabulary.
    works: DataFrame


def frequent_words(split: DataFrame, vocabulary: int, min_works: int) -> list[str]:
    """The ``vocabulary`` most frequent words found in at least ``min_works`` works.

    The most frequent come first, equally frequent ones by alphabet, so the same works always
    give the same numbers to words.
    """
    every = split.select(F.explode("_words").alias("term"), F.lit(1).alias("n"), F.lit(0).alias("works"))
    once = split.select(F.explode(F.array_distinct("_words")).alias("term"), F.lit(0).alias("n"), F.lit(1).alias("works"))
    counted = every.union(once).groupBy("term").agg(F.sum("n").alias("n"), F.sum("works").alias("works"))
    return [r["term"] for r in counted.where(F.col("works") >= min_works).orderBy(F.desc("n"), "term")
            .select("term").limit(vocabulary).collect()]


def find_topics(works: DataFrame, text: str = "title_abstract", topics: int = 10, vocabulary: int = VOCABULARY,
                min_works: int = 2, iterations: int = 20, terms: int = 10, seed: int = 7) -> Topics:
    """``topics`` topics of the texts and each work's main one, with a fixed seed.

    Words are runs of letters, in small letters, of three or more, English stop words left
    out.  The vocabulary is the ``vocabulary`` most frequent words found in at least
    ``min_works`` works; other words do not count.  The model, a number for each topic and word
    of the vocabulary, is held by the driver and sent to tasks: its size does not follow the
    works.  Counted words are a written table, as every iteration reads some of them; works are
    dealt out to its parts, one for each shuffle partition, by a hash of their words: samples follow the
    parts, so the topics do not depend on the files or the order that the works come in.

    A null text counts as empty.  Works without a word of the vocabulary have no topic.  Without
    any such word there are no topics at all.
    """
    words = RegexTokenizer(inputCol="_text", outputCol="_all", pattern=r"[^\p{L}]+", minTokenLength=3)
    kept = StopWordsRemover(inputCol="_all", outputCol="_words", stopWords=StopWordsRemover.loadDefaultStopWords("english"))
    split = staged(kept.transform(words.transform(
        spread(works).withColumn("_text", F.coalesce(F.col(text), F.lit(""))))).drop("_text", "_all"), "words")
    frequent = frequent_words(split, vocabulary, min_works)
    if not frequent:
        return Topics(works.sparkSession.createDataFrame([], "topic int, place int, term string, weight double"),
                      works.withColumns({"topic": F.lit(None).cast("int"), "topic_share": F.lit(None).cast("double")}))
    counter = CountVectorizerModel.from_vocabulary(frequent, inputCol="_words", outputCol="_counts")
    parts = int(works.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = staged(counter.transform(split).withColumn("_deal", F.xxhash64("_words")).drop("_words")
                     .repartition(parts, "_deal").sortWithinPartitions("_deal"), "word-counts").drop("_deal")
    model = LDA(featuresCol="_counts", topicDistributionCol="_shares", k=topics, maxIter=iterations, seed=seed,
                optimizer="online").fit(counted)
    shares = vector_to_array("_shares")
    best = F.array_max(shares)  # all shares are 0 for a work without a word of the vocabulary
    placed = model.transform(counted).withColumns({
        "topic": F.when(best > 0, F.array_position(shares, best) - 1).cast("int"),
        "topic_share": F.when(best > 0, best)}).drop("_counts", "_shares")
    named = works.sparkSession.createDataFrame(list(enumerate(frequent)), "number int, term string")
    described = model.describeTopics(terms).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    # Both sides have at most as many rows as the model has numbers.
    return Topics(described.join(named, F.col("t.termIndices") == F.col("number")).select(
        "topic", "place", "term", F.col("t.termWeights").alias("weight")), placed)
