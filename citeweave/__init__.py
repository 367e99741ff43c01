"""Bibliographic analytics on Spark: DataFrame-to-DataFrame building blocks.

``functions``  column expressions (text, dates, ids, abstracts, embeddings)
``sources``    readers, response normalisers and writers
``operators``  joins, aggregates, graph steps, searches and summaries
``plans``      the four stages (acquire, integrate, features, describe) as whole plans
``streaming``  incremental landing with Structured Streaming
``catalog``    every registered query with its SQL counterpart
"""
