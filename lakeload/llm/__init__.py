"""Operators for large-scale training-data pipelines (fingerprints, sharding, dedup, scans, mixing, tokens).

Each module holds one operator over DataFrames and its thin ``opN_*`` query; ``registry`` lists the
queries and their SQL. Nothing outside this folder imports it.
"""
