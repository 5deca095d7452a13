"""Operators for building training corpora, the queries on them and their SQL.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries if it is there.
"""
