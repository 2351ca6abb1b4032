"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; `queries` has
the registered `opN_*` queries and `sql` their DuckDB restatements. Nothing
outside this folder imports it, except the entry module and the pipeline.
"""
