"""Ledger analytics as Spark DataFrame operators.

Sub-packages: ``functions`` (Column expressions), ``sources`` (payloads, uploads,
incremental reads), ``operators`` (merges, star schema, reports, statements, quality),
``plans`` (views, operational surfaces, refresh, query catalogue), ``streaming``.
"""
