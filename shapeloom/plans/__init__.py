"""Jobs and the registered queries over the driver's tables.

``registry.QUERIES`` maps a query name to ``(build(spark, sf_dir), oracle_sql)``;
the oracle is ANSI SQL DuckDB runs on the same parquet tables, or ``None`` for
operators SQL cannot express.
"""
