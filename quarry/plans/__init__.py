"""The registered queries (``queries``), their DuckDB oracle SQL (``oracle``),
the name catalog used by ``__spark_entry__`` (``catalog``) and file-based jobs
with the original parameters (``jobs``)."""
