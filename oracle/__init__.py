"""DuckDB oracle SQL: the fixture mapping and the model chain as plain SQL CTEs.

Independent of the Spark code path; used by ``__spark_entry__.oracle_sql`` and by
``tools/check_oracle.py``.
"""
