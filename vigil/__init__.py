"""vigil: daily bank fraud detection as Spark DataFrame jobs.

Layout
------
``vigil.functions``  column-level helpers (names, amounts, time gaps, file dates)
``vigil.sources``    typed readers: delimited feeds, workbooks, feed file names, tables
``vigil.operators``  dimensions and facts, type-2 terminal history, the four fraud
                     rules, data-quality checks, report sink, skew-safe lag
``vigil.plans``      the daily job, the fixture bindings and the query catalog
``vigil.streaming``  incremental file ingest with Structured Streaming
"""

from vigil.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
