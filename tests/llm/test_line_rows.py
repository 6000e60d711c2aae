"""Lines of repeated doc_ids."""

from __future__ import annotations

from collections import Counter

from vigil.llm import queries


def test_repeated_rows_are_one_document(spark, tmp_path):
    a, b = ("The same very long line number %d stands in several rows of this." % n for n in (1, 2))
    rows = [(1, a)] * 4 + [(2, a)] + [(i, b) for i in range(10, 15)] + [(None, b), (None, a)] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.n_dropped) for r in queries.op4_line_dedup(
        spark, str(tmp_path)).collect())
    assert got[1, 0] == 4 and got[2, 0] == 1  # two documents hold it
    assert all(got[i, 1] == 1 for i in range(10, 14)) and got[14, 0] == 1
