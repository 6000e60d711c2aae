"""Line deduplication across documents, built-in functions only.

The lines of every document are split and normalised once; only 16-byte digests of
the long lines move: one aggregation counts the documents per digest, one join marks
the (document, position) pairs that go, and the documents are put together again from
the runs of lines between the dropped positions.

Defined results
* text is split at ``\\n``; a null or empty text is one empty line
* a line's key is the line without white space (code points 9-13 and 32) at both ends,
  A-Z lower-cased; only keys of at least ``min_chars`` code points are judged
* a key found under at least ``min_docs`` distinct doc_ids (null is none) loses all its lines except in the row(s)
  with the largest doc_id holding it (a null doc_id is smaller than all others)
* rows of one doc_id are one document in that count; rows repeated with the same doc_id
  and text lose the same lines; an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import WHITE, ascii_lower, fixed, join_counted


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _row(docs: DataFrame) -> list[Column]:
    """A row is named by its id and a hash of its text (rows equal in both lose the
    same lines, so they may share a name)."""
    doc_id = docs["doc_id"].cast("long")
    return [doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-1)).alias("rid"),
            F.xxhash64(doc_id.isNull(), _text(docs)).alias("rhash")]


def _key(line: Column, min_chars: int) -> Column:
    key = F.btrim(line, F.lit(WHITE))
    return F.when(F.length(key) >= min_chars, F.md5(key.cast("binary")))


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per row: its lines' digests by position, null for short lines."""
    lines = F.split(ascii_lower(_text(docs)), "\n", -1)
    return docs.select(*_row(docs), F.transform(lines, lambda x: _key(x, min_chars)).alias("keys"))


def common_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """key, n_docs (distinct doc_ids), n_rows, owner (largest doc_id) of the lines found in
    many documents. Both counts combine map-side."""
    held = keys.select("doc_id", F.explode(F.array_distinct(F.array_compact("keys"))).alias("key"))
    return (held.groupBy("doc_id", F.unhex("key").alias("key"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .groupBy("key").agg(F.count("doc_id").alias("n_docs"), F.sum("n_rows").alias("n_rows"),
                                F.max("doc_id").alias("owner"))
            .filter(F.col("n_docs") >= min_docs))


def dropped_positions(keys: DataFrame, common: DataFrame) -> DataFrame:
    """rid, rhash, drops (sorted positions) of the rows that lose lines."""
    lines = (keys.select("doc_id", "rid", "rhash", F.posexplode("keys").alias("pos", "hex"))
             .filter(F.col("hex").isNotNull())
             .select("doc_id", "rid", "rhash", "pos", F.unhex("hex").alias("key")))
    hit = join_counted(lines, common, "key", "n_rows")
    return (hit.filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
            .groupBy("rid", "rhash").agg(F.sort_array(F.collect_set("pos")).alias("drops")))


def _kept(lines: Column, drops: Column) -> Column:
    """The lines outside ``drops``: the runs between them, so work is linear."""
    starts = F.concat(F.array(F.lit(0)), F.transform(drops, lambda p: p + 1))
    ends = F.concat(drops, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (of the kept lines) per row of ``docs``."""
    keys = fixed(line_keys(docs, min_chars))
    drops = dropped_positions(keys, fixed(common_lines(keys, min_docs)))
    rows = docs.select(*_row(docs), F.split(_text(docs), "\n", -1).alias("lines"))
    both = rows.join(drops, ["rid", "rhash"], "left")
    return both.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), F.lit(0)).otherwise(F.size("drops")).cast("long")
        .alias("n_dropped"),
        F.array_join(F.when(F.col("drops").isNull(), F.col("lines"))
                     .otherwise(_kept(F.col("lines"), F.col("drops"))), "\n").alias("text"))
