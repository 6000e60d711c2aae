"""Workbook feeds (``.xlsx``): passport blacklist and terminal snapshots.

Spark has no Excel source. The files are read with the ``binaryFile`` source
(one row per workbook, split across tasks) and each workbook's first sheet is
decoded inside ``mapInPandas`` with the standard library (an xlsx file is a
zip of XML parts, read event by event). A sheet holds at most 1,048,576 rows by format, so
one task per workbook is bounded; in memory are the workbook's bytes, its distinct strings
and CHUNK_ROWS rows. The first row is the header; every value comes out
as text (numbers without a trailing ``.0`` when whole, date cells as ISO
dates) and is typed afterwards with ``try_cast``. A workbook without a needed
column fails the run; one with only a header has no rows.

Feeds larger than a sheet may come as CSV (``;``, header) or Parquet files of
the same columns and names (``passport_blacklist_DDMMYYYY.csv``); all formats
found for a day are read together.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import batch_date_of
from vigil.schemas import (
    BLACKLIST_FILE_COLUMNS,
    FEED_BLACKLIST,
    FEED_TERMINALS,
    TERMINALS_FILE_COLUMNS,
)
from vigil.sources import files

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number formats that show dates or times (ECMA-376 part 1, 18.8.30).
_DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
_EXCEL_EPOCH = dt.datetime(1899, 12, 30)
_EXCEL_EPOCH_1904 = dt.datetime(1904, 1, 1)
#: rows of a sheet handed on together
CHUNK_ROWS = 20_000


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ElementTree.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", _NS)
    rid = sheet.get(f"{{{_NS['r']}}}id")
    rels = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise ValueError("first sheet not found")


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    st = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for fmt in st.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", fmt.get("formatCode", "")).lower()
        custom[int(fmt.get("numFmtId"))] = bool(re.search(r"[dy]|h|s", code))
    out = set()
    for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMAT_IDS or custom.get(fid, False):
            out.add(i)
    return out


def _number_text(raw: str, is_date: bool, epoch: dt.datetime) -> str:
    value = float(raw)
    if is_date:
        stamp = epoch + dt.timedelta(days=value)
        if stamp.time() == dt.time(0):
            return stamp.date().isoformat()
        return stamp.replace(microsecond=0).isoformat(sep=" ")
    if value.is_integer() and abs(value) < 2 ** 53:
        return str(int(value))
    return repr(value)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    found = []
    with z.open("xl/sharedStrings.xml") as part:
        for item, parent in _elements(part, "si"):
            found.append(_text(item))
            parent.clear()
    return found


def _elements(part, name: str) -> Iterator[tuple[ElementTree.Element, ElementTree.Element]]:
    """Elements of a name as they end, with the element around them, which the caller
    clears: an XML part is never in memory as a whole."""
    above: list[ElementTree.Element] = []
    for event, node in ElementTree.iterparse(part, events=("start", "end")):
        if event == "start":
            above.append(node)
            continue
        above.pop()
        if node.tag == f"{{{_NS['m']}}}{name}":
            yield node, above[-1]


def _epoch(z: zipfile.ZipFile) -> dt.datetime:
    pr = ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
    if pr is not None and pr.get("date1904") in ("1", "true"):
        return _EXCEL_EPOCH_1904
    return _EXCEL_EPOCH


def iter_first_sheet(book: str | io.IOBase) -> Iterator[list[str | None]]:
    """Rows of the first sheet as text (None for empty cells), one at a time; the shared
    strings are all that is kept."""
    with zipfile.ZipFile(book) as z:
        shared, epoch, dates = _shared_strings(z), _epoch(z), _date_styles(z)
        with z.open(_first_sheet_path(z)) as part:
            for row, parent in _elements(part, "row"):
                values: dict[int, str | None] = {}
                for pos, c in enumerate(row.findall("m:c", _NS)):
                    ref = c.get("r")
                    values[_col_index(ref) if ref else pos] = _cell(c, shared, dates, epoch)
                yield [values.get(i) for i in range(max(values) + 1 if values else 0)]
                parent.clear()


def _cell(c: ElementTree.Element, shared: list[str], dates: set[int],
          epoch: dt.datetime) -> str | None:
    kind, v = c.get("t", "n"), c.find("m:v", _NS)
    if kind == "inlineStr":
        is_ = c.find("m:is", _NS)
        return _text(is_) if is_ is not None else None
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    if kind in ("str", "e"):
        return v.text
    return _number_text(v.text, int(c.get("s", "0")) in dates, epoch)


def read_first_sheet(content: bytes) -> list[list[str | None]]:
    """All rows of the first sheet."""
    return list(iter_first_sheet(io.BytesIO(content)))


def sheet_columns(path: str, rows: Iterator[list[str | None]],
                  columns: Sequence[str]) -> Iterator[list[list[str | None]]]:
    """The named columns of a sheet whose first row is the header, CHUNK_ROWS rows at a time
    (one list per column)."""
    header = [(h or "").strip() for h in next(rows, [])]
    if not header:
        return
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"{path}: the first sheet has no column {missing}")
    at = [header.index(name) for name in columns]
    while chunk := list(islice(rows, CHUNK_ROWS)):
        yield [[r[i] if i < len(r) else None for r in chunk] for i in at]


def _decoder(columns: Sequence[str]):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = iter_first_sheet(io.BytesIO(bytes(content)))
                for values in sheet_columns(path, rows, columns):
                    frame = pd.DataFrame(dict(zip(columns, values)), columns=list(columns))
                    frame["file_path"] = path
                    yield frame
    return decode


def read_workbooks(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                   name_glob: str = "*.xlsx") -> DataFrame:
    """Text rows of the named header columns of every workbook under ``path``
    whose name matches ``name_glob``, with ``file_path`` and the
    ``batch_date`` of its name."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField("file_path", T.StringType())])
    books = (spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
             .load(path).select("path", "content"))
    rows = books.mapInPandas(_decoder(columns), schema)
    return rows.withColumn("batch_date", batch_date_of(F.col("file_path"), in_path=True))


def read_tables(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                feed: str) -> DataFrame:
    """The named columns, as text, of a feed's workbooks, CSV and Parquet files."""
    found = [read_workbooks(spark, path, columns, f"{feed}_*.xlsx")]
    leaves = files.leaf_files(spark, path)
    for kind in ("csv", "parquet"):
        # a file of that name, or a folder of that name that a Spark job wrote
        paths = [p for p in leaves if any(fnmatch.fnmatch(part, f"{feed}_*.{kind}")
                                          for part in p.split("/")[-2:])]
        if not paths:
            continue
        reader = spark.read.option("sep", ";").option("header", True).option("escape", '"')
        # by name: an absent column fails
        raw = reader.csv(paths) if kind == "csv" else reader.parquet(*paths)
        found.append(raw.select(*[F.col(c).cast("string").alias(c) for c in columns],
                                F.col("_metadata.file_path").alias("file_path"))
                     .withColumn("batch_date", batch_date_of(F.col("file_path"), in_path=True)))
    return reduce(DataFrame.unionByName, found)


def read_blacklist(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Blacklist feed in staging shape: ``passport, date, batch_date``."""
    raw = read_tables(spark, path, BLACKLIST_FILE_COLUMNS, FEED_BLACKLIST)
    return raw.select("passport", F.col("date").try_cast("date").alias("date"), "batch_date")


def read_terminals(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Terminal snapshots: ``terminal_id, terminal_type, terminal_city,
    terminal_address, batch_date``."""
    raw = read_tables(spark, path, TERMINALS_FILE_COLUMNS, FEED_TERMINALS)
    return raw.select(*TERMINALS_FILE_COLUMNS, "batch_date")
