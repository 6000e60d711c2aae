"""The amount rule as a stateful stream.

Operations arrive in any order within the watermark's delay and in any cut into micro-batches.
Cards are gathered in buckets, and a bucket's time is cut into slots of at least the rule's
longest span; a state is kept per bucket and slot, so its calls do not grow with the cards. An
operation in the last span before a slot's end also goes to the next slot, as one that comes
before the operations there. When the watermark passes an operation's time, a timer puts all
operations of the slot that it has passed into the rule's order at once and judges those not
judged yet, as the batch rule's window does. When it passes the slot's end, the state is dropped.

``amount_stream`` gives one stream of rows with a ``kind``: ``hit``; ``late`` (the operation came
after its time had been judged) and ``undated`` (no time), neither of which is judged.
``write_sequence`` writes the kinds to two tables. The rows of a micro-batch go to a folder of
its number, replaced as a whole when the batch is repeated, so a restart adds nothing.

An operation is judged when the watermark passes it: the last ones of the feed wait for
later files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vigil.functions import parse_amount
from vigil.schemas import (
    AMOUNT_MAX_MINUTES,
    AMOUNT_OPER_TYPES,
    RESULT_REJECT,
    RESULT_SUCCESS,
)

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: rejected operations in a row before the success
DEPTH = 3
#: buckets of cards; a bucket's waiting operations of a slot fit a task's memory. The number is
#: part of a checkpoint: a stream goes on with the one it began with
BUCKETS = 512
_MICROS = 60_000_000
#: a slot is as long as twice the rule's longest span, and at least a day
LEAST_SLOT = 24 * 60 * _MICROS

_KEYS = ("bucket", "slot")
#: the operations of one call, as an Arrow record batch
_HELD = "operations binary"
_OPERATION = pa.schema([
    ("batch_date", pa.date32()), ("has_card", pa.bool_()), ("card", pa.string()),
    ("micros", pa.int64()), ("trans_id", pa.string()), ("amt", pa.string()),
    ("oper_result", pa.string()), ("terminal", pa.string()), ("value", pa.float64()),
    ("own", pa.bool_())])
#: the card's day, then the rule's order: time, id, amount, result, terminal, nulls first
_ORDER = [(name, "ascending") for name in _OPERATION.names[:8]]
_OUT = "kind string, batch_date date, card_num string, trans_id string, event_dt timestamp_ntz"
_EPOCH = dt.datetime(1970, 1, 1)


def slot_micros(max_minutes: int) -> int:
    return max(2 * max_minutes * _MICROS, LEAST_SLOT)


def _before(column: np.ndarray, back: int) -> np.ndarray:
    """The values ``back`` rows before each row from the DEPTH-th on."""
    return column[DEPTH - back:len(column) - back]


def hits(ops: pa.Table, max_minutes: int) -> pa.Table:
    """The operations that are a success after three rejected ones of the same card and batch
    with falling amounts, in time."""
    if len(ops) <= DEPTH:
        return ops.slice(0, 0)
    ops = ops.take(pc.sort_indices(ops, sort_keys=_ORDER, null_placement="at_start"))
    found = _before(_is(ops, RESULT_SUCCESS), 0).copy()
    rejected, value = _is(ops, RESULT_REJECT), ops["value"].to_numpy()
    for back in range(1, DEPTH + 1):
        found &= _before(rejected, back)
        found &= _before(value, back) > _before(value, back - 1)  # false beside a missing amount
    micros = ops["micros"].to_numpy()
    found &= _before(micros, 0) < _before(micros, DEPTH) + max_minutes * _MICROS
    for name in ("batch_date", "has_card", "card"):
        code = (ops[name].combine_chunks().dictionary_encode("encode").indices
                .to_numpy(zero_copy_only=False))
        found &= _before(code, 0) == _before(code, DEPTH)
    return ops.take(pa.array(np.flatnonzero(found) + DEPTH))


def _is(ops: pa.Table, result: str) -> np.ndarray:
    return pc.fill_null(pc.equal(ops["oper_result"], result), False).to_numpy()


class AmountSequence(StatefulProcessor):
    """Judges the operations of a bucket's slot in order as the watermark passes them."""

    def __init__(self, max_minutes: int = AMOUNT_MAX_MINUTES):
        self.max_minutes = max_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        self.judged = handle.getValueState("judged", "micros long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame],
                        timerValues: Any) -> Iterator[pd.DataFrame]:
        seen = timerValues.getCurrentWatermarkInMs() * 1000
        first, held = None, []
        for frame in rows:
            undated = frame["kind"] != "operation"
            late = ~undated & (frame["micros"] < seen)
            for kind, which in (("undated", undated), ("late", late)):
                aside = frame[which & frame["own"]]
                if len(aside):
                    yield _rows(kind, pa.Table.from_pandas(aside, _OPERATION, preserve_index=False))
            new = frame[~undated & ~late]
            if len(new):
                batch = pa.RecordBatch.from_pandas(new, _OPERATION, preserve_index=False)
                held.append((batch.serialize().to_pybytes(),))
                low = new["micros"][new["own"]].min() if new["own"].any() else self._end(key)
                first = int(low) if first is None else min(first, int(low))
        if held:
            self.held.appendList(held)
            self._wake(first)

    def handleExpiredTimer(self, key: Any, timerValues: Any,
                           expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = timerValues.getCurrentWatermarkInMs() * 1000
        judged = self.judged.get()[0] if self.judged.exists() else None
        if judged == due or not self.held.exists():  # by another timer of this micro-batch
            return
        ops = pa.Table.from_batches(
            [pa.ipc.read_record_batch(pa.py_buffer(x), _OPERATION) for x, in self.held.get()])
        own, micros = ops["own"], ops["micros"]
        found = hits(ops.filter(pc.less(micros, due)), self.max_minutes)
        found = found.filter(found["own"])
        if judged is not None:
            found = found.filter(pc.greater_equal(found["micros"], judged))
        if len(found):
            yield _rows("hit", found)
        if self._end(key) < due:
            self.held.clear()
            self.judged.clear()
            return
        self.judged.update((due,))
        waiting = pc.min(micros.filter(pc.and_(own, pc.greater_equal(micros, due)))).as_py()
        self._wake(self._end(key) if waiting is None else waiting)

    def _end(self, key: Any) -> int:
        return (int(key[1]) + 1) * slot_micros(self.max_minutes)

    def _wake(self, micros: int) -> None:
        """When the watermark is past this time."""
        self.handle.registerTimer(micros // 1000 + 1)

    def close(self) -> None:
        pass


def _rows(kind: str, found: pa.Table) -> pd.DataFrame:
    rows = found.to_pandas(date_as_object=True)
    dated = kind != "undated"
    return pd.DataFrame({
        "kind": pd.Series([kind] * len(rows), dtype="object"),
        "batch_date": rows["batch_date"],
        "card_num": rows["card"].where(rows["has_card"].astype(bool), None).astype("object"),
        "trans_id": rows["trans_id"].astype("object"),
        "event_dt": pd.Series([_EPOCH + dt.timedelta(microseconds=m) if dated else None
                               for m in rows["micros"].tolist()], dtype="datetime64[us]")})


def amount_stream(facts: DataFrame, *, max_minutes: int = AMOUNT_MAX_MINUTES,
                  delay: str = "1 day") -> DataFrame:
    """``kind, batch_date, card_num, trans_id, event_dt`` of a stream of fact rows."""
    spark = facts.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    slot, span = slot_micros(max_minutes), max_minutes * _MICROS
    ops = facts.filter(F.col("oper_type").isin(*AMOUNT_OPER_TYPES)).select(
        "batch_date", F.coalesce("card_num", F.lit("")).alias("card"),
        F.col("card_num").isNotNull().alias("has_card"),
        F.when(F.col("trans_date").isNull(), "undated").otherwise("operation").alias("kind"),
        F.coalesce(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                                    F.col("trans_date")), F.lit(0)).alias("micros"),
        "trans_id", "amt", "oper_result", "terminal", parse_amount("amt").alias("value"),
        F.to_timestamp_ltz(F.col("trans_date").cast("string")).alias("event_time"))
    # the watermark's column stays out of the rows: they would be dropped when late
    timed = ops.withWatermark("event_time", delay).drop("event_time")
    in_slot = F.pmod("micros", F.lit(slot))
    near_end = (F.col("kind") == "operation") & (in_slot >= slot - span)
    placed = timed.select(
        "*", F.pmod(F.xxhash64("batch_date", "has_card", "card"), F.lit(BUCKETS)).alias("bucket"),
        F.expr(f"(micros - pmod(micros, {slot}L)) div {slot}L").alias("own_slot"), F.explode(F.when(near_end, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))).alias("further"))
    placed = placed.select("*", (F.col("own_slot") + F.col("further")).alias("slot"),
                           (F.col("further") == 0).alias("own")).drop("own_slot", "further")
    return placed.groupBy(*_KEYS).transformWithStateInPandas(
        statefulProcessor=AmountSequence(max_minutes), outputStructType=_OUT,
        outputMode="Append", timeMode="EventTime")


def write_sequence(rows: DataFrame, hits: str, side: str, checkpoint: str) -> StreamingQuery:
    """Write hits and side rows (late, undated) of all files that are there, then stop."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            for path, wanted in ((hits, F.col("kind") == "hit"), (side, F.col("kind") != "hit")):
                (batch.filter(wanted).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}"))
        finally:
            batch.unpersist()

    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_OUT}, epoch int").parquet(path).drop("epoch")
