"""Vintages by keyed state: each key's latest value is held in the state store, so a batch costs what it holds, not its history."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AT = "__at__"  # event time in milliseconds
KINDS = ("new", "revised", "late", "settled")


class Vintages(StatefulProcessor):
    """Per key: rows in order of `seen`, each passed on if it is the first or differs from the latest by more than `tolerance`.

    A row that is no later than the latest one changes nothing. With `settle_ms`, a timer follows each change: once the
    watermark has passed its event time by that much, the key is settled, which is a row of its own; later changes are late.
    """

    def __init__(self, value: str, seen: str, tolerance: float, settle_ms: int | None, names: list[str], schema: StructType):
        self.value, self.seen, self.tolerance, self.settle_ms, self.names, self.schema = value, seen, tolerance, settle_ms, names, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.schema)  # the row passed on last, and whether it has settled

    def _row(self, row: tuple, kind: str) -> Row:
        return Row(**dict(zip(self.names, row, strict=True)), kind=kind)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.latest.get() if self.latest.exists() else None
        before = tuple(held)[:-1] if held else None
        state = held[-1] if held else None
        v, s = self.names.index(self.value), self.names.index(self.seen)
        changed = None
        columns = self.names if self.settle_ms is None else [*self.names, AT]
        for r in sorted((tuple(x[n] for n in columns) for x in rows), key=lambda x: (x[s], x[v] is not None, x[v] if x[v] is not None else 0)):
            if before is not None and r[s] <= before[s]:
                continue
            if before is not None and (r[v] == before[v] or r[v] is not None and before[v] is not None and abs(r[v] - before[v]) <= self.tolerance):
                continue
            changed = r[-1] if self.settle_ms is not None else 0
            r = r[: len(self.names)]
            yield self._row(r, "new" if before is None else "late" if state == "settled" else "revised")
            before = r
        if changed is not None:
            self.latest.update((*before, state if state == "settled" else "open"))
            if self.settle_ms is not None and state != "settled":
                for t in self.handle.listTimers():
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(changed + self.settle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.latest.exists():
            row = tuple(self.latest.get())[:-1]
            self.latest.update((*row, "settled"))
            yield self._row(row, "settled")

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: list[str], value: str, seen: str = "fetched_at", tolerance: float = 0.0, at: str | None = None, settle_ms: int | None = None, late: str = "0 seconds") -> DataFrame:
    """The rows of a stream of (keys, value, seen) that are new or revise their key, with `kind`.

    The order of arrival does not matter within a batch, nor does the cut into batches as long as no key's rows come in a
    later batch than rows seen after them. at: a timestamp column to settle keys by, `settle_ms` after that of
    their last change. Rows with a null in a key are keys of their own; rows with a null in `seen` are left out.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    names = [f.name for f in stream.schema.fields if f.name != at]
    fields = [stream.schema[n] for n in names]
    kept = StructType([StructField(f.name, f.dataType, True) for f in fields] + [StructField("state", StringType(), True)])
    out = StructType([StructField(f.name, f.dataType, True) for f in fields] + [StructField("kind", StringType(), True)])
    rows = stream.where(F.col(seen).isNotNull())
    if at:
        rows = rows.where(F.col(at).isNotNull()).withWatermark(at, late).withColumn(AT, F.unix_millis(at))
    processor = Vintages(value, seen, tolerance, settle_ms if at else None, names, kept)
    return rows.groupBy(*keys).transformWithState(statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime" if at else "None")


def keep(stream: DataFrame, path: str, checkpoint: str, keys: list[str], value: str, **options):
    """Run `changes` into a Parquet table, each change once; started again with its checkpoint, it goes on where it ended."""
    return changes(stream, keys, value, **options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
