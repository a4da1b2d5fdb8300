"""What changes from snapshot to snapshot, as a stream with state.

Each row of the followed tables has state of its own: the cells that it had when
it was last seen, and when.  A later snapshot's row is held against them.  A row
that no snapshot brings again for some time has left, which a timer says, and
its state goes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.compare import named

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are milliseconds within the processor, so that no worker's time zone matters.
CHANGES = "attribute string, entity string, change string, old string, new string, at long"
#: What a row is known by: its cells, as entity and value, and its last snapshot in milliseconds.
STATE = "seen long, cells map<string,string>"


def use_state_store(spark: SparkSession) -> None:
    """Streams with timers need this session's state to be in the store that knows them."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def differences(attribute: str, old: dict[str, str], new: dict[str, str], at: int) -> Iterator[Row]:
    """A row for each cell that appeared, changed or left, by entity."""
    for entity in sorted(old.keys() | new.keys()):
        before, after = old.get(entity), new.get(entity)
        if before != after:
            change = "appeared" if before is None else "left" if after is None else "changed"
            yield Row(attribute=attribute, entity=entity, change=change, old=before, new=after, at=at)


class Differ(StatefulProcessor):
    """Holds each snapshot's row against the one before."""

    def __init__(self, absence: timedelta) -> None:
        self.absence = int(absence / timedelta(milliseconds=1))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        seen, cells = self.last.get() if self.last.exists() else (None, {})
        cells = dict(cells)
        before = seen
        # A batch may bring several snapshots, in any order.
        for at, row in sorted(((r.at, r) for r in rows), key=lambda r: r[0]):
            if seen is not None and at <= seen:
                yield Row(attribute=key[0], entity=None, change="late", old=None, new=None, at=at)
                continue
            now = dict(row.cells or {})
            if seen is not None and at > seen + self.absence:
                # It had left meanwhile, whether a timer has come to say so or not.
                yield from self.left(key[0], seen, cells)
                cells = {}
            yield from differences(key[0], cells, now, at)
            seen, cells = at, now
        if seen != before:
            if before is not None:
                self.handle.deleteTimer(before + self.absence + 1)
            self.handle.registerTimer(seen + self.absence + 1)
            self.last.update((seen, cells))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        seen, cells = self.last.get()
        self.last.clear()
        yield from self.left(key[0], seen, dict(cells))

    def left(self, attribute: str, seen: int, cells: dict[str, str]) -> Iterator[Row]:
        """All of a row's cells, as gone since ``absence`` after its last snapshot."""
        yield from differences(attribute, cells, {}, seen + self.absence)

    def close(self) -> None:
        pass


def changes(stream: DataFrame, attribute: str, entities: Sequence[str], absence: timedelta, late: timedelta = timedelta(minutes=1)) -> DataFrame:
    """Cells that appeared, changed or left in a stream of comparison tables with their ``snapshot_ts``.

    Columns: ``attribute``, ``entity``, ``change``, the ``old`` and ``new`` value
    as text, and the snapshot that has it so.  A cell is there if it isn't null.
    A row that is in no snapshot for longer than ``absence`` after its last one
    leaves, at that time, and its state with it; one that comes back appears
    again.  All this is the same however the snapshots are dealt to batches.

    A snapshot that comes after a later one of the same row changes nothing and
    is given as ``late``, without an entity, if it is no older than ``late``
    before the latest snapshot; older ones are dropped by the watermark.  Of rows
    that one snapshot has twice the first counts.  State is one entry for each
    row of the tables, dealt by ``attribute``; ``use_state_store`` comes before.
    """
    cells = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(e).alias("k"), named(e).cast("string").alias("v")) for e in entities]), lambda c: c["v"].isNotNull()))
    rows = stream.select(named(attribute).cast("string").alias("attribute"), cells.alias("cells"), F.col("snapshot_ts").cast("timestamp").alias("snapshot_ts"))
    rows = rows.withColumn("at", F.unix_millis("snapshot_ts")).withWatermark("snapshot_ts", f"{int(late / timedelta(milliseconds=1))} milliseconds")
    found = rows.groupBy("attribute").transformWithState(Differ(absence), CHANGES, "Append", "EventTime")
    return found.select("attribute", "entity", "change", "old", "new", F.timestamp_millis("at").alias("snapshot_ts"))
