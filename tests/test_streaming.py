"""Streams that go on from their checkpoints, held against plain loops."""

from datetime import datetime, timedelta

import pytest

from tarnfold.session import shared_folder
from tarnfold.sources import store
from tarnfold.streaming.changes import changes, use_state_store
from tarnfold.streaming.follow import follow

SCHEMA = "attribute string, A double, `B.c` double"
#: Days, and rows of the snapshot of that day.
SNAPSHOTS = [
    (1, [("x", 1.0, None), ("y", 2.0, 3.0), ("z", None, None)]),
    (2, [("x", 1.0, 5.0), ("z", 1.0, None)]),
    (3, [("x", 2.0, 5.0)]),
    (6, [("x", 2.0, 5.0), ("y", 2.0, None)]),
    (8, [("x", None, 5.0), ("z", 1.0, None)]),
    (20, [("x", None, 5.0)]),
]
ABSENCE = 2


def plain():
    """By each row's snapshots in turn; what is left at the end isn't known to be gone."""
    out = []
    for attribute in "xyz":
        seen, cells = None, {}
        for day, rows in SNAPSHOTS:
            own = [r for r in rows if r[0] == attribute]
            if seen is not None and day > seen + ABSENCE:
                out += [(attribute, e, "left", str(v), None, seen + ABSENCE) for e, v in cells.items()]
                seen, cells = None, {}
            if own:
                now = {e: v for e, v in zip(("A", "B.c"), own[0][1:], strict=True) if v is not None}
                for e in now.keys() | cells.keys():
                    if now.get(e) != cells.get(e):
                        change = "appeared" if e not in cells else "left" if e not in now else "changed"
                        out.append((attribute, e, change, str(cells[e]) if e in cells else None, str(now[e]) if e in now else None, day))
                seen, cells = day, now
    return sorted(out, key=str)


def run(spark, root, out, late=timedelta(minutes=1)):
    schema = spark.createDataFrame([], SCHEMA).schema
    found = changes(follow(spark, root, schema), "attribute", ["A", "B.c"], timedelta(days=ABSENCE), late)
    stream = found.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    stream.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").selectExpr("attribute", "entity", "change", "old", "new", "day(snapshot_ts)").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("stops", [{6}, {1, 2, 3, 6, 8, 20}, {2, 8}])
def test_changes_however_the_stream_is_stopped(spark, tmp_path, stops):
    use_state_store(spark)
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert zone == "UTC"
    root, out = f"file://{tmp_path}/store", f"file://{tmp_path}/out"
    for day, rows in SNAPSHOTS:
        store.publish(spark.createDataFrame(rows, SCHEMA), root, datetime(2024, 1, day))
        if day in stops:
            run(spark, root, out)
    assert run(spark, root, out) == plain()
    # Nothing new, nothing said again.
    assert run(spark, root, out) == plain()


def test_late_snapshots(spark, tmp_path):
    use_state_store(spark)
    root, out = f"file://{tmp_path}/store", f"file://{tmp_path}/out"
    for day in (5, 4, 1):
        store.publish(spark.createDataFrame([("x", float(day), None)], SCHEMA), root, datetime(2024, 1, day))
        got = run(spark, root, out, late=timedelta(days=2))
    # The 4th is within two days of the latest, the 1st isn't.
    assert got == [("x", "A", "appeared", None, "5.0", 5), ("x", None, "late", None, None, 4)]


def test_shared_folders_are_fresh(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_late_rows_are_told(spark, tmp_path):
    from tarnfold.streaming.late import gate, gated, late_rows, on_time, sessions

    schema = spark.createDataFrame([], "id int, k string, t timestamp_ntz").schema
    folder, bound = f"file://{tmp_path}", timedelta(minutes=10)
    at = lambda minute: datetime(2024, 1, 1) + timedelta(minutes=minute)
    batches = [
        [(1, "a", at(0)), (2, "a", at(3)), (3, None, at(4)), (1, "a", at(0))],
        [(4, "a", at(30)), (5, "a", at(-7)), (6, "b", at(-5)), (2, "a", at(3))],
        # On the watermark itself, and just after it.
        [(7, "b", at(20)), (8, "b", at(20) + timedelta(seconds=1)), (9, "b", None), (4, "a", at(30))],
        [(10, "a", at(90))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/source")
        gated(spark.readStream.schema(schema).parquet(f"{folder}/source"), folder, "t", bound).trigger(availableNow=True).start().awaitTermination()
    late = sorted((r.id, r.batch, r.watermark) for r in late_rows(spark, folder, schema).collect())
    assert late == [(5, 1, at(-6)), (7, 2, at(20)), (9, 2, at(20))]

    def passed():
        return sorted(r.id for r in spark.read.schema(schema).parquet(f"{folder}/on_time").collect())

    assert passed() == [1, 1, 2, 2, 3, 4, 4, 6, 8, 10]
    # A batch that comes again says the same, whatever came after it.
    gate(folder, "t", bound)(spark.createDataFrame(batches[1], schema), 1)
    assert passed() == [1, 1, 2, 2, 3, 4, 4, 6, 8, 10] and late_rows(spark, folder, schema).count() == 3

    found = sessions(on_time(spark, folder, schema), ["k"], "t", timedelta(minutes=5), bound, ["id"])
    q = found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(((r.k, r.start, r.end, r.n) for r in spark.read.parquet(f"{folder}/out").collect()), key=str)
    want = [("a", at(0), at(8), 2), (None, at(4), at(9), 1), ("a", at(30), at(35), 1), ("b", at(-5), at(0), 1), ("b", at(20) + timedelta(seconds=1), at(25) + timedelta(seconds=1), 1)]
    assert got == sorted(want, key=str)
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 0
