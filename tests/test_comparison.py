import io
import os
import subprocess
import sys
import tracemalloc
import zipfile
from datetime import UTC, date, datetime
from decimal import Decimal
from pathlib import Path
from threading import Thread

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, TimestampNTZType

import __spark_entry__ as entry
from tarnfold.functions.snapshots import snapshot_key
from tarnfold.operators.compare import compare, melt, spread
from tarnfold.plans import queries
from tarnfold.session import shared_folder
from tarnfold.sources import store
from tarnfold.sources.workbook import DAY_0_OF_1904, WorkbookSource, cast, column_index, column_name, from_workbook, sheet_rows, to_workbook
from tarnfold.streaming.follow import follow

SMALL = "/root/testdata/sf0.001"
PAIRS = st.dictionaries(st.tuples(st.sampled_from("ABC"), st.sampled_from(("x", "y", "z"))), st.floats(-9, 9), max_size=9)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PAIRS)
def test_spread_inverts_compare(spark, pairs):
    rows = [(e, a, v) for (e, a), v in pairs.items()]
    long = spark.createDataFrame(rows, "entity string, attribute string, value double")
    back = spread(compare(long, "entity", ("A", "B", "C")))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_melt_leaves_out_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 2.5)], "e string, n int, d double")
    assert sorted(map(tuple, melt(df, "e", ("n", "d")).collect())) == [("a", "n", 1.0), ("b", "d", 2.5)]
    mixed = spark.createDataFrame([("a", 1, "x")], "e string, n int, s string")
    assert sorted(map(tuple, melt(mixed, "e", ("n", "s")).collect())) == [("a", "n", "1"), ("a", "s", "x")]


def test_melt_keeps_every_digit(spark):
    big = (1 << 53) + 1
    df = spark.createDataFrame([("a.b", big, Decimal("0.10"), 1.5, True), ("c`d", None, Decimal("-2.05"), None, False)], "`e.n` string, `l.x` long, `m``y` decimal(10,2), d double, t boolean")
    rows = lambda out: sorted((*tuple(r)[:2], str(r.value)) for r in out.collect())
    assert rows(melt(df, "e.n", ["l.x"])) == [("a.b", "l.x", str(big))]
    both = melt(df, "e.n", ["l.x", "m`y"])
    assert rows(both) == [("a.b", "l.x", f"{big}.00"), ("a.b", "m`y", "0.10"), ("c`d", "m`y", "-2.05")]
    table = compare(both, "e.n", ["a.b", "c`d"])
    assert table.columns == ["attribute", "a.b", "c`d"] and rows(spread(table, "e.n")) == rows(both)
    assert melt(df, "e.n", ["l.x", "d"]).schema["value"].dataType.typeName() == "double"
    assert melt(df, "e.n", ["l.x", "t"]).schema["value"].dataType.typeName() == "string"
    wide = df.selectExpr("`e.n`", "CAST(`m``y` AS decimal(38,30)) AS m", "`l.x` AS l")
    assert melt(wide, "e.n", ["m", "l"]).schema["value"].dataType.typeName() == "string"


def test_publish_archives_and_replaces(spark, tmp_path):
    root = f"file://{tmp_path}"
    first = spark.createDataFrame([(1,)], "v int")
    store.publish(first, root, datetime(2024, 5, 6, 7, 8))
    later = datetime(2024, 5, 6, 9, 8, tzinfo=UTC)
    store.publish(store.read_latest(spark, root).selectExpr("v + 1 AS v"), root, later)
    assert [r.v for r in store.read_latest(spark, root).collect()] == [2]
    assert sorted((r.v, str(r.snapshot_ts)) for r in store.read_history(spark, root).collect()) == [(1, "2024-05-06 07:08:00"), (2, "2024-05-06 09:08:00")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.publish(first, root, later)
    assert [r.v for r in store.read_latest(spark, root).collect()] == [2]


def test_missing_result_writes_nothing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.publish_result(spark, f"file://{tmp_path}/none", f"file://{tmp_path}", datetime(2024, 1, 1))
    assert not list(tmp_path.iterdir())


class Killed(BaseException):
    """What no handler of the library may catch."""


@pytest.mark.parametrize("step", ["stage", "describe", "move", "after"])
def test_a_killed_writer_leaves_one_whole_version(spark, tmp_path, monkeypatch, step):
    root = f"file://{tmp_path}"
    first, second = (spark.createDataFrame([(i, n) for n in range(5)], "v int, n int") for i in (1, 2))
    store.publish(first, root, datetime(2024, 5, 6, 7, 8))
    before = store.read_latest(spark, root)

    def killed(*args):
        if step == "stage":
            # A part of the files is there.
            args[0].limit(1).write.parquet(f"{args[1]}/_staged/x/{args[3]}_{snapshot_key(args[2])}")
        if step == "after":
            real(*args)
        raise Killed

    name = "move" if step == "after" else step
    real = getattr(store, name)
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(store, name, killed)
        store.publish(second, root, datetime(2024, 5, 6, 7, 9))
    done = step == "after"
    want = [(1 + done, n) for n in range(5)]
    assert sorted(map(tuple, store.read_latest(spark, root).collect())) == want
    assert sorted(map(tuple, before.collect())) == [(1, n) for n in range(5)]
    assert store.read_history(spark, root).count() == 5 * (1 + done) and store.versions(spark, root) == [1, 2][: 1 + done]
    if done:
        with pytest.raises(FileExistsError):
            store.publish(second, root, datetime(2024, 5, 6, 7, 9))
    else:
        store.publish(second, root, datetime(2024, 5, 6, 7, 9))
        assert store.versions(spark, root) == [1, 2] and store.vacuum(spark, root) == 0
    assert store.vacuum(spark, root, hours=0) == 1 and store.read_latest(spark, root).count() == 5


def test_versions_of_writers_at_once(spark, tmp_path):
    root = f"file://{tmp_path}"
    lost = []

    def write(i, expected, minute):
        try:
            store.publish(spark.createDataFrame([(i,)], "v int"), root, datetime(2024, 5, 6, 7, minute), expected=expected)
        except (store.Conflict, FileExistsError) as e:
            lost.append(type(e))

    def at_once(jobs):
        threads = [Thread(target=write, args=job) for job in jobs]
        for t in threads:
            t.start()
        for t in threads:
            t.join()

    at_once([(i, 0, i) for i in range(5)])
    assert store.versions(spark, root) == [1] and lost == [store.Conflict] * 4
    # Without a version to follow all are published, one after another, but for a minute that is there.
    lost.clear()
    at_once([(10 + i, None, 30 + i // 2) for i in range(6)])
    assert store.versions(spark, root) == [1, 2, 3, 4] and lost == [FileExistsError] * 3
    assert [store.manifest(spark, root, v)["after"] for v in (1, 2, 3, 4)] == [0, 1, 2, 3]
    assert store.read_history(spark, root, 2).count() == 2 and store.read_history(spark, root).count() == 4


def test_versions_keep_their_schemas(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        store.read_latest(spark, root)
    store.publish(spark.createDataFrame([], "v int, `x.y` string"), root, datetime(2024, 5, 6, 7, 8), "a")
    store.publish(spark.createDataFrame([(1.5,)], "w double"), root, datetime(2024, 5, 6, 7, 8), "b")
    assert store.read_version(spark, root, 1).columns == ["v", "x.y"] and store.read_version(spark, root, 1).count() == 0
    assert [r.w for r in store.read_latest(spark, root).collect()] == [1.5]
    assert store.archive_path(spark, root, datetime(2024, 5, 6, 7, 8), "b").endswith("archive/000000000002/b_2024-05-06_0708")
    assert store.archive_path(spark, root, datetime(2024, 5, 6, 7, 9), "b") is None


def test_a_move_replaces_nothing(spark, tmp_path):
    # Of the local file system, and through one that isn't known to be local.
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.t.link./in", f"file://{tmp_path}")
    for root in (f"file://{tmp_path}", "viewfs://t/in"):
        (tmp_path / "a").mkdir()
        (tmp_path / "a" / "f").write_text("1")
        assert store.move(spark, f"{root}/a", f"{root}/to/b") and (tmp_path / "to" / "b" / "f").exists()
        (tmp_path / "a").mkdir()
        assert not store.move(spark, f"{root}/a", f"{root}/to/b") and sorted(x.name for x in (tmp_path / "to" / "b").iterdir()) == ["f"]
        with pytest.raises(Exception, match="none"):
            store.move(spark, f"{root}/none", f"{root}/to/c")
        (tmp_path / "a").rmdir()
        (tmp_path / "to" / "b" / "f").unlink()
        (tmp_path / "to" / "b").rmdir()


def test_a_cluster_renames_onto_nothing(spark, tmp_path):
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"file://{tmp_path}/{name}")
    for name in "abc":
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(name)
    store.rename_on_cluster(spark, path("a"), path("d"))
    assert (tmp_path / "d" / "f").read_text() == "a" and not (tmp_path / "a").exists()
    for rename in (store.rename_on_cluster, store.rename_locally):
        with pytest.raises(Exception, match="xist|mpty"):
            rename(spark, path("b"), path("c"))
        assert (tmp_path / "c" / "f").read_text() == "c" and (tmp_path / "b" / "f").exists()


def test_a_local_session_needs_no_settings(tmp_path):
    # Of a fresh process, as this one's Spark may have a folder set.
    code = (
        "import __spark_entry__ as e; from tarnfold.session import session; s = session('plain', '2', 2); "
        "assert s.conf.get('spark.checkpoint.dir', None) is None; "
        f"print('ROWS', e.queries()['published_latest'](s, '{SMALL}').count())"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).parent.parent)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "ROWS 2" in done.stdout, done.stderr[-2000:]


def test_shared_folder_needs_one_on_a_cluster():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster, "x")


def test_follow_streams_snapshots(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.createDataFrame([(1,)], "v int")
    store.publish(df, root, datetime(2024, 5, 6, 7, 8))
    q = follow(spark, root, df.schema).writeStream.format("memory").queryName("followed").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.v, str(r.snapshot_ts)) for r in spark.sql("SELECT * FROM followed").collect()] == [(1, "2024-05-06 07:08:00")]


def test_workbook_cells():
    rows = [("a<b>&\"'", 1, None), (None, 2.5, True), (" é ", float("inf"), False)]
    assert from_workbook(to_workbook(["s", "n", "f"], iter(rows))) == [["s", "n", "f"], ["a<b>&\"'", "1"], [None, "2.5", "true"], [" é ", "inf", "false"]]
    assert [column_index(column_name(i) + "7") for i in (0, 25, 26, 701, 702)] == [0, 25, 26, 701, 702]


def test_workbook_source(spark, tmp_path):
    spark.dataSource.register(WorkbookSource)
    df = spark.createDataFrame([(1, "x", 0.5), (2, None, None)], "i int, s string, d double")
    for mode in ("append", "overwrite"):
        df.coalesce(1).write.format("workbook").mode(mode).option("path", f"file://{tmp_path}/w").save()
    read = spark.read.format("workbook").option("path", f"file://{tmp_path}/w")
    assert sorted(map(tuple, read.schema(df.schema).load().collect())) == [(1, "x", 0.5), (2, None, None)]
    assert read.load().columns == ["i", "s", "d"]


def test_workbook_is_read_as_a_stream(spark, tmp_path):
    # What is held grows with a row, not with the sheet.
    def peak(n):
        book = zipfile.ZipFile(io.BytesIO(to_workbook(["i", "s"], ((i, f"text {i % 7}") for i in range(n)))))
        rows = sheet_rows(book)
        next(rows)
        tracemalloc.start()
        count = sum(1 for _ in rows)
        out = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert count == n
        return out

    assert peak(20_000) < 2 * peak(2000)


def test_workbook_leaves_no_staged_files(spark, tmp_path):
    spark.dataSource.register(WorkbookSource)
    path = tmp_path / "w"
    df = spark.range(6).repartition(3)
    df.write.format("workbook").mode("append").option("path", f"file://{path}").save()
    assert all(p.suffix == ".xlsx" for p in path.iterdir() if not p.name.endswith(".crc"))
    before = sorted(p.name for p in path.iterdir())
    broken = df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        broken.write.format("workbook").mode("overwrite").option("path", f"file://{path}").save()
    assert sorted(p.name for p in path.iterdir()) == before


def test_workbook_types(spark, tmp_path):
    spark.dataSource.register(WorkbookSource)
    schema = "l long, m decimal(20,4), day date, t timestamp_ntz, z timestamp, b boolean"
    rows = [
        (9007199254740993, Decimal("1234567890123456.7891"), date(2024, 2, 29), datetime(2024, 5, 6, 7, 8, 9, 123457), datetime(2024, 5, 6, 7, 8, tzinfo=UTC), True),
        (-(2**63), Decimal("-0.0001"), date(1950, 1, 1), datetime(1999, 12, 31, 23, 59, 59, 999999), None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.format("workbook").mode("append").option("path", f"file://{tmp_path}/w").save()
    back = spark.read.format("workbook").schema(df.schema).option("path", f"file://{tmp_path}/w").load()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    for other in ("a array<int>", "m map<string,int>", "x binary"):
        with pytest.raises(Exception, match="can't hold"):
            spark.read.format("workbook").schema(other).option("path", f"file://{tmp_path}/w").load().collect()


def test_workbook_cells_of_other_programs():
    field = lambda kind: StructField("f", kind)
    assert cast("45000", field(DateType())) == date(2023, 3, 15) and cast("43538", field(DateType()), DAY_0_OF_1904) == date(2023, 3, 15)
    assert cast("2024-01-02", field(DateType())) == date(2024, 1, 2) and cast("45000.5", field(TimestampNTZType())) == datetime(2023, 3, 15, 12)
    assert cast("1E3", field(LongType())) == 1000 and cast(" ", field(LongType())) is None and cast("", field(StringType())) == ""
    with pytest.raises(ValueError, match="no whole number"):
        cast("1.5", field(LongType()))


def test_entry_and_queries(spark):
    assert entry.entry(spark).count() == 2
    assert set(queries.ORACLE_SQL) == set(queries.QUERIES)
    assert all(isinstance(c, str) for c in entry.oracle_sql().values())
    for query in queries.QUERIES.values():
        assert query(spark, SMALL).count() > 0
