"""The checkpoint folder comes from the session."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerforge import session
from layerforge.plans import steps
from layerforge.plans.steps import side_by_side
from layerforge.session import written_once
from layerforge.sources.store import APPEND, VERSIONS, Loaded, TableStore


class _Context:
    def __init__(self, master, conf, current=None):
        self.master, self._conf, self.current = master, conf, current

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, context, conf):
        self.sparkContext, self.conf = context, conf


class _Conf(dict):
    pass


def made(master, named=None, current=None):
    conf = _Conf({"spark.checkpoint.dir": named} if named else {})
    return _Session(_Context(master, conf, current), conf)


def test_named_folder_is_used():
    s = made("spark://host:7077", named="hdfs://shared/cp")
    assert session.checkpoint_dir(s) == "hdfs://shared/cp"
    assert s.sparkContext.current == "hdfs://shared/cp"


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(made("spark://host:7077"))


def test_folder_set_on_the_context_is_kept():
    s = made("spark://host:7077", current="hdfs://shared/other")
    assert session.checkpoint_dir(s) == "hdfs://shared/other"


def test_steps_done_leave_no_shuffle_files(spark, tmp_path):
    """The files of a step's plan go when the step is done, not when the driver's memory is full."""
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(f) for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}

    before, seen = files(), set()

    def step(name):
        spark.range(100_000).repartition(5).write.parquet(f"{tmp_path}/{name}")
        seen.update(files() - before)
        return spark.read.parquet(f"{tmp_path}/{name}")

    side_by_side(["a", "b"], step)
    assert seen
    until = time.time() + 30
    while files() & seen and time.time() < until:
        time.sleep(0.5)
    assert not files() & seen


def test_files_of_loads_are_zstd(spark):
    rows = written_once(spark.range(10))
    assert all(".zstd." in f for f in rows.inputFiles())


def test_a_step_lets_go_before_the_last_one_ends(spark, tmp_path, monkeypatch):
    """Two steps are at work at once, and what one leaves goes while others still wait."""
    monkeypatch.setattr(steps, "FREE_EVERY", 0.0)
    at_work, most, freed, after = [], [], [], []
    monkeypatch.setattr(steps, "free_shuffles", lambda s: freed.append(len(after)))

    def step(name):
        at_work.append(name)
        most.append(len(at_work))
        time.sleep(0.05)
        after.append(at_work.pop())
        return spark.range(1)

    assert list(side_by_side("abcdefgh", step)) == list("abcdefgh")
    assert max(most) <= 2 and freed[0] < 8 and len(freed) == 9


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    """Sorted keys shrink to a tenth in a file: the size check goes by the rows."""
    store = TableStore(spark, str(tmp_path / "store"))
    keys = spark.range(0, 100_000, 1, 1).select(F.col("id").alias("nk"), (F.col("id") + 1).alias("sk"))
    store.write("ref.keys", keys, "1")
    known = spark.read.schema(keys.schema).parquet(store.path("ref.keys", "load=1"))
    files = sum(os.path.getsize(f.removeprefix("file://")) for f in known.inputFiles())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(files * 2))
    try:
        many = spark.range(0, 10**9, 1, 4).withColumnRenamed("id", "nk")
        plan = many.join(known, "nk")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in plan


def test_a_table_of_several_loads_is_one_scan(spark, tmp_path, monkeypatch):
    """Loads are named in the scan; many of them are joined, with the same rows."""
    root, rows = str(tmp_path / "store"), StructType.fromDDL("k long, is_active boolean")
    store = TableStore(spark, root)
    for n in (1, 2, 3):
        store.write("a.keys", spark.createDataFrame([(n, True)], rows), str(n))
        store.write("a.hist", spark.createDataFrame([(n, True), (-n, False), (9 + n, None)], rows), str(n), ("is_active",))
        if n != 2:  # a load that died before its commit
            store.commit({"a.keys": Loaded(str(n), APPEND, rows), "a.hist": Loaded(str(n), VERSIONS, rows, "is_active")}, f"2024-01-0{n}")

    def read():
        return {name: sorted(r.k for r in store.read(name).collect()) for name in ("a.keys", "a.hist")}

    plan = store.read("a.hist")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    named = read()
    assert named == {"a.keys": [1, 3], "a.hist": [-3, -1, 3, 12]}
    monkeypatch.setattr("layerforge.sources.store.NAMED_LOADS", 1)
    assert read() == named
