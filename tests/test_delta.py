"""Delta scans, load log, upserts, keys."""

from datetime import datetime

from pyspark.sql import functions as F

from layerforge.operators import delta as D
from layerforge.operators import keys as K
from layerforge.operators import synthetic as G

ROWS = "id int, v string, last_update timestamp_ntz, deleted timestamp_ntz"


def test_delta_scan_keeps_boundary_and_deleted(frame, values):
    src = frame(ROWS, [
        (1, "old", "2020-01-01", None), (2, "edge", "2020-02-01", None),
        (3, "gone", "2020-01-01", "2020-03-01"), (4, "gone before", "2020-01-01", "2020-01-15"),
    ])
    assert values(D.delta_scan(src, "2020-02-01"), "id") == [(2,), (3,)]
    assert values(D.delta_scan(src, "2020-02-01", strict=True), "id") == [(3,)]


def test_delta_scan_filter_reaches_the_files(spark, frame, tmp_path):
    frame(ROWS, [(1, "a", "2020-01-01", None)]).write.parquet(str(tmp_path / "t"))
    plan = D.delta_scan(spark.read.parquet(str(tmp_path / "t")), "2020-01-01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(last_update" in text


def test_joined_delta_is_the_plain_or(frame, values):
    rows = frame("id int, pid int, last_update timestamp_ntz, deleted timestamp_ntz", [
        (1, 1, "2020-03-01", None), (2, 1, "2020-01-01", None), (3, 2, "2020-01-01", None),
        (4, 2, "2020-01-01", "2020-03-01"), (5, 9, "2020-03-01", None),
    ])
    parent = frame("pid int, x string, last_update timestamp_ntz", [
        (1, "p1", "2020-01-01"), (2, "p2", "2020-02-01"),
    ])
    got = D.delta_scan_joined(rows, parent, ["pid"], "2020-02-01", ["x"])
    assert values(got, "id", "x") == [(1, "p1"), (3, "p2"), (4, "p2")]


def test_watermarks(spark, frame, values):
    log = frame("table_name string, update_dt timestamp_ntz", [
        ("a", "2020-01-01"), ("a", "2020-02-01"), ("b", "2020-03-01"),
    ])
    assert D.read_watermark(log, "a") == datetime(2020, 2, 1)
    assert D.read_watermark(log, "none") == datetime(1900, 1, 1)
    longer = D.log_load(log, ["a", "c"], "2021-01-01")
    assert D.read_watermark(longer, "c") == datetime(2021, 1, 1)
    assert values(D.previous_load_times(longer)) == [
        ("a", "2020-02-01"), ("b", None), ("c", None)
    ]
    repeated = D.log_load(longer, ["a"], "2021-01-01")
    assert ("a", "2021-01-01") in values(D.previous_load_times(repeated))


def test_delta_from_target_skips_late_rows(frame, values):
    target = frame(ROWS, [(1, "a", "2020-02-01", None)])
    src = frame(ROWS, [
        (1, "a", "2020-02-01", None), (2, "late", "2020-01-15", None),
        (3, "new", "2020-02-02", None), (4, "gone", "2020-01-01", "2020-03-01"),
    ])
    assert values(D.delta_from_target(src, target), "id") == [(3,)]
    assert values(D.delta_from_target(src, target, deleted="deleted"), "id") == [(3,), (4,)]
    assert D.delta_from_target(src, target.limit(0)).count() == 4


def test_delete_insert_twice_changes_nothing(frame, values):
    target = frame("id int, v string", [(1, "a"), (2, "b")])
    staged = frame("id int, v string", [(2, "B"), (3, "C")])
    once = D.delete_insert(target, staged, ["id"])
    assert values(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert values(D.delete_insert(once, staged, ["id"])) == values(once)


def test_upsert_removes_deleted_and_keeps_surrogates(frame, values):
    target = frame("pk int, id int, v string", [(10, 1, "a"), (11, 2, "b"), (12, 3, "c")])
    staged = frame(ROWS, [
        (1, "A", "2020-01-01", None), (2, "b", "2020-01-01", "2020-01-02"),
        (4, "d", "2020-01-01", None), (5, "e", "2020-01-01", "2020-01-02"),
    ])
    got = D.upsert(target, staged, ["id"], "deleted", keep=["pk"])
    assert values(got, "id", "pk", "v") == [(1, 10, "A"), (3, 12, "c"), (4, None, "d")]


def test_numbers_are_dense_and_ordered(spark):
    n = 50_000
    src = spark.range(n).select((F.col("id") * 7 % n).alias("nk"))
    keys = K.number_rows(src.repartition(16), ["nk"], "sk", start=100)
    row = keys.agg(
        F.count_distinct("sk"), F.min("sk"), F.max("sk"),
        F.count_if(F.col("sk") != F.col("nk") + 101),
    ).first()
    assert tuple(row) == (n, 101, 100 + n, 0)


def test_key_sync_keeps_and_extends(frame, values):
    known = frame("sk long, nk string", [(1, "b"), (2, "x")])
    src = frame("nk string, other int", [("x", 1), ("c", 2), ("a", 3), ("c", 4)])
    synced = K.assign_keys(src, known, "nk")
    assert values(synced, "nk", "sk") == [("a", 3), ("b", 1), ("c", 4), ("x", 2)]
    again = K.assign_keys(src, synced, "nk")
    assert values(again) == values(synced)


def test_composite_natural_keys(frame, values):
    empty = frame("sk long, a int, b int", [])
    src = frame("a int, b int", [(2, 1), (1, 2), (1, 1), (1, 1)])
    got = K.assign_keys(src, empty, ["a", "b"])
    assert values(got, "a", "b", "sk") == [(1, 1, 1), (1, 2, 2), (2, 1, 3)]


def test_translate_drops_and_counts_unmatched(frame, values):
    rows = frame("id long, film long, lang int", [(1, 10, 5), (2, 11, 5), (3, 99, 5)])
    ids = frame("sk long, nk long", [(101, 1), (102, 2), (103, 3)])
    films = frame("sk long, nk long", [(7, 10), (8, 11)])
    mapping = {"id": ids, "film": films}
    assert values(K.translate_keys(rows, mapping)) == [(101, 7, 5), (102, 8, 5)]
    assert values(K.count_untranslated(rows, mapping)) == [("film", 1), ("id", 0)]


def test_synthetic_rentals(frame, spark):
    rental = frame("rental_id long, rental_date timestamp_ntz", [(7, "2005-07-22 10:00:00")])
    ranges = {"inventory_id": (5, 9), "staff_id": (1, 1)}
    got = G.synthetic_rentals(rental, 200, ranges, "2020-01-01")
    row = got.agg(
        F.min("rental_id"), F.max("rental_id"), F.min("inventory_id"), F.max("inventory_id"),
        F.count_distinct("inventory_id"), F.max("staff_id"),
    ).first()
    assert tuple(row) == (8, 207, 5, 9, 5, 1)
    one = got.first()
    assert one["rental_date"] == datetime(2005, 7, 23, 10)
    assert one["return_date"] == datetime(2005, 7, 30, 10)
    given = G.synthetic_rentals(rental, 1, ranges, "2020-01-01", dt="2005-07-22").first()
    assert given["return_date"] == datetime(2005, 7, 29)
    assert got.collect() == G.synthetic_rentals(rental, 200, ranges, "2020-01-01").collect()


def test_append_rows(frame, values):
    disks = frame("id long, film long, last_update timestamp_ntz", [(4, 1, "2020-01-01")])
    wanted = frame("film long", [(1,), (2,), (3,)])
    added = K.number_rows(wanted, ["film"], "id", K.max_key(disks, "id"))
    got = D.append_rows(disks, added, "2021-05-05", "last_update")
    assert values(got) == [
        (4, 1, "2020-01-01"), (5, 1, "2021-05-05"), (6, 2, "2021-05-05"), (7, 3, "2021-05-05")
    ]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = D.latest_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted(r["id"] for r in plan.collect()) == [998, 999]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
