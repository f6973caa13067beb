"""Store, block tables and whole loads on hand-made snapshots of the rental source."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerforge.operators import checks
from layerforge.operators.calendar import calendar_dim
from layerforge.operators.lookup import overlapping_versions
from layerforge.plans import layered, star, vault
from layerforge.plans.reports import sales_by_date_star, sales_by_title_star
from layerforge.plans.sinks import StoreSink
from layerforge.session import written_once
from layerforge.sources import schemas, standins
from layerforge.sources.store import TableStore

T1, T2 = "2022-02-01", "2022-03-01"


def t(text):
    return datetime.fromisoformat(text)


def base():
    """First snapshot as plain rows."""
    d = Decimal
    old = t("2021-12-01")
    return {
        "film": [
            (i, title, "text", 2006, 1, 3, d("4.99"), 90, d("19.99"), "PG", old, ["Trailers"])
            for i, title in ((1, "STAR TURN"), (2, "RED DAWN"))
        ],
        "inventory": [(11, 1, 1, old, None), (12, 1, 1, old, None), (21, 2, 2, old, None)],
        "rental": [
            (101, t("2021-12-10"), 11, 1, None, 1, t("2021-12-10"), None),
            (102, t("2021-12-11"), 12, 2, t("2021-12-15"), 2, t("2021-12-15"), None),
            (103, t("2021-12-12"), 21, 1, None, 1, t("2021-12-12"), None),
        ],
        "payment": [
            (1001, 1, 1, 101, d("4.99"), t("2021-12-10"), t("2021-12-10"), None),
            (1002, 2, 2, 102, d("2.00"), t("2021-12-11"), t("2021-12-11"), None),
            (1003, 1, 1, 103, d("1.00"), t("2021-12-12"), t("2021-12-12"), None),
        ],
        "staff": [
            (i, name, "X", i, None, i, True, name, None, old, None, None)
            for i, name in ((1, "Mike"), (2, "Jon"))
        ],
        "store": [(1, 1, 1, old), (2, 2, 2, old)],
        "address": [(i, f"{i} Main St", None, "D", i, None, "5", old) for i in (1, 2)],
        "city": [(1, "Oslo", 7, old), (2, "Bergen", 7, old)],
    }


def changed():
    """Second snapshot: title, amount, return date, deletions, one new rental."""
    s, at, d = base(), t("2022-02-15"), Decimal
    s["film"][0] = (1, "STAR TURN 2", *s["film"][0][2:10], at, ["Trailers"])
    s["inventory"][2] = (21, 2, 2, t("2021-12-01"), at)
    s["rental"][0] = (101, t("2021-12-10"), 11, 1, at, 1, at, None)
    s["rental"].append((104, at, 12, 1, None, 1, at, None))
    s["payment"][0] = (*s["payment"][0][:4], d("3.99"), t("2021-12-10"), at, None)
    s["payment"][1] = (*s["payment"][1][:6], at, at)
    s["payment"].append((1004, 1, 1, 104, d("5.00"), at, at, None))
    s["city"][0] = (1, "Drammen", 7, at)
    return s


def tables(spark, rows):
    return {n: spark.createDataFrame(r, schemas.schema(n)) for n, r in rows.items()}


# --- store ------------------------------------------------------------------------


def test_store_shows_only_committed_loads(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = StoreSink(store, "1", T1)
    first.put("ods.film", spark.range(3))
    assert store.read("ods.film") is None
    first.commit()
    half = StoreSink(store, "2", T2)
    half.put("ods.film", spark.range(9))
    assert store.read("ods.film").count() == 3  # the second load never committed
    again = StoreSink(store, "2", T2)
    again.put("ods.film", spark.range(5))
    again.commit()
    assert store.read("ods.film").count() == 5
    assert [r["update_dt"] for r in store.log().orderBy("update_dt").collect()] == [t(T1), t(T2)]


def test_appended_rows_join_earlier_loads(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for load_id, rows in (("1", range(3)), ("2", range(3, 5)), ("2", range(3, 6))):
        sink = StoreSink(store, load_id, T1 if load_id == "1" else T2)
        known = sink.get("ref.film")
        assert known is None or known.count() == 3  # a repeated load does not see itself
        sink.append("ref.film", spark.createDataFrame([(i,) for i in rows], "nk long"))
        sink.commit()
    assert sorted(r["nk"] for r in store.read("ref.film").collect()) == list(range(6))


def test_versions_keep_rows_closed_earlier(spark, tmp_path, values):
    store = TableStore(spark, str(tmp_path))
    ddl = "id long, is_active boolean"
    for load_id, rows in (("1", [(1, True), (2, False)]), ("2", [(1, False), (3, True)])):
        sink = StoreSink(store, load_id, T1 if load_id == "1" else T2)
        sink.versions("dds.x", spark.createDataFrame(rows, ddl), "is_active")
        sink.commit()
    back = store.read("dds.x")
    assert values(back) == [(1, False), (2, False), (3, True)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load" in plan


def test_nothing_shows_before_the_commit(spark, tmp_path):
    """A load that fails between two tables, first or later, leaves the state before it."""
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(20).withColumn("is_active", F.lit(True))
    failed = StoreSink(store, "1", T1)
    failed.upsert("ods.t", rows, "id")  # and then it dies
    assert store.read("ods.t") is None
    first = StoreSink(store, "1", T1)
    first.upsert("ods.t", rows.limit(5), "id")
    first.versions("core.f", rows.limit(5), "is_active")
    first.commit()
    assert (store.read("ods.t").count(), store.read("core.f").count()) == (5, 5)
    later = StoreSink(store, "2", T2)
    later.upsert("ods.t", rows, "id")
    later.versions("core.f", rows, "is_active")
    assert (store.read("ods.t").count(), store.read("core.f").count()) == (5, 5)
    again = StoreSink(store, "2", T2)
    assert (again.get("ods.t").count(), again.get("core.f").count()) == (5, 5)
    assert again.upsert("ods.t", rows.limit(8), "id").count() == 8


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_delete_insert_writes_what_was_staged(spark, tmp_path):
    """Small loads against a model; the whole table is written again only now and then."""
    store, rnd, want = TableStore(spark, str(tmp_path)), random.Random(5), {}
    ddl, root, written = "id long, v string", tmp_path / "ods" / "t", []
    for n in range(12):
        staged = {}
        for k in range(3000) if n == 0 else rnd.sample(range(4000), 150):
            staged[k] = [(k, f"{n}-{rnd.random()}") for _ in range(2 if k % 50 == 0 else 1)]
        rows = [r for part in staged.values() for r in part]
        sink = StoreSink(store, str(n), f"2022-01-{n + 1:02d}")
        if n == 4:  # a load that dies after this table, and runs again
            sink.upsert("ods.t", spark.createDataFrame([(1, "lost")], ddl), "id")
            sink = StoreSink(store, str(n), f"2022-01-{n + 1:02d}")
        got = sink.upsert("ods.t", spark.createDataFrame(rows, ddl).coalesce(1), "id")
        sink.commit()
        want |= staged
        expected = sorted(r for part in want.values() for r in part)
        assert sorted(tuple(r) for r in got.collect()) == expected
        if n in (4, 11):
            assert sorted(tuple(r) for r in store.read("ods.t").collect()) == expected
        written.append((size_of(root / f"load={n}"), size_of(root / f"whole={n}")))
    whole = [n for n, (_, w) in enumerate(written) if w]
    assert whole == [0, 10]  # half of 3,060 rows staged since
    assert all(part * 10 < written[0][1] for part, _ in written[1:])
    assert [t.load_id for t in store.loads("ods.t")] == ["10", "11"]


def test_a_keyed_table_is_read_without_a_shuffle_of_its_whole_load(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for n, count in (("1", 5000), ("2", 10)):
        sink = StoreSink(store, n, f"2022-01-0{n}")
        sink.upsert("ods.t", spark.range(count).withColumn("v", F.lit(n)), "id")
        sink.commit()
    rows = store.read("ods.t")
    assert (rows.count(), rows.filter("v = '2'").count()) == (5000, 10)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "WindowGroupLimit" in plan


def test_marks_come_from_the_log(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert StoreSink(store, "1", T1).mark("staging.t") == t("1900-01-01")
    first = StoreSink(store, "1", T1)
    first.put("staging.t", spark.range(3))
    first.commit()
    assert StoreSink(store, "2", T2).mark("staging.t") == t(T1)
    assert StoreSink(store, "1", T1).mark("staging.t") == t("1900-01-01")  # a repeated load
    assert StoreSink(store, "2", T2).mark("staging.other") == t("1900-01-01")


# --- whole loads ------------------------------------------------------------------


@pytest.fixture
def sinks(spark, tmp_path):
    """Makes the sink of each load in turn."""
    store = TableStore(spark, str(tmp_path))
    return lambda load_id, load_ts: StoreSink(store, load_id, load_ts)


def test_layered_load(spark, sinks, values):
    first = layered.load(tables(spark, base()), sinks("1", T1), T1, "2021-01-01", 800)
    assert values(first["report.sales_by_date"]) == [
        (20211210, "10 December 2021", 4.99), (20211211, "11 December 2021", 2.0),
        (20211212, "12 December 2021", 1.0)]
    assert values(first["report.sales_by_film"]) == [
        (1, "STAR TURN", pytest.approx(6.99)), (2, "RED DAWN", 1.0)]

    second = layered.load(
        tables(spark, changed()), sinks("2", T2), T2, "2021-01-01", 800)
    film = second["dds.film"]
    assert values(film, "film_id", "title", "date_effective_from", "date_effective_to",
                  "is_active") == sorted([
        (1, "STAR TURN", "1900-01-01", "2022-02-15", False),
        (1, "STAR TURN 2", "2022-02-15", "9999-01-01", True),
        (2, "RED DAWN", "1900-01-01", "9999-01-01", True)], key=repr)
    assert values(second["ref.rental"]) == [(1, 101), (2, 102), (3, 103), (4, 104)]
    # disk 21 is deleted and payment 1002 too; the dearer payment was corrected
    assert values(second["report.sales_by_film"]) == [(1, "STAR TURN 2", pytest.approx(8.99))]
    assert second["dds.payment"].count() == 4

    for name in ("ods.payment", "ods.rental", "integ.payment", "integ.rental", "dds.payment", "dds.rental"):
        assert second[name].count() == 4  # the rows of two loads

    third = layered.load(
        tables(spark, changed()), sinks("3", "2022-04-01"), "2022-04-01", "2021-01-01", 800)
    for name in ("dds.film", "dds.city", "dds.inventory", "dds.payment", "dds.rental",
                 "report.sales_by_film"):
        assert values(third[name]) == values(second[name])  # nothing new


def rebuilt(loaded, days, values):
    """Both marts, summed up from all open payments."""
    paid = loaded["fact_payment"].filter("is_active")
    return values(sales_by_date_star(paid, days)), values(sales_by_title_star(paid, loaded["dim_inventory"]))


def test_marts_are_kept_up_from_changes(spark, sinks, values):
    days, at, d = calendar_dim(spark, "2021-01-01", 800), t("2022-03-15"), Decimal
    rows = changed()
    for n, (load_ts, source) in enumerate([(T1, base()), (T2, rows), ("2022-04-01", rows), ("2022-05-01", rows)], 1):
        if n == 3:  # other day and amount, other disk only, deleted; nothing in the fourth load
            rows["payment"][0] = (*rows["payment"][0][:4], d("9.00"), t("2021-12-25"), at, None)
            rows["rental"][3] = (104, t("2022-02-15"), 11, 1, None, 1, at, None)
            rows["payment"][2] = (*rows["payment"][2][:6], at, at)
        done = star.load(tables(spark, source), sinks(str(n), load_ts), days, load_ts)
        assert (values(done["sales_date"]), values(done["sales_film"])) == rebuilt(done, days, values)
        sums = sinks("x", "2023-01-01").get("work.payment_sums")
        assert sums.agg(F.sum(F.abs("n"))).first()[0] == {1: 3, 2: 4, 3: 5, 4: None}[n]  # open rows added or taken off


def test_star_load(spark, sinks, values):
    days = calendar_dim(spark, "2021-01-01", 800)
    first = star.load(tables(spark, base()), sinks("1", T1), days, T1)
    assert values(first["sales_film"]) == [
        ("RED DAWN", Decimal("1.00")), ("STAR TURN", Decimal("6.99"))]
    keys = values(first["fact_payment"], "payment_pk", "payment_id", "inventory_fk", "staff_fk")
    assert keys == [(1, 1001, 1, 1), (2, 1002, 2, 2), (3, 1003, 3, 1)]

    second = star.load(tables(spark, changed()), sinks("2", T2), days, T2)
    disks = values(second["dim_inventory"], "inventory_id", "title", "effective_date_from",
                   "effective_date_to", "is_active")
    assert disks == sorted([
        (11, "STAR TURN", "1900-01-01", "2022-02-15", False),
        (11, "STAR TURN 2", "2022-02-15", "9999-01-01", True),
        (12, "STAR TURN", "1900-01-01", "2022-02-15", False),
        (12, "STAR TURN 2", "2022-02-15", "9999-01-01", True),
        (21, "RED DAWN", "1900-01-01", "2022-02-15", False)], key=repr)
    paid = values(second["fact_payment"], "payment_id", "amount", "effective_date_from",
                  "effective_date_to", "is_active")
    assert paid == sorted([
        (1001, Decimal("4.99"), "1900-01-01", "2022-02-15", False),
        (1001, Decimal("3.99"), "2022-02-15", "9999-01-01", True),
        (1002, Decimal("2.00"), "1900-01-01", "2022-02-15", False),
        (1003, Decimal("1.00"), "1900-01-01", "9999-01-01", True),
        (1004, Decimal("5.00"), "1900-01-01", "9999-01-01", True)], key=repr)
    rented = values(second["fact_rental"], "rental_id", "return_date_fk", "effective_date_from",
                    "is_active")
    assert rented == sorted([
        (101, 20220215, "2021-12-10", True),  # filled in, no new version
        (102, 20211215, "2021-12-15", True), (103, None, "2021-12-12", True),
        (104, None, "2022-02-15", True)], key=repr)
    for name, pk, key in (("dim_inventory", "inventory_pk", "inventory_id"),
                          ("dim_staff", "staff_pk", "staff_id"),
                          ("fact_payment", "payment_pk", "payment_id"),
                          ("fact_rental", "rental_pk", "rental_id")):
        assert checks.duplicate_keys(second[name], [pk]).isEmpty()
        assert checks.null_counts(second[name], [pk, key]).agg(F.sum("nulls")).first()[0] == 0
        assert overlapping_versions(second[name], [key]).isEmpty()
        assert checks.duplicate_keys(second[name].filter("is_active"), [key]).isEmpty()
    for column, dim, pk in (("inventory_fk", "dim_inventory", "inventory_pk"),
                            ("staff_fk", "dim_staff", "staff_pk")):
        assert checks.orphan_keys(second["fact_payment"], column, second[dim], pk).isEmpty()


def test_star_load_closes_what_no_lookup_finds(spark, sinks, values):
    """A deletion or change ends the old fact or version though its disk, film or day is gone."""
    days = calendar_dim(spark, "2021-01-01", 800)
    star.load(tables(spark, base()), sinks("1", T1), days, T1)
    gone, at = t("2022-02-10"), t("2022-02-15")
    rows = base()
    rows["inventory"][0] = (11, 1, 1, t("2021-12-01"), gone)  # disk 11 closed before what follows
    rows["inventory"][1] = (12, 9, 1, t("2021-12-01"), at)  # deleted, and its film is unknown
    rows["inventory"][2] = (21, 9, 2, at, None)  # changed to a film that is unknown
    rows["staff"][1] = (*rows["staff"][1][:5], 9, *rows["staff"][1][6:9], at, None, None)  # no such store
    rows["payment"][0] = (*rows["payment"][0][:6], at, at)  # deleted
    rows["payment"][2] = (*rows["payment"][2][:4], Decimal("7.00"), t("1950-01-01"), at, None)  # day unknown
    rows["rental"][0] = (101, t("2021-12-10"), 11, 1, at, 2, at, None)  # other staff, disk closed
    rows["rental"][2] = (103, t("1950-01-01"), 12, 1, None, 1, t("2022-02-11"), None)  # day unknown
    done = star.load(tables(spark, rows), sinks("2", T2), days, T2)
    assert values(done["dim_inventory"], "inventory_id", "effective_date_to", "is_active") == sorted([
        (11, "2022-02-10", False), (12, "2022-02-15", False), (21, "2022-02-15", False)], key=repr)
    assert values(done["dim_staff"], "staff_id", "effective_date_to", "is_active") == sorted([
        (1, "9999-01-01", True), (2, "2022-02-15", False)], key=repr)
    assert values(done["fact_payment"], "payment_id", "effective_date_to", "is_active") == sorted([
        (1001, "2022-02-15", False), (1002, "9999-01-01", True), (1003, "2022-02-15", False)], key=repr)
    assert values(done["fact_rental"], "rental_id", "rental_date_fk", "effective_date_to", "is_active") == sorted([
        (101, 20211210, "2022-02-15", False),
        (102, 20211211, "9999-01-01", True),
        (103, 20211212, "2022-02-11", False),
        (103, None, "9999-01-01", True)], key=repr)  # after a change the day may be missing
    assert ("disks", 1, 0, 1, 0) in values(done["dropped"])
    # a third load takes only what is new
    rows["payment"].append((1005, 1, 1, 102, Decimal("3.00"), t("2022-03-10"), t("2022-03-10"), None))
    third = star.load(tables(spark, rows), sinks("3", "2022-04-01"), days, "2022-04-01")
    assert values(third["payment"], "payment_id") == [(1005,)]


def test_rows_without_a_home_come_back(spark, sinks, values):
    """What found no disk, film or day is staged again with every load until it does."""
    def load(n, rows, at):
        return star.load(tables(spark, rows), sinks(str(n), at), days, at)

    days = calendar_dim(spark, "2021-01-01", 800)
    rows, at, d = base(), t("2021-12-20"), Decimal
    disk, film = (31, 3, 1, at, None), (3, "LATE SHOW", *rows["film"][0][2:10], t("2022-03-20"), ["Trailers"])
    rows["rental"].append((105, t("2021-12-20"), 31, 1, None, 1, at, None))
    rows["payment"] += [(1005, 1, 1, 105, d("5.00"), at, at, None), (1006, 1, 1, 105, d("6.00"), at, at, None),
                        (1007, 1, 1, 105, d("7.00"), at, at, None)]
    first = load(1, rows, T1)  # neither disk 31 nor film 3 is known
    assert values(first["dropped"]) == sorted([
        ("disks", 3, 0, 0, 0), ("people", 2, 0, 0, 0), ("payments", 6, 0, 3, 0), ("rentals", 4, 0, 1, 0)])
    assert values(first["fact_payment"], "payment_id") == [(1001,), (1002,), (1003,)]
    rows["inventory"].append((*disk[:3], t("2022-02-10"), None))  # the disk comes, its film does not
    at2 = t("2022-02-15")
    rows["payment"][4] = (1006, 1, 1, 105, d("6.50"), at, at2, None)  # a newer state, still without a disk
    rows["payment"][5] = (*rows["payment"][5][:6], at2, at2)  # deleted while it waited
    second = load(2, rows, T2)
    assert values(second["dropped"]) == sorted([
        ("disks", 1, 0, 1, 0), ("people", 0, 0, 0, 0), ("payments", 2, 1, 2, 1), ("rentals", 1, 1, 1, 1)])
    rows["film"].append(film)
    third = load(3, rows, "2022-04-01")  # no staged row is new, but the film is there
    assert values(third["payment"]) == [] and values(third["inventory"]) == []
    assert values(third["dropped"]) == sorted([
        ("disks", 1, 1, 0, 0), ("people", 0, 0, 0, 0), ("payments", 2, 2, 0, 0), ("rentals", 1, 1, 0, 0)])
    paid = values(third["fact_payment"].filter("payment_id > 1003"), "payment_id", "amount", "effective_date_from", "is_active")
    assert paid == [(1005, d("5.00"), "1900-01-01", True), (1006, d("6.50"), "1900-01-01", True)]
    assert values(third["fact_rental"].filter("is_active"), "rental_id") == [(101,), (102,), (103,), (105,)]
    assert ("LATE SHOW", d("11.50")) in values(third["sales_film"])
    fourth = load(4, rows, "2022-05-01")  # nothing waits any more
    assert {r[2] for r in values(fourth["dropped"])} == {0}
    assert values(fourth["fact_payment"]) == values(third["fact_payment"])


def test_a_returned_rental_is_not_staged_again(spark, sinks, values):
    """A return date is filled in though the disk is closed; the rental took effect and waits for nothing."""
    days = calendar_dim(spark, "2021-01-01", 800)
    rows = base()
    star.load(tables(spark, rows), sinks("1", T1), days, T1)
    rows["inventory"][0] = (11, 1, 1, t("2021-12-01"), t("2022-02-10"))
    rows["rental"][0] = (101, t("2021-12-10"), 11, 1, t("2022-02-15"), 1, t("2022-02-15"), None)
    star.load(tables(spark, rows), sinks("2", T2), days, T2)
    third = star.load(tables(spark, rows), sinks("3", "2022-04-01"), days, "2022-04-01")
    assert values(third["fact_rental"].filter("rental_id = 101"), "return_date_fk", "is_active") == [(20220215, True)]


def test_a_dimension_gets_the_versions_of_touched_disks(spark, tmp_path, values):
    """Bytes written follow the disks a load touches; the rest is read from where it is."""
    days, rows, old = calendar_dim(spark, "2021-01-01", 800), base(), t("2021-12-01")
    films = [(i, f"FILM {i}", *rows["film"][0][2:]) for i in range(1, 1001)]
    rows["film"], rows["inventory"] = films, [(10 * i + n, i, 1, old, None) for i in range(1, 1001) for n in (1, 2)]
    store = TableStore(spark, str(tmp_path))
    done = star.load(tables(spark, rows), StoreSink(store, "1", T1), days, T1)
    written, numbers = {}, values(done["dim_inventory"], "inventory_id", "inventory_pk")
    for n, at, count in ((2, T2, 2), (3, "2022-04-01", 8)):
        day = t(f"2022-0{n}-15")
        rows["film"] = [(*f[:1], f"{f[1]} AGAIN", *f[2:10], day, f[11]) if f[0] <= count else f for f in rows["film"]]
        done = star.load(tables(spark, rows), StoreSink(store, str(n), at), days, at)
        load = f"{store.path('core.dim_inventory')}/load={n}"
        written[n] = spark.read.parquet(load).select("film_id").distinct().count()
        assert spark.read.parquet(load).count() <= 2 * count * 3  # two disks, at most three versions of each
    assert written == {2: 2, 3: 8}
    assert size_of(tmp_path / "core/dim_inventory/load=3") < size_of(tmp_path / "core/dim_inventory/whole=1") / 2
    disk = values(done["dim_inventory"].filter("inventory_id = 11"), "title", "effective_date_from", "is_active")
    assert disk == [("FILM 1 AGAIN AGAIN", "2022-03-15", True), ("FILM 1 AGAIN", "2022-02-15", False),
                    ("FILM 1", "1900-01-01", False)]
    assert done["dim_inventory"].count() == 2000 + 2 * 2 + 2 * 8
    assert done["dim_inventory"].select("inventory_pk").distinct().count() == 2020
    assert set(numbers) <= set(values(done["dim_inventory"], "inventory_id", "inventory_pk"))  # keys stay


def test_emptied_facts(spark, tmp_path, values):
    """Facts emptied and filled again under one commit; the next load goes on from there."""
    days, store = calendar_dim(spark, "2021-01-01", 800), TableStore(spark, str(tmp_path))
    star.load(tables(spark, base()), StoreSink(store, "1", T1), days, T1)
    rows = changed()
    star.load(tables(spark, rows), StoreSink(store, "2", T2), days, T2)
    before = values(store.read("core.fact_payment"))
    assert (1001, False) in values(store.read("core.fact_payment"), "payment_id", "is_active")
    third = "2022-04-01"
    failed = StoreSink(store, "3", third)
    failed.replace("core.fact_payment", store.read("core.fact_payment").limit(1), "is_active")  # and then it dies
    assert values(store.read("core.fact_payment")) == before
    done = star.load(tables(spark, rows), StoreSink(store, "3", third), days, third, empty_facts=True)
    paid = values(store.read("core.fact_payment"), "payment_id", "amount", "is_active")
    d = Decimal
    # one version a payment, closed where it was deleted; the first amount of 1001 is gone
    assert paid == [(1001, d("3.99"), True), (1002, d("2.00"), False), (1003, d("1.00"), True), (1004, d("5.00"), True)]
    assert values(done["sales_film"]) == rebuilt(done, days, values)[1]
    assert values(done["sales_date"]) == rebuilt(done, days, values)[0]
    rows["payment"][3] = (*rows["payment"][3][:4], d("6.00"), *rows["payment"][3][5:6], t("2022-04-10"), None)
    fourth = star.load(tables(spark, rows), StoreSink(store, "4", "2022-05-01"), days, "2022-05-01")
    paid = values(store.read("core.fact_payment"), "payment_id", "amount", "is_active")
    assert paid == [(1001, d("3.99"), True), (1002, d("2.00"), False), (1003, d("1.00"), True),
                    (1004, d("5.00"), False), (1004, d("6.00"), True)]
    assert values(fourth["sales_film"]) == rebuilt(fourth, days, values)[1]


def test_duplicate_source_key_opens_one_version(spark, sinks):
    rows = base()
    rows["city"].append((1, "Oslo again", 7, t("2021-12-05")))
    done = layered.load(tables(spark, rows), sinks("1", T1), T1, "2021-01-01", 800)
    open_ = done["dds.city"].filter("is_active")
    assert checks.duplicate_keys(open_, ["city_id"]).isEmpty()


def test_full_reload(spark, sinks, values):
    days = calendar_dim(spark, "2021-01-01", 800)
    star.load(tables(spark, base()), sinks("1", T1), days, T1)
    star.load(tables(spark, changed()), sinks("2", T2), days, T2)
    now = star.full_reload(tables(spark, changed()), sinks("3", "2022-04-01"), days)
    then = star.full_reload(tables(spark, changed()), sinks("4", "2022-05-01"), days, as_of_event=True)
    # disk 21 is closed now, but was open on the day of its payment
    assert values(now["payment"], "payment_id") == [(1001,), (1002,), (1004,)]
    assert values(then["payment"], "payment_id") == [(1001,), (1002,), (1003,), (1004,)]
    assert values(then["rental"], "rental_id", "cnt") == [(101, 1), (102, 1), (103, 1), (104, 1)]


def test_vault_load(spark, sinks, values):
    first = vault.load(tables(spark, base()), sinks("1", T1), T1, "rentals")
    assert len(first) == 8 + 9 + 22
    assert first["vault.hub_rental"].count() == 3
    assert first["vault.link_rental_staff"].count() == 3
    second = vault.load(tables(spark, changed()), sinks("2", T2), T2, "rentals")
    assert values(second["vault.hub_rental"], "rental_id", "load_date") == [
        (101, "2022-02-01"), (102, "2022-02-01"), (103, "2022-02-01"), (104, "2022-03-01")]
    titles = values(second["vault.sat_film"], "title", "load_date", "load_end_date", "is_current")
    assert titles == sorted([
        ("STAR TURN", "2022-02-01", "2022-03-01", False),
        ("STAR TURN 2", "2022-03-01", "9999-01-01", True),
        ("RED DAWN", "2022-02-01", "9999-01-01", True)], key=repr)
    assert second["vault.sat_film_mon"].count() == 2  # prices did not change
    assert values(second["vault.sat_city"].filter("is_current"), "city") == [
        ("Bergen",), ("Drammen",)]
    # disk 21 was deleted: its presence ends, its hub row stays
    assert second["vault.sat_inventory"].filter("not is_current").count() == 1
    assert second["vault.hub_inventory"].count() == 3


def test_reconciliation(spark, frame, values):
    df = frame("id int, at timestamp_ntz, is_active boolean",
               [(1, "2020-01-01", True), (2, "2020-03-01", False)])
    one = checks.reconcile_row("core", "t", df, "at", "is_active")
    assert values(one) == [("core", "t", 2, 1, "2020-01-01", "2020-03-01")]
    assert values(checks.trace_key({"a": df, "b": df.limit(0)}, "id", 1)) == [("a", 1), ("b", 0)]


def test_differing_rows(spark, values):
    """One altered amount, one missing row, one of two equal rows missing, swapped values; nulls in keys and columns."""
    ddl, d = "id long, amount decimal(8,2), note string", Decimal
    rows = [(i, d(i), None if i % 7 == 0 else f"n{i % 5}") for i in range(500)]
    twice = [(900, d(1), "a"), (900, d(2), "b"), (901, d(3), "c"), (901, d(3), "c"), (None, d(4), None)]
    left = spark.createDataFrame([*rows, *twice], ddl)
    again = spark.createDataFrame([*twice, *reversed(rows)], ddl)
    assert values(checks.differing_rows(left, again, ["id"])) == []
    other = [(i, a + 1 if i == 77 else a, n) for i, a, n in rows if i != 78]
    other += [(900, d(1), "b"), (900, d(2), "a"), (901, d(3), "c"), (None, None, "4")]
    got = checks.differing_rows(left, spark.createDataFrame(other, ddl), ["id"], buckets=64)
    assert values(got.withColumn("differing", F.concat_ws(",", "differing"))) == sorted([
        (77, 1, 1, "amount"), (78, 1, 0, ""), (900, 2, 2, ""), (901, 2, 1, ""), (None, 1, 1, "amount,note")], key=repr)
    assert values(checks.differing_rows(left, left.limit(0), ["id"]), "id") == sorted(
        [(r[0],) for r in rows] + [(900,), (901,), (None,)], key=repr)


def test_only_the_differing_bucket_is_read_again(spark, tmp_path, values):
    paths = [str(tmp_path / side) for side in ("left", "right")]
    rows = spark.range(1000).withColumn("amount", F.col("id") * 2).withColumn("cell", F.col("id") % 16)
    altered = rows.withColumn("amount", F.when(F.col("id") == 123, 0).otherwise(F.col("amount")))
    for path, df in zip(paths, (rows, altered), strict=True):
        df.write.partitionBy("cell").parquet(path)
    left, right = (spark.read.parquet(p) for p in paths)
    got = checks.differing_rows(left, right, ["id"], ["amount"], bucket="cell")
    assert values(got) == [(123, 1, 1, ["amount"])]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    read = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(read) == 2 and all("PartitionFilters: [isnotnull(cell" in x and f"= {123 % 16})" in x for x in read)


def test_source_domains(spark, values):
    rows = tables(spark, base())["film"].withColumn(
        "rating", F.when(F.col("film_id") == 1, "X").otherwise(F.lit(None))
    ).withColumn("release_year", F.col("release_year") - 200 * F.col("film_id"))
    bad = checks.domain_violations(
        rows, {"rating": checks.MPAA_RATINGS}, {"release_year": checks.YEAR_BOUNDS})
    assert values(bad, "film_id", "violated") == [
        (1, "rating"), (1, "release_year"), (2, "release_year")]


# --- what a load reads and writes once ----------------------------------------------


def test_order_lines_are_read_once_for_all_steps_of_a_load(spark, tmp_path, values):
    """Rentals and payments of a load come from lines written once, equal to those read directly."""
    rows = [  # order 1 twice with line 1, a line without order and one of an unknown order
        (1, 5, 7, 1, 2.0, 10.0, 0.1, 0.0, "A", "F", t("1996-01-01")), (1, 6, 7, 1, 3.0, 20.0, 0.0, 0.0, "N", "O", t("1996-02-01")),
        (1, 5, 8, 2, 1.0, 10.0, 0.0, 0.0, "R", "F", t("1996-01-05")), (None, 5, 8, 2, 1.0, 10.0, 0.0, 0.0, "N", "O", t("1996-01-05")),
        (9, 5, 8, 3, 1.0, 10.0, 0.0, 0.0, "N", "O", t("1996-01-05")), (2, 5, 8, None, 1.0, 10.0, 0.0, 0.0, None, "O", t("1996-01-05")),
    ]
    given = {"lineitem": rows, "orders": [(1, 11, "O", 1.0, t("1996-01-01"), "1"), (2, 12, "O", 1.0, t("1996-01-01"), "1")]}
    for name, ddl in standins.TEST_TABLES.items():
        spark.createDataFrame(given.get(name, []), ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    source = standins.source_tables(spark, str(tmp_path), "1997-01-01 00:00:00")
    for name, direct in (("rental", standins.rental), ("payment", standins.payment)):
        assert not [f for f in source[name].inputFiles() if "lineitem" in f]
        assert values(source[name]) == values(direct(spark, str(tmp_path), "1997-01-01 00:00:00"))
    assert sorted(r["units"] for r in source["payment"].collect()) == [1, 1, 3]
    plan = standins.payment(spark, str(tmp_path), "1997-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert "l_linenumber#" not in "".join(p for p in plan.splitlines() if "hashpartitioning" in p)


def test_staged_rows_are_written_again_only_with_carried_ones(spark, sinks):
    days = calendar_dim(spark, "2021-01-01", 800)
    first, second = sinks("1", T1), None
    star.load(tables(spark, base()), first, days, T1)
    assert first.get("work.staged_payment") is None and first.get("staging.payment").count() == 3
    second = sinks("2", T2)
    star.load(tables(spark, changed()), second, days, T2)
    assert second.get("work.staged_payment").count() == second.get("staging.payment").count()


def test_only_keys_found_in_vain_are_ranked(spark, values):
    ddl = "k long, last_update string, deleted string, found boolean, carried boolean"
    rows = spark.createDataFrame([
        (1, "2021", None, False, False), (1, "2022", None, True, False),  # newest found: not carried over
        (2, "2021", None, True, False), (2, "2022", None, False, False),
        (3, "2022", "2022", False, False), (None, "2022", None, False, False),
    ], ddl)
    late = star.unresolved(rows, rows, "k")
    assert values(late.select("k", "last_update")) == [(2, "2022")]
    assert late._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2


def test_finding_late_rows_shuffles_what_ranks_them(spark):
    """Of two looked-up rows of a key the newest decides; no other column of theirs is shuffled."""
    staged = spark.sql("""SELECT * FROM VALUES (1L, 7, TIMESTAMP_NTZ '2020-01-01', false),
      (1L, 8, TIMESTAMP_NTZ '2020-01-02', false), (2L, 9, TIMESTAMP_NTZ '2020-01-01', false),
      (2L, 6, TIMESTAMP_NTZ '2020-01-02', false) AS t(id, amount, last_update, carried)""").withColumn(
        "deleted", F.lit(None).cast("timestamp_ntz"))
    looked_up = staged.withColumn("found", F.col("amount").isin(7, 6))
    late = star.unresolved(staged, looked_up, "id")
    assert [(r["id"], r["amount"]) for r in late.collect()] == [(1, 8)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # As files, so that the optimizer does not fold the rows.
        given = written_once(looked_up.withColumn("note", F.lit("long text")))
        plan = star.unresolved(staged, given, "id")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "_tie" in plan and "Window [row_number() windowspecdefinition(id" in plan
    assert not [x for x in plan.splitlines() if "Window" in x and "xxhash64(id" in x and "note" in x]
