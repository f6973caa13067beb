"""Merges case by case, against a plain Python model, and their invariants."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerforge.operators import history as H
from layerforge.operators import lookup as L
from layerforge.plans import star

SRC = "id int, v string, w string, last_update timestamp_ntz, deleted timestamp_ntz"
HASH = H.Rule(change="hash", tracked=["v", "w"])
TRACKED = H.Rule(change="tracked", tracked=["v"], snapshot=False)
OUT = ["id", "v", "w", "effective_date_from", "effective_date_to", "is_active"]
LO, HI = "1900-01-01", "9999-01-01"


def start(frame, hashed=True):
    empty = H.add_history_columns(frame("id int, v string, w string", []))
    return empty.withColumn("hash", F.lit("")) if hashed else empty


def test_hash_merge_cases(frame, values):
    first = frame(SRC, [
        (1, "a", None, "2020-01-01", None), (2, "b", None, "2020-01-01", None),
        (3, "c", None, "2020-01-01", None), (4, "d", None, "2020-01-01", "2020-01-05"),
        (5, "e", None, "2020-01-01", None),
    ])
    one = H.scd2_merge(start(frame), first, ["id"], HASH, "2020-02-01")
    assert (4, "d", None, LO, "2020-01-05", False) in values(one, *OUT)
    second = frame(SRC, [
        (1, "a", None, "2020-02-20", None),           # only the stamp moved
        (2, None, "b", "2020-02-21", None),           # changed
        (5, "e", None, "2020-01-01", "2020-02-25"),   # deleted; 3 vanished
        (6, "f", None, "2020-02-22", None),           # new
    ])
    two = H.scd2_merge(one, second, ["id"], HASH, "2020-03-01")
    assert values(two, *OUT) == sorted([
        (1, "a", None, LO, HI, True),
        (2, "b", None, LO, "2020-02-21", False), (2, None, "b", "2020-02-21", HI, True),
        (3, "c", None, LO, "2020-03-01", False),
        (4, "d", None, LO, "2020-01-05", False),
        (5, "e", None, LO, "2020-02-25", False),
        (6, "f", None, LO, HI, True),
    ], key=repr)
    third = frame(SRC, [(3, "c", None, "2020-03-05", None), (2, None, "b", "2020-02-21", None),
                        (1, "a", None, "2020-01-01", None), (6, "f", None, "2020-02-22", None)])
    three = H.scd2_merge(two, third, ["id"], HASH, "2020-04-01")
    assert (3, "c", None, "2020-03-05", HI, True) in values(three, *OUT)  # came back
    again = H.scd2_merge(three, third, ["id"], HASH, "2020-05-01")
    assert values(again, *OUT) == values(three, *OUT)


def test_whole_row_hash_counts_the_stamp(frame):
    rule = replace(HASH, tracked=["v", "w", "last_update"])
    src = frame(SRC, [(1, "a", None, "2020-01-01", None)])
    later = frame(SRC, [(1, "a", None, "2020-01-02", None)])
    one = H.scd2_merge(start(frame), src, ["id"], rule, "2020-02-01")
    assert H.scd2_merge(one, later, ["id"], rule, "2020-03-01").count() == 2


def test_touched_versions_without_comparison(frame, values):
    one = H.scd2_merge(start(frame, False), frame(SRC, [
        (1, "a", None, "2020-01-01", None), (2, "b", None, "2020-01-01", None)]),
        ["id"], star.TOUCHED, "2020-02-01")
    delta = frame(SRC, [(1, "a", None, "2020-02-02", None), (1, "z", None, "2020-02-05", None)])
    two = H.scd2_merge(one, delta, ["id"], star.TOUCHED, "2020-03-01")
    # two staged rows of one key: the latest counts; key 2 is not in the delta
    assert values(two, *OUT) == sorted([
        (1, "a", None, LO, "2020-02-05", False), (1, "z", None, "2020-02-05", HI, True),
        (2, "b", None, LO, HI, True),
    ], key=repr)


def test_tracked_overwrites_the_rest(frame, values):
    one = H.scd2_merge(start(frame, False), frame(SRC, [
        (1, "a", "x", "2020-01-01", None), (2, "b", "y", "2020-01-01", None)]),
        ["id"], TRACKED, "2020-02-01")
    delta = frame(SRC, [(1, "a", "X", "2020-02-02", None), (2, "B", "Y", "2020-02-02", None)])
    two = H.scd2_merge(one, delta, ["id"], TRACKED, "2020-03-01")
    assert values(two, *OUT) == sorted([
        (1, "a", "X", LO, HI, True),
        (2, "b", "y", LO, "2020-02-02", False), (2, "B", "Y", "2020-02-02", HI, True),
    ], key=repr)


RENTAL = ("rental_id int, inventory_id int, staff_id int, rental_date_fk int, "
          "return_date_fk int, last_update timestamp_ntz, deleted timestamp_ntz")


@pytest.mark.parametrize("as_written", [False, True])
def test_return_date_arrives_in_place(frame, values, as_written):
    rule = star.rental_rule(require_return_before=as_written)
    empty = H.add_history_columns(frame(
        "rental_id int, inventory_id int, staff_id int, rental_date_fk int, return_date_fk int",
        []))
    one = H.scd2_merge(empty, frame(RENTAL, [
        (1, 1, 1, 20200101, None, "2020-01-01", None),
        (2, 1, 1, 20200101, 20200105, "2020-01-01", None),
        (3, 1, 1, 20200101, None, "2020-01-01", None),
    ]), ["rental_id"], rule, "2020-02-01")
    delta = frame(RENTAL, [
        (1, 1, 1, 20200101, 20200109, "2020-02-02", None),  # return date arrived
        (2, 1, 1, 20200101, 20200106, "2020-02-02", None),  # return date corrected
        (3, 2, 1, 20200101, 20200109, "2020-02-02", None),  # other disk as well
    ])
    two = H.scd2_merge(one, delta, ["rental_id"], rule, "2020-03-01")
    counts = dict(values(two.groupBy("rental_id").count()))
    assert counts == ({1: 2, 2: 1, 3: 2} if as_written else {1: 1, 2: 2, 3: 2})
    active = dict(values(two.filter("is_active"), "rental_id", "return_date_fk"))
    assert active == {1: 20200109, 2: 20200106, 3: 20200109}
    assert two.filter("rental_id = 1").agg(F.min("effective_date_from")).first()[0] == datetime(
        2020, 1, 1)


def test_soft_delete_only_closes(frame, values):
    one = H.scd2_merge(start(frame, False), frame(SRC, [
        (1, "a", None, "2020-01-01", None), (2, "b", None, "2020-01-01", None)]),
        ["id"], star.TOUCHED, "2020-02-01")
    staged = frame(SRC, [(1, "q", None, "2020-02-02", "2020-02-03"),
                         (2, "q", None, "2020-02-02", None)])
    assert values(H.soft_delete(one, staged, ["id"]), *OUT) == sorted([
        (1, "a", None, LO, "2020-02-03", False), (2, "b", None, LO, HI, True)], key=repr)


def test_parent_change_splits_only_its_own_rows(frame, values):
    dim = H.add_history_columns(frame("pk int, id int, film int, title string", [
        (1, 1, 10, "old"), (2, 2, 10, "old"), (3, 3, 20, "other")]))
    films = frame("film int, title string, last_update timestamp_ntz", [
        (10, "mid", "2020-02-01"), (10, "new", "2020-02-05"), (20, "other!", "2020-01-01")])
    got = H.split_by_parent(dim, films, ["film"], ["title"], "2020-01-15", new_version=["pk"])
    assert values(got, "pk", "id", "title", "effective_date_from", "effective_date_to",
                  "is_active") == sorted([
        (1, 1, "old", LO, "2020-02-05", False), (None, 1, "new", "2020-02-05", HI, True),
        (2, 2, "old", LO, "2020-02-05", False), (None, 2, "new", "2020-02-05", HI, True),
        (3, 3, "other", LO, HI, True)], key=repr)
    assert H.split_by_parent(dim, films, ["film"], ["title"], None) is dim


def test_a_film_that_changes_three_times_makes_four_pieces(frame, values):
    dim = H.add_history_columns(frame("pk int, id int, film int, title string", [(1, 1, 10, "a"), (2, 2, 20, "z")]))
    films = frame("film int, title string, last_update timestamp_ntz", [
        (10, "b", "2020-02-01"), (10, "c", "2020-03-01"), (10, "d", "2020-04-01"), (10, "d", "2020-04-01"),
        (10, "early", "2020-01-01"), (None, "n", "2020-02-01"), (10, "n", None)])
    got = H.split_by_history(dim, films, ["film"], ["title"], "2020-01-15", new_version=["pk"])
    assert values(got, "pk", "id", "title", "effective_date_from", "effective_date_to", "is_active") == sorted([
        (1, 1, "a", LO, "2020-02-01", False), (None, 1, "b", "2020-02-01", "2020-03-01", False),
        (None, 1, "c", "2020-03-01", "2020-04-01", False), (None, 1, "d", "2020-04-01", HI, True),
        (2, 2, "z", LO, HI, True)], key=repr)
    assert values(H.split_by_history(dim, films.limit(0), ["film"], ["title"])) == values(dim)


def test_pieces_against_brute_force(spark):
    """Versions with and without gaps, changes at their very borders, one hot parent."""
    rnd = random.Random(31)
    day = [datetime(2020, 1, 1) + timedelta(days=i) for i in range(60)]
    rows, feed = [], {}
    for i in range(80):
        cuts = sorted(rnd.sample(range(60), rnd.choice([2, 4, 6])))
        for a, b in zip(cuts[::2], cuts[1::2], strict=True):  # with gaps between
            rows.append((i, rnd.choice([0, 0, rnd.randrange(1, 9), None]), f"v{i}", day[a], day[b], b == cuts[-1]))
    for film in range(8):
        for at in rnd.sample(range(60), 40 if film == 0 else rnd.randrange(4)):
            feed[film, day[at]] = f"f{film}-{at}"
    want = []
    for i, film, title, low, high, active in rows:
        at = sorted(t for f, t in feed if f == film and low < t < high)
        edges = [low, *at, high]
        for a, b in zip(edges, edges[1:]):
            want.append((i, film, title if a == low else feed[film, a], a, b, active and b == high))
    dim = spark.createDataFrame(rows, "id int, film int, title string, effective_date_from timestamp_ntz, "
                                      "effective_date_to timestamp_ntz, is_active boolean")
    changes = spark.createDataFrame([(f, t, title) for (f, t), title in feed.items()], "film int, last_update timestamp_ntz, title string")
    got = H.split_by_history(dim, changes, ["film"], ["title"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


# --- a plain model of the merge ---------------------------------------------------


def model(history, staged, rule, load, snapshot):
    """``history`` is [id, v, w, from, to, active]; ``staged`` id -> (v, w, lu, deleted)."""
    lo, hi = datetime(1900, 1, 1), datetime(9999, 1, 1)
    out = [r for r in history if not r[5]]
    seen = {r[0] for r in history}
    active = {r[0]: r for r in history if r[5]}
    for k, r in active.items():
        if k not in staged:
            out.append([*r[:4], load, False] if snapshot else r)
            continue
        v, w, lu, gone = staged[k]
        if gone:
            out.append([*r[:4], max(gone, r[3]), False])
        elif rule == "touched" or (rule == "hash" and (v, w) != (r[1], r[2])) or (
            rule == "tracked" and v != r[1]
        ):
            at = max(lu, r[3])
            out += [[*r[:4], at, False], [k, v, w, at, hi, True]]
        else:
            out.append([k, v, w, *r[3:]] if rule == "tracked" else r)
    for k, (v, w, lu, gone) in staged.items():
        if k in active:
            continue
        if k not in seen:
            out.append([k, v, w, lo, gone or hi, not gone])
        elif not gone:
            out.append([k, v, w, lu, hi, True])
    return out


@pytest.mark.parametrize("change", ["hash", "tracked", "touched"])
@pytest.mark.parametrize("snapshot", [True, False])
def test_merge_against_model(spark, change, snapshot):
    rnd = random.Random(f"{change}{snapshot}")
    rule = H.Rule(change=change, tracked=["v", "w"] if change == "hash" else ["v"],
                  snapshot=snapshot)
    ddl = SRC.replace("timestamp_ntz", "timestamp_ntz")
    state = H.add_history_columns(spark.createDataFrame([], "id int, v string, w string"))
    if change == "hash":
        state = state.withColumn("hash", F.lit(""))
    expected, day = [], datetime(2020, 1, 1)
    for _ in range(3):
        load = day + timedelta(days=30)
        staged = {}
        for k in rnd.sample(range(60), 40):
            lu = day + timedelta(days=rnd.randrange(30))
            gone = lu + timedelta(hours=5) if rnd.random() < 0.2 else None
            staged[k] = (rnd.choice("ab"), rnd.choice(["x", None]), lu, gone)
        rows = [(k, *s) for k, s in staged.items()]
        df = spark.createDataFrame(rows, ddl)
        state = H.scd2_merge(state, df, ["id"], rule, load).cache()
        expected = model(expected, staged, change, load, snapshot)
        got = sorted((list(r) for r in state.select(*OUT).collect()), key=repr)
        assert got == sorted(expected, key=repr)
        day = load
    live = state.filter("is_active").groupBy("id").count()
    assert live.filter("count > 1").isEmpty()
    assert L.overlapping_versions(state, ["id"]).isEmpty()


def test_hot_key_in_the_delta(spark):
    """A third of the delta is one key; it ends as one version."""
    src = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"),
        F.lit("v").alias("v"), F.lit("w").alias("w"),
        (F.lit("2020-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("last_update"),
        F.lit(None).cast("timestamp_ntz").alias("deleted"),
    )
    target = H.add_history_columns(src.select("id", "v", "w").limit(0))
    got = H.scd2_merge(target, src, ["id"], star.TOUCHED, "2022-01-01")
    assert (got.count(), got.filter("id = 1").count()) == (6000, 1)


# --- lookup ---------------------------------------------------------------------


def random_versions(spark, rnd, keys, most):
    rows = []
    for k in range(keys):
        cuts = sorted(rnd.sample(range(24 * 400), most if k == 0 else rnd.randrange(1, 6)))
        times = [datetime(2020, 1, 1) + timedelta(hours=c) for c in cuts]
        ends = [*times[1:], datetime(9999, 1, 1)]
        rows += [(k, f"{k}-{i}", a, b, i == len(cuts) - 1)
                 for i, (a, b) in enumerate(zip(times, ends, strict=True))]
    return rows, spark.createDataFrame(
        rows, "id int, name string, effective_date_from timestamp_ntz, "
              "effective_date_to timestamp_ntz, is_active boolean")


def facts_and_versions(spark, seed):
    """Facts, versions and what should be found, as rows and tables."""
    rnd = random.Random(seed)
    versions, dim = random_versions(spark, rnd, 12, 300)
    # key 0 holds two thirds of the facts; keys 12 and 13 have no version
    facts = [(i, rnd.choice([0, 0, rnd.randrange(14)]),
              datetime(2019, 12, 1) + timedelta(minutes=rnd.randrange(60 * 24 * 500)))
             for i in range(3000)]
    facts += [(3000 + i, v[0], v[2]) for i, v in enumerate(versions)]  # exactly on a start
    fact = spark.createDataFrame(facts, "f int, id int, at timestamp_ntz")
    by_key = {}
    for v in versions:
        by_key.setdefault(v[0], []).append(v)
    want = sorted((f, k, v[1]) for f, k, at in facts for v in by_key.get(k, [])
                  if v[2] <= at < v[3])
    return facts, fact, dim, want


@pytest.mark.parametrize("per_slice", [1, 8, 1000])
def test_dense_lookup_is_the_plain_one(spark, per_slice):
    facts, fact, dim, want = facts_and_versions(spark, per_slice)
    args = ({"id": "id"}, "at", {"name": "name"})
    plain = L.asof_lookup(fact, dim, *args).select("f", "id", "name")
    dense = L.asof_lookup_dense(fact, dim, *args, per_slice=per_slice)
    assert sorted(tuple(r) for r in plain.collect()) == want
    assert sorted(tuple(r) for r in dense.select("f", "id", "name").collect()) == want
    left = L.asof_lookup_dense(fact, dim, *args, how="left", per_slice=per_slice).select("f", "id", "name")
    found = {f for f, *_ in want}
    missing = [(f, k, None) for f, k, _ in facts if f not in found]
    assert sorted((tuple(r) for r in left.collect()), key=repr) == sorted(want + missing, key=repr)


@pytest.mark.parametrize("rows_per_cell", [1, 40, 500, 10**6])
def test_sorted_lookup_is_the_plain_one(spark, rows_per_cell):
    """One key holds most facts and versions; it is cut into up to 1000 cells."""
    facts, fact, dim, want = facts_and_versions(spark, rows_per_cell)
    empty = dim.limit(30).withColumn("effective_date_to", F.col("effective_date_from"))  # match nothing
    options = {"rows_per_cell": rows_per_cell, "sampled": 1.0}
    for how in ("inner", "left"):
        got = L.asof_lookup_sorted(fact, dim.unionByName(empty), {"id": "id"}, "at", {"name": "name"}, how, **options)
        assert got.columns == ["f", "id", "at", "name"]
        found = {f for f, *_ in want}
        missing = [(f, k, None) for f, k, _ in facts if f not in found] if how == "left" else []
        assert sorted((tuple(r) for r in got.select("f", "id", "name").collect()), key=repr) == sorted(want + missing, key=repr)


def test_sorted_lookup_of_gaps_nulls_and_other_types(spark, frame, values):
    dim = frame("k bigint, id string, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz",
                [(1, "a", "2020-01-01", "2020-02-01"), (1, "b", "2020-03-01", "9999-01-01"), (None, "x", "1900-01-01", "9999-01-01")])
    fact = frame("id int, at timestamp_ntz", [
        (1, "2019-12-31"), (1, "2020-01-01"), (1, "2020-02-01"), (1, "2020-03-01"), (1, None), (None, "2020-01-01"),
        (2, "2020-01-01"), (1, "2020-01-01")])
    for cells in ({}, {"rows_per_cell": 1, "sampled": 1.0}):
        got = L.asof_lookup_sorted(fact, dim, {"id": "k"}, "at", {"name": "id", "since": "effective_date_from"}, "left", **cells)
        assert values(got) == sorted([
            (1, "2019-12-31", None, None), (1, "2020-01-01", "a", "2020-01-01"), (1, "2020-02-01", None, None),
            (1, "2020-03-01", "b", "2020-03-01"), (1, None, None, None), (None, "2020-01-01", None, None),
            (2, "2020-01-01", None, None), (1, "2020-01-01", "a", "2020-01-01")], key=repr)
        none = L.asof_lookup_sorted(fact, dim.limit(0), {"id": "k"}, "at", {"name": "id"}, **cells)
        assert none.collect() == [] and L.asof_lookup_sorted(fact.limit(0), dim, {"id": "k"}, "at", {"name": "id"}, **cells).isEmpty()


def test_sorted_lookup_spreads_a_hot_key_and_shuffles_facts_once(spark):
    """A third of all facts and versions belong to one key; no task holds more than a few cells of it."""
    step = F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000)
    begin = F.lit("2020-01-01").cast("timestamp_ntz")
    fact = spark.range(60000).select(key.alias("k"), (begin + step).alias("at"), "id")
    starts = spark.range(20000).select(key.alias("k"), (begin + 3 * step).alias("effective_date_from"), F.col("id").alias("version"))
    following = F.lead("effective_date_from").over(Window.partitionBy("k").orderBy("effective_date_from"))
    dim = starts.withColumn("effective_date_to", F.coalesce(following, F.lit("9999-01-01").cast("timestamp_ntz")))
    args = (fact, dim, {"k": "k"}, "at", {"version": "version"})
    got = L.asof_lookup_sorted(*args, rows_per_cell=500, sampled=1.0)
    assert got.exceptAll(L.asof_lookup_dense(*args)).isEmpty() and got.count() == L.asof_lookup_dense(*args).count()
    cuts = L._cuts(fact.selectExpr("k AS _k0", "at AS _at"), ["_k0"], 500, 1.0).collect()
    assert [(r["_k0"], len(r["_cuts"])) for r in cuts] == [(-1, 39)]  # 20,000 facts
    plan = got._jdf.queryExecution().executedPlan().toString()
    fact_exchanges = [x for x in plan.splitlines() if "hashpartitioning" in x and "_cell" in x]
    assert len({x.split("plan_id")[0] for x in fact_exchanges}) == 1 and "NestedLoop" not in plan


def test_closed_interval_matches_both_sides_of_a_boundary(spark, frame):
    dim = frame("id int, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz",
                [(1, "2020-01-01", "2020-02-01"), (1, "2020-02-01", "2021-01-01")])
    fact = frame("id int, at timestamp_ntz", [(1, "2020-02-01"), (2, "2020-02-01")])
    args = (fact, dim, {"id": "id"}, "at", {"since": "effective_date_from"})
    assert L.asof_lookup(*args).count() == 1
    assert L.asof_lookup(*args, closed=True).count() == 2
    assert L.asof_lookup(*args, how="left").count() == 2


def test_lookup_joins_on_the_key(spark):
    _, dim = random_versions(spark, random.Random(1), 5, 3)
    fact = spark.range(10).select(F.col("id").cast("int"), F.lit("2020-03-01").alias("at"))
    plan = L.asof_lookup(fact, dim.hint("merge"), {"id": "id"}, "at", {"name": "name"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "NestedLoop" not in text


def test_sorted_lookup_ships_keys_and_time_once(spark):
    """Keys and times are columns of the shuffled rows already; the rest of the row goes along without them."""
    fact = spark.sql("SELECT CAST(1 AS INT) AS id, TIMESTAMP_NTZ '2020-05-01' AS at, 7L AS other")
    dim = spark.sql("""SELECT k, 5L AS pk, TIMESTAMP_NTZ '2020-01-01' AS effective_date_from,
      TIMESTAMP_NTZ '2021-01-01' AS effective_date_to, true AS is_active FROM (SELECT CAST(1 AS INT) AS k)""")
    got = L.asof_lookup_sorted(fact, dim, {"id": "k"}, "at", {"pk": "pk"}, "left")
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "struct(other, " in plan and "struct(id" not in plan
    assert got.dtypes == [*fact.dtypes, ("pk", "bigint")]
    assert [tuple(r) for r in got.select("id", "other", "pk").collect()] == [(1, 7, 5)]
    # A key of another type than the dimension's comes back as it was.
    wide = L.asof_lookup_sorted(fact, dim.withColumn("k", F.col("k").cast("long")), {"id": "k"}, "at", {"pk": "pk"})
    assert wide.dtypes == got.dtypes and wide.select("id", "other", "pk").collect() == got.select("id", "other", "pk").collect()
    # Nothing but key and time.
    bare = L.asof_lookup_sorted(fact.select("at", "id"), dim, {"id": "k"}, "at", {"pk": "pk"})
    assert bare.columns == ["at", "id", "pk"] and bare.first()["pk"] == 5
