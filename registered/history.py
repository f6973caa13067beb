"""Versioned rows: merges under every change rule, splits and as-of lookups."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from layerforge.operators import delta as D
from layerforge.operators import history as H
from layerforge.operators import lookup as L
from layerforge.plans import star
from layerforge.plans.steps import side_by_side
from layerforge.session import cut_lineage
from layerforge.sources import standins as S
from registered.base import (
    AFTER,
    BEFORE,
    EARLY,
    FOREVER,
    ORIGIN,
    film,
    inventory,
    payment,
    register,
    rental,
    sql_text,
    staff,
    texts,
    versions,
    with_,
)

SINCE = f"(last_update >= TIMESTAMP '{BEFORE}' OR deleted >= TIMESTAMP '{BEFORE}')"
RANGE = (
    f"{sql_text('effective_date_from')} AS effective_date_from, "
    f"{sql_text('effective_date_to')} AS effective_date_to, is_active"
)


# --- SQL ---------------------------------------------------------------------


def initial_sql(src: str, columns: str, start: str = ORIGIN) -> str:
    """First versions of the rows of ``src``."""
    return f"""SELECT {columns}, {start} AS effective_date_from,
      coalesce(deleted, {FOREVER}) AS effective_date_to, deleted IS NULL AS is_active FROM {src}"""


def merge_sql(
    old: str, src: str, key: str, columns: list[str], changed: str, vanish: str | None = None,
    start: str = ORIGIN, overwrite: tuple[str, ...] = (), first_if: str = "TRUE",
    change_if: str = "TRUE", overwrite_if: str = "TRUE",
) -> str:
    """Next state of ``old`` (one active version per key at most) given ``src``.

    ``changed`` compares o.* and s.*; ``overwrite`` columns follow the source
    while nothing changed; ``vanish`` closes keys missing from ``src``. A first
    version, one after a change and an overwrite each need their condition on
    s.*; closing needs none.
    """
    kept = ", ".join(
        f"""CASE WHEN o.is_active AND s.{key} IS NOT NULL AND s.deleted IS NULL
          AND NOT ({changed}) AND {overwrite_if} THEN s.{c} ELSE o.{c} END AS {c}""" if c in overwrite else f"o.{c}"
        for c in columns
    )
    fresh = ", ".join(f"s.{c}" for c in columns)
    gone = f"s.{key} IS NULL" if vanish else "FALSE"
    return f"""
    SELECT {kept}, o.effective_date_from,
      CASE WHEN NOT o.is_active THEN o.effective_date_to
        WHEN {gone} THEN {vanish or 'NULL'}
        WHEN s.deleted IS NOT NULL THEN s.deleted
        WHEN s.{key} IS NOT NULL AND ({changed}) THEN s.last_update
        ELSE o.effective_date_to END AS effective_date_to,
      o.is_active AND NOT ({gone}) AND s.deleted IS NULL
        AND NOT (s.{key} IS NOT NULL AND ({changed})) AS is_active
    FROM {old} o LEFT JOIN {src} s ON s.{key} = o.{key}
    UNION ALL
    SELECT {fresh}, CASE WHEN k.{key} IS NULL THEN {start} ELSE s.last_update END,
      CASE WHEN k.{key} IS NULL THEN coalesce(s.deleted, {FOREVER}) ELSE {FOREVER} END,
      k.{key} IS NOT NULL OR s.deleted IS NULL
    FROM {src} s LEFT JOIN (SELECT DISTINCT {key} FROM {old}) k ON k.{key} = s.{key}
      LEFT JOIN {old} o ON o.{key} = s.{key} AND o.is_active
    WHERE CASE WHEN k.{key} IS NULL THEN {first_if}
      ELSE s.deleted IS NULL AND (o.{key} IS NULL OR ({changed})) AND {change_if} END"""


# --- full snapshots compared by row hash ---------------------------------------

FILM = ["film_id", "title", "rental_duration", "rental_rate", "rating"]
HASHED = H.Rule(change="hash", tracked=FILM[1:], deleted=None)


@register("scd2_merge_hash", with_(f"SELECT {', '.join(FILM)}, {RANGE} FROM merged",
    old=f"SELECT *, CAST(NULL AS TIMESTAMP) AS deleted FROM ({film(BEFORE)})",
    src=f"SELECT *, CAST(NULL AS TIMESTAMP) AS deleted FROM ({film(AFTER)})",
    first=initial_sql("old", ", ".join(FILM)),
    merged=merge_sql("first", "src", "film_id", FILM,
                     "o.rental_duration IS DISTINCT FROM s.rental_duration", vanish=f"TIMESTAMP '{AFTER}'")))
def scd2_merge_hash(spark, sf_dir):
    state = _empty(S.film(spark, sf_dir, BEFORE), FILM)
    for load_ts in (BEFORE, AFTER):
        rows = S.film(spark, sf_dir, load_ts)
        state = H.scd2_merge(state, rows, ["film_id"], HASHED, load_ts, source_unique=True)
    return versions(state, *FILM)


DISK = ["inventory_id", "film_id", "store_id"]
LIVE_RULE = H.Rule(change="hash", tracked=DISK, deleted=None)


def _empty(rows, columns):
    return H.add_history_columns(rows.select(*columns).limit(0)).withColumn("hash", F.lit(""))


def _live_sql(as_of: str) -> str:
    return f"SELECT * FROM ({inventory(as_of)}) WHERE deleted IS NULL"


def _live_history(spark, sf_dir, loads):
    def live(as_of):
        return S.inventory(spark, sf_dir, as_of).filter(F.col("deleted").isNull())

    state = _empty(live(loads[0]), DISK)
    for load_ts in loads:
        state = H.scd2_merge(
            state, live(load_ts), ["inventory_id"], LIVE_RULE, load_ts, source_unique=True
        )
    return versions(state, *DISK)


MOVED = "o.store_id <> s.store_id"


@register("scd2_vanished", with_(f"SELECT {', '.join(DISK)}, {RANGE} FROM m",
    a=_live_sql(BEFORE), b=_live_sql(AFTER), first=initial_sql("a", ", ".join(DISK)),
    m=merge_sql("first", "b", "inventory_id", DISK, MOVED, vanish=f"TIMESTAMP '{AFTER}'")))
def scd2_vanished(spark, sf_dir):
    return _live_history(spark, sf_dir, [BEFORE, AFTER])


@register("scd2_returned", with_(f"SELECT {', '.join(DISK)}, {RANGE} FROM m2",
    a=_live_sql(EARLY), b=_live_sql(BEFORE), c=_live_sql(AFTER),
    first=initial_sql("a", ", ".join(DISK)),
    m1=merge_sql("first", "b", "inventory_id", DISK, MOVED, vanish=f"TIMESTAMP '{BEFORE}'"),
    m2=merge_sql("m1", "c", "inventory_id", DISK, MOVED, vanish=f"TIMESTAMP '{AFTER}'")))
def scd2_returned(spark, sf_dir):
    """Three loads: keys vanish at the second and come back at the third."""
    return _live_history(spark, sf_dir, [EARLY, BEFORE, AFTER])


# --- deltas --------------------------------------------------------------------

STAFF = ["staff_id", "first_name", "last_name", "active"]


def _written(df):
    """A state or staged rows as a load finds them: written once, read as often as a merge needs."""
    return cut_lineage(df)


def _touched(spark, sf_dir, rows, key, columns):
    target = H.add_history_columns(rows(spark, sf_dir, BEFORE).select(*columns).limit(0))
    plans = {
        "state": H.scd2_merge(target, rows(spark, sf_dir, BEFORE), [key], star.TOUCHED, BEFORE),
        "staged": D.delta_scan(rows(spark, sf_dir, AFTER), BEFORE),
    }
    done = side_by_side(plans, lambda name: _written(plans[name]))
    return H.scd2_merge(done["state"], done["staged"], [key], star.TOUCHED, AFTER)


@register("scd2_initial", with_(
    f"SELECT {', '.join(DISK)}, title, {RANGE} FROM ("
    + initial_sql("i JOIN part ON p_partkey = film_id", "i.*, p_name AS title") + ")",
    i=inventory(AFTER)))
def scd2_initial(spark, sf_dir):
    films = S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title")
    )
    rows = S.inventory(spark, sf_dir, AFTER).join(films, "film_id")
    target = H.add_history_columns(rows.select(*DISK, "title").limit(0))
    return versions(
        H.scd2_merge(target, rows, ["inventory_id"], star.TOUCHED, AFTER), *DISK, "title"
    )


@register("scd2_merge_touch", with_(f"SELECT {', '.join(DISK)}, {RANGE} FROM merged",
    old=inventory(BEFORE), src=f"SELECT * FROM ({inventory(AFTER)}) WHERE {SINCE}",
    first=initial_sql("old", ", ".join(DISK)),
    merged=merge_sql("first", "src", "inventory_id", DISK, "TRUE")))
def scd2_merge_touch(spark, sf_dir):
    return versions(_touched(spark, sf_dir, S.inventory, "inventory_id", DISK), *DISK)


@register("scd2_merge_staff", with_(f"SELECT {', '.join(STAFF)}, {RANGE} FROM merged",
    old=staff(BEFORE), src=f"SELECT * FROM ({staff(AFTER)}) WHERE {SINCE}",
    first=initial_sql("old", ", ".join(STAFF)),
    merged=merge_sql("first", "src", "staff_id", STAFF, "TRUE")))
def scd2_merge_staff(spark, sf_dir):
    return versions(_touched(spark, sf_dir, S.staff, "staff_id", STAFF), *STAFF)


@register("scd2_soft_delete", with_(f"""
SELECT {', '.join(DISK)}, {RANGE} FROM (
  SELECT o.inventory_id, o.film_id, o.store_id, effective_date_from,
    CASE WHEN is_active AND s.deleted IS NOT NULL THEN s.deleted ELSE effective_date_to END
      AS effective_date_to,
    is_active AND s.deleted IS NULL AS is_active
  FROM first o LEFT JOIN src s USING (inventory_id))""",
    old=inventory(BEFORE), src=f"SELECT * FROM ({inventory(AFTER)}) WHERE {SINCE}",
    first=initial_sql("old", ", ".join(DISK))))
def scd2_soft_delete(spark, sf_dir):
    rows = S.inventory(spark, sf_dir, BEFORE)
    target = H.add_history_columns(rows.select(*DISK).limit(0))
    state = H.scd2_merge(target, rows, ["inventory_id"], star.TOUCHED, BEFORE)
    staged = D.delta_scan(S.inventory(spark, sf_dir, AFTER), BEFORE)
    return versions(H.soft_delete(state, staged, ["inventory_id"]), *DISK)


PAID = ["payment_id", "units", "payment_date", "rental_id", "inventory_id", "staff_id"]
UNITS_RULE = replace(
    star.PAYMENT_RULE,
    tracked=["units", "payment_date", "rental_id"],
    inplace_columns=["inventory_id", "staff_id"],
)


@register("fact_scd2_payment", with_(f"""
SELECT payment_id, units, {sql_text('payment_date')} AS payment_date, rental_id, inventory_id,
  staff_id, {RANGE} FROM merged""",
    old=payment(BEFORE), src=f"SELECT * FROM ({payment(AFTER)}) WHERE {SINCE}",
    first=initial_sql("old", ", ".join(PAID)),
    merged=merge_sql("first", "src", "payment_id", PAID,
                     "o.units <> s.units OR o.payment_date <> s.payment_date",
                     overwrite=("inventory_id", "staff_id"))))
def fact_scd2_payment(spark, sf_dir):
    """Units, date and rental make versions; disk and staff follow in place."""
    rows = S.payment(spark, sf_dir, BEFORE)
    target = H.add_history_columns(rows.select(*PAID).limit(0))
    state = _written(H.scd2_merge(target, rows, ["payment_id"], UNITS_RULE, BEFORE))
    staged = _written(D.delta_scan(S.payment(spark, sf_dir, AFTER), BEFORE))
    state = H.scd2_merge(state, staged, ["payment_id"], UNITS_RULE, AFTER)
    return texts(versions(state, *PAID), "payment_date")


RENTED = ["rental_id", "inventory_id", "staff_id", "rental_date_fk", "return_date_fk"]


def _rented(df):
    day = {"rental_date_fk": "rental_date", "return_date_fk": "return_date"}
    for fk, ts in day.items():
        df = df.withColumn(fk, F.date_format(ts, "yyyyMMdd").cast("int"))
    return df


def _rented_sql(as_of: str) -> str:
    return f"""SELECT *, CAST(strftime(rental_date, '%Y%m%d') AS INT) AS rental_date_fk,
      CAST(strftime(return_date, '%Y%m%d') AS INT) AS return_date_fk FROM ({rental(as_of)})"""


ARRIVED = """(o.return_date_fk IS NULL AND s.return_date_fk IS NOT NULL
  AND o.inventory_id = s.inventory_id AND o.staff_id = s.staff_id
  AND o.rental_date_fk = s.rental_date_fk)"""


@register("fact_scd2_rental", with_(f"SELECT {', '.join(RENTED)}, {RANGE} FROM merged",
    old=_rented_sql(BEFORE), src=f"SELECT * FROM ({_rented_sql(AFTER)}) WHERE {SINCE}",
    first=initial_sql("old", ", ".join(RENTED), start="last_update"),
    merged=merge_sql("first", "src", "rental_id", RENTED, f"NOT {ARRIVED}", start="s.last_update",
                     overwrite=("return_date_fk",))))
def fact_scd2_rental(spark, sf_dir):
    """A return date that arrives is filled in; other staged rows make versions."""
    rows = _rented(S.rental(spark, sf_dir, BEFORE))
    target = H.add_history_columns(rows.select(*RENTED).limit(0))
    state = _written(H.scd2_merge(target, rows, ["rental_id"], star.rental_rule(), BEFORE))
    staged = _written(_rented(D.delta_scan(S.rental(spark, sf_dir, AFTER), BEFORE)))
    return versions(
        H.scd2_merge(state, staged, ["rental_id"], star.rental_rule(), AFTER), *RENTED
    )


# --- parent change, lookup, upgrade ----------------------------------------------

SPLIT = ["inventory_id", "film_id", "title", "rental_duration"]


@register("parent_change_split", with_(f"""
SELECT {', '.join(SPLIT)}, {RANGE} FROM (
  SELECT m.inventory_id, m.film_id, m.title, m.rental_duration, m.effective_date_from,
    CASE WHEN hit THEN cut_at ELSE m.effective_date_to END AS effective_date_to,
    m.is_active AND NOT coalesce(hit, FALSE) AS is_active
  FROM cut m
  UNION ALL
  SELECT m.inventory_id, m.film_id, m.new_title, m.new_duration, cut_at, m.effective_date_to,
    m.is_active
  FROM cut m WHERE hit)""",
    disks=f"""SELECT i.*, f.title, f.rental_duration
      FROM ({inventory(BEFORE)}) i JOIN ({film(BEFORE)}) f USING (film_id)""",
    first=initial_sql("disks", ", ".join(SPLIT)),
    films=f"SELECT * FROM ({film(AFTER)}) WHERE last_update >= TIMESTAMP '{BEFORE}'",
    cut="""SELECT o.*, f.title AS new_title, f.rental_duration AS new_duration,
      f.last_update AS cut_at,
      f.last_update > effective_date_from AND f.last_update < effective_date_to AS hit
      FROM first o LEFT JOIN films f USING (film_id)"""))
def parent_change_split(spark, sf_dir):
    films = S.film(spark, sf_dir, BEFORE).select("film_id", "title", "rental_duration")
    rows = S.inventory(spark, sf_dir, BEFORE).join(films, "film_id")
    target = H.add_history_columns(rows.select(*SPLIT).limit(0))
    dim = H.scd2_merge(target, rows, ["inventory_id"], star.TOUCHED, BEFORE)
    split = H.split_by_parent(
        dim, S.film(spark, sf_dir, AFTER), ["film_id"], ["title", "rental_duration"], BEFORE
    )
    return versions(split, *SPLIT)


@register("parent_history_split", with_(f"""
SELECT {', '.join(SPLIT)}, {RANGE} FROM (
  SELECT inventory_id, film_id, title, rental_duration, effective_date_from,
    coalesce(cut_at, effective_date_to) AS effective_date_to, is_active AND cut_at IS NULL AS is_active
  FROM (SELECT o.*, (SELECT min(sold) FROM feed f WHERE f.film_id = o.film_id
      AND sold > effective_date_from AND sold < effective_date_to) AS cut_at FROM first o)
  UNION ALL
  SELECT o.inventory_id, o.film_id, o.title, f.duration, f.sold, least(next_at, effective_date_to),
    is_active AND next_at >= effective_date_to
  FROM first o JOIN feed f ON f.film_id = o.film_id AND f.sold > effective_date_from AND f.sold < effective_date_to)""",
    disks=f"""SELECT i.*, f.title, f.rental_duration
      FROM ({inventory(BEFORE)}) i JOIN ({film(BEFORE)}) f USING (film_id)""",
    first=initial_sql("disks", ", ".join(SPLIT)),
    feed=f"""SELECT *, coalesce(lead(sold) OVER (PARTITION BY film_id ORDER BY sold), {FOREVER}) AS next_at FROM (
      SELECT l_partkey AS film_id, l_shipdate AS sold, CAST(max(l_quantity) AS INT) AS duration
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{BEFORE}' GROUP BY ALL)"""))
def parent_history_split(spark, sf_dir):
    """Disk versions cut at every sale of their film since the first load, not only the last."""
    films = S.film(spark, sf_dir, BEFORE).select("film_id", "title", "rental_duration")
    rows = S.inventory(spark, sf_dir, BEFORE).join(films, "film_id")
    target = H.add_history_columns(rows.select(*SPLIT).limit(0))
    dim = H.scd2_merge(target, rows, ["inventory_id"], star.TOUCHED, BEFORE)
    sales = S.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").alias("film_id"), F.col("l_shipdate").alias("last_update")
    ).agg(F.max("l_quantity").cast("int").alias("rental_duration"))
    return versions(H.split_by_history(dim, sales, ["film_id"], ["rental_duration"], BEFORE), *SPLIT)


_DIMS = {
    "i1": inventory(BEFORE),
    "i2": f"SELECT * FROM ({inventory(AFTER)}) WHERE {SINCE}",
    "if": initial_sql("i1", ", ".join(DISK)),
    "di": merge_sql('"if"', "i2", "inventory_id", DISK, "TRUE"),
    "s1": staff(BEFORE),
    "s2": f"SELECT * FROM ({staff(AFTER)}) WHERE {SINCE}",
    "sf": initial_sql("s1", ", ".join(STAFF)),
    "ds": merge_sql("sf", "s2", "staff_id", STAFF, "TRUE"),
    "r": rental(AFTER),
}
_DIMS = {('"if"' if k == "if" else k): q for k, q in _DIMS.items()}


@register("asof_dim_lookup", with_(f"""
SELECT r.rental_id, {sql_text('di.effective_date_from')} AS inventory_from,
  di.store_id AS store_id, {sql_text('ds.effective_date_from')} AS staff_from, ds.active AS active
FROM r JOIN di ON di.inventory_id = r.inventory_id
    AND r.last_update >= di.effective_date_from AND r.last_update < di.effective_date_to
  JOIN ds ON ds.staff_id = r.staff_id
    AND r.last_update >= ds.effective_date_from AND r.last_update < ds.effective_date_to""",
    **_DIMS))
def asof_dim_lookup(spark, sf_dir):
    def table(name):
        if name == "rental":
            return _written(S.rental(spark, sf_dir, AFTER).select("rental_id", "inventory_id", "staff_id", "last_update"))
        return _touched(spark, sf_dir, *(
            (S.inventory, "inventory_id", DISK) if name == "inventory" else (S.staff, "staff_id", STAFF)))

    dims = side_by_side(["inventory", "staff", "rental"], table)
    rows = dims["rental"]
    placed = L.asof_lookup_sorted(
        rows, dims["inventory"], {"inventory_id": "inventory_id"}, "last_update",
        {"inventory_from": "effective_date_from", "store_id": "store_id"},
    )
    done = L.asof_lookup_sorted(
        placed, dims["staff"], {"staff_id": "staff_id"}, "last_update",
        {"staff_from": "effective_date_from", "active": "active"}, sample_of=rows,
    )
    return texts(
        done.select("rental_id", "inventory_from", "store_id", "staff_from", "active"),
        "inventory_from", "staff_from",
    )


@register("asof_dim_lookup_closed", with_(f"""
SELECT r.rental_id, {sql_text('di.effective_date_from')} AS inventory_from
FROM r JOIN di ON di.inventory_id = r.inventory_id
    AND r.last_update BETWEEN di.effective_date_from AND di.effective_date_to""", **_DIMS))
def asof_dim_lookup_closed(spark, sf_dir):
    """Both bounds inclusive: a time on a shared boundary finds both versions."""
    rows = S.rental(spark, sf_dir, AFTER).select("rental_id", "inventory_id", "last_update")
    disks = _touched(spark, sf_dir, S.inventory, "inventory_id", DISK)
    found = L.asof_lookup(
        rows, disks, {"inventory_id": "inventory_id"}, "last_update",
        {"inventory_from": "effective_date_from"}, closed=True,
    )
    return texts(found.select("rental_id", "inventory_from"), "inventory_from")


@register("asof_dense_keys", with_(f"""
SELECT e.event_id, {sql_text('p.effective_date_from')} AS state_from, p.event_type AS state
FROM feed e JOIN state p ON p.user_id = e.user_id
  AND e.last_update >= p.effective_date_from AND e.last_update < p.effective_date_to""",
    feed="SELECT event_id, user_id, event_type, ts AS last_update FROM events",
    state=f"""SELECT user_id, event_type, ts AS effective_date_from,
      coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {FOREVER}) AS effective_date_to
      FROM events WHERE event_type IN ('purchase', 'signup')"""))
def asof_dense_keys(spark, sf_dir):
    """Every event with the user state it falls in; users have many states."""
    from pyspark.sql import Window

    from layerforge.functions.dates import FOREVER as END
    from layerforge.functions.dates import ntz

    feed = S.event_feed(spark, sf_dir).select("event_id", "user_id", "event_type", "last_update")
    following = F.lead("last_update").over(Window.partitionBy("user_id").orderBy("last_update"))
    state = feed.filter(F.col("event_type").isin("purchase", "signup")).select(
        "user_id",
        "event_type",
        F.col("last_update").alias("effective_date_from"),
        F.coalesce(following, ntz(END)).alias("effective_date_to"),
    )
    found = L.asof_lookup_dense(
        feed, state, {"user_id": "user_id"}, "last_update",
        {"state_from": "effective_date_from", "state": "event_type"},
    )
    return texts(found.select("event_id", "state_from", "state"), "state_from")


@register("add_history_columns", with_(f"""
SELECT payment_id, {sql_text('payment_date')} AS last_update, {sql_text(ORIGIN)}
  AS effective_date_from, {sql_text(FOREVER)} AS effective_date_to, TRUE AS is_active
FROM p""", p=payment(AFTER)))
def add_history_columns(spark, sf_dir):
    rows = S.payment(spark, sf_dir, AFTER).select("payment_id", "payment_date")
    upgraded = H.add_history_columns(rows, stamp="last_update", stamp_from="payment_date")
    return texts(versions(upgraded, "payment_id", "last_update"), "last_update")
