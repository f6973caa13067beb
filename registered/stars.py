"""Dimension and fact builds, and whole loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from layerforge.operators import checks, facts
from layerforge.operators.delta import delta_scan
from layerforge.operators.history import add_history_columns
from layerforge.operators.keys import number_rows
from layerforge.plans import layered, star
from layerforge.plans.sinks import StoreSink
from layerforge.session import cut_lineage, written_once
from layerforge.sources import standins as S
from layerforge.sources.store import scratch_store
from registered.analytics import calendar, calendar_span
from registered.base import (
    AFTER,
    BEFORE,
    CALENDAR,
    PLACE,
    RELOADED,
    RENTAL_ROWS,
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
from registered.history import RANGE, SINCE, initial_sql, merge_sql

DISK = ["inventory_id", "film_id", *facts.FILM_COLUMNS]


@register("dim_build", with_(
    "SELECT inventory_id, film_id, title, rental_duration, rental_rate, length, rating "
    "FROM i JOIN f USING (film_id)", i=inventory(AFTER), f=film(AFTER)))
def dim_build(spark, sf_dir):
    rows = facts.inventory_rows(S.inventory(spark, sf_dir, AFTER), S.film(spark, sf_dir, AFTER))
    return rows.select(*DISK)


@register("flatten_dim", with_("""
SELECT staff_id, first_name, last_name, p.address, p.district, p.city_name
FROM s JOIN p USING (store_id)""", s=staff(AFTER), p=PLACE))
def flatten_dim(spark, sf_dir):
    rows = facts.flatten_staff(
        S.staff(spark, sf_dir, AFTER), S.store(spark, sf_dir), S.address(spark, sf_dir),
        S.city(spark, sf_dir),
    )
    return rows.select(*facts.STAFF_COLUMNS)


@register("fact_with_optional_date", with_("""
SELECT rental_id, a.date_dim_pk AS rental_date_fk, b.date_dim_pk AS return_date_fk
FROM r JOIN c a ON a.date_actual = CAST(rental_date AS DATE)
  LEFT JOIN c b ON b.date_actual = CAST(return_date AS DATE)""", r=RENTAL_ROWS, c=CALENDAR))
def fact_with_optional_date(spark, sf_dir):
    days = calendar(spark, sf_dir)
    rows = facts.date_role(S.rental_rows(spark, sf_dir), days, "rental_date", "rental_date_fk")
    rows = facts.date_role(rows, days, "return_date", "return_date_fk", "left")
    return rows.select("rental_id", "rental_date_fk", "return_date_fk")


def _dims(spark, sf_dir):
    disks = S.inventory(spark, sf_dir, AFTER).select("inventory_id")
    people = S.staff(spark, sf_dir, AFTER).select("staff_id")
    return (
        number_rows(disks, ["inventory_id"], "inventory_pk"),
        number_rows(people, ["staff_id"], "staff_pk"),
    )


_CTES = {
    "p": payment(AFTER),
    "early": payment(BEFORE),
    "r": rental(AFTER),
    "i": inventory(AFTER),
    "s": staff(AFTER),
    "di": "SELECT inventory_id, row_number() OVER (ORDER BY inventory_id) AS inventory_pk FROM i",
    "ds": "SELECT staff_id, row_number() OVER (ORDER BY staff_id) AS staff_pk FROM s",
    "c": CALENDAR,
}


@register("fact_payment", with_("""
SELECT p.payment_id, p.amount, c.date_dim_pk AS payment_date_fk, di.inventory_pk AS inventory_fk,
  ds.staff_pk AS staff_fk
FROM p JOIN r USING (rental_id) JOIN di ON di.inventory_id = r.inventory_id
  JOIN ds ON ds.staff_id = p.staff_id JOIN c ON c.date_actual = CAST(p.payment_date AS DATE)""",
    **_CTES))
def fact_payment(spark, sf_dir):
    disks, people = _dims(spark, sf_dir)
    return facts.fact_payment(
        S.payment(spark, sf_dir, AFTER).drop("inventory_id"), S.rental(spark, sf_dir, AFTER),
        disks, people, calendar(spark, sf_dir),
    )


@register("fact_rental_grain", with_("""
SELECT r.rental_id, di.inventory_pk AS inventory_fk, ds.staff_pk AS staff_fk,
  a.date_dim_pk AS rental_date_fk, b.date_dim_pk AS return_date_fk, count(*) AS cnt,
  CAST(sum(p.amount) AS DECIMAL(18,2)) AS amount
FROM r JOIN ds ON ds.staff_id = r.staff_id JOIN di ON di.inventory_id = r.inventory_id
  JOIN c a ON a.date_actual = CAST(r.rental_date AS DATE)
  LEFT JOIN early p ON p.rental_id = r.rental_id
  LEFT JOIN c b ON b.date_actual = CAST(r.return_date AS DATE)
GROUP BY 1, 2, 3, 4, 5""", **_CTES))
def fact_rental_grain(spark, sf_dir):
    """Rentals after the payment snapshot have none: count 1, amount NULL."""
    disks, people = _dims(spark, sf_dir)
    return facts.fact_rental(
        S.rental(spark, sf_dir, AFTER), S.payment(spark, sf_dir, BEFORE), disks, people,
        calendar(spark, sf_dir),
    )


@register("fact_rental_coarse", with_("""
SELECT di.inventory_pk AS inventory_fk, ds.staff_pk AS staff_fk,
  CAST(r.rental_date AS DATE) AS rental_date, CAST(r.return_date AS DATE) AS return_date,
  CAST(sum(p.amount) AS DECIMAL(18,2)) AS amount
FROM r JOIN ds ON ds.staff_id = r.staff_id JOIN di ON di.inventory_id = r.inventory_id
  LEFT JOIN p ON p.rental_id = r.rental_id
GROUP BY 1, 2, 3, 4""", **_CTES))
def fact_rental_coarse(spark, sf_dir):
    disks, people = _dims(spark, sf_dir)
    return facts.fact_rental_coarse(
        S.rental(spark, sf_dir, AFTER), S.payment(spark, sf_dir, AFTER), disks, people
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


# --- whole loads -----------------------------------------------------------------


_LOADED = {}


def _files(spark, sf_dir):
    """Name, size and time of the input files: changed tables are loaded again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir, "*.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found)


def _loaded(kind, spark, sf_dir, build):
    """Store and tables of two loads; queries of one session on one input share them.

    The first query that asks pays for the loads, the others read what they wrote.
    """
    key = (kind, spark.sparkContext.applicationId, _files(spark, sf_dir))
    if key not in _LOADED:
        store = scratch_store(spark)
        _LOADED[key] = store, build(spark, sf_dir, store)
    return _LOADED[key]


def _source(spark, sf_dir, as_of):
    """Source tables of one time; loads and checks of one session share what was written of them."""
    return _loaded(f"source {as_of}", spark, sf_dir, lambda *of: S.source_tables(*of[:2], as_of))[1]


def _star(spark, sf_dir):
    return _loaded("star", spark, sf_dir, _load_star)[1]


def _layered(spark, sf_dir):
    return _loaded("layered", spark, sf_dir, _load_layers)[1]


def _load_star(spark, sf_dir, store):
    """First load and one delta load of the star schema, written to a store."""
    days = calendar(spark, sf_dir)
    star.load(_source(spark, sf_dir, BEFORE), StoreSink(store, "1", BEFORE), days, BEFORE)
    return star.load(_source(spark, sf_dir, AFTER), StoreSink(store, "2", AFTER), days, AFTER)


def _load_layers(spark, sf_dir, store):
    """First load and one delta load of all layers, written to a store."""
    span = calendar_span(spark, sf_dir)
    layered.load(_source(spark, sf_dir, BEFORE), StoreSink(store, "1", BEFORE), BEFORE, *span)
    return layered.load(_source(spark, sf_dir, AFTER), StoreSink(store, "2", AFTER), AFTER, *span)


def _since_target(table: str) -> str:
    """Rows of two loads where the second takes only stamps after the first's newest."""
    return f"""
    SELECT * FROM {table}1 WHERE {table}_id NOT IN (
      SELECT {table}_id FROM {table}2
      WHERE last_update > (SELECT max(last_update) FROM {table}1))
    UNION ALL
    SELECT * FROM {table}2 WHERE last_update > (SELECT max(last_update) FROM {table}1)"""


@register("layered_load_by_date", with_("""
SELECT c.date_dim_pk AS sales_date_rn,
  c.day_of_month || ' ' || c.month_name || ' ' || c.year_actual AS sales_date_title,
  CAST(sum(amount) AS DOUBLE) AS amount
FROM p JOIN c ON c.date_actual = CAST(p.payment_date AS DATE)
WHERE deleted IS NULL GROUP BY 1, 2""",
    c=CALENDAR, payment1=payment(BEFORE), payment2=payment(AFTER), p=_since_target("payment")))
def layered_load_by_date(spark, sf_dir):
    return _layered(spark, sf_dir)["report.sales_by_date"]


_BY_FILM = with_("""
SELECT sk AS sales_film_rn, p_name AS sales_film_title, CAST(sum(p.amount) AS DOUBLE) AS amount
FROM p JOIN r USING (rental_id) JOIN i ON i.inventory_id = r.inventory_id
  JOIN k ON k.film_id = i.film_id JOIN part ON p_partkey = i.film_id
WHERE p.deleted IS NULL AND r.deleted IS NULL AND i.deleted IS NULL GROUP BY 1, 2""",
    payment1=payment(BEFORE), payment2=payment(AFTER), p=_since_target("payment"),
    rental1=rental(BEFORE), rental2=rental(AFTER), r=_since_target("rental"),
    i=inventory(AFTER), f1=film(BEFORE), f2=film(AFTER),
    k="""SELECT film_id, row_number() OVER (ORDER BY film_id NOT IN (SELECT film_id FROM f1),
      film_id) AS sk FROM f2""")


@register("layered_load_by_film", _BY_FILM)
def layered_load_by_film(spark, sf_dir):
    return _layered(spark, sf_dir)["report.sales_by_film"]


@register("mart_by_film", f"SELECT sales_film_title AS title, amount FROM ({_BY_FILM})")
def mart_by_film(spark, sf_dir):
    """The report function over the committed mart: title and amount."""
    store, _ = _loaded("layered", spark, sf_dir, _load_layers)
    return layered.sales_by_film_report(store)


@register("mart_by_date", with_("""
SELECT c.day_of_month || ' ' || c.month_name || ' ' || c.year_actual AS date_title,
  CAST(sum(amount) AS DOUBLE) AS amount
FROM p JOIN c ON c.date_actual = CAST(p.payment_date AS DATE)
WHERE deleted IS NULL GROUP BY c.date_dim_pk, 1""",
    c=CALENDAR, payment1=payment(BEFORE), payment2=payment(AFTER), p=_since_target("payment")))
def mart_by_date(spark, sf_dir):
    """The report function over the committed mart: day and amount."""
    store, _ = _loaded("layered", spark, sf_dir, _load_layers)
    return layered.sales_by_date_report(store)


def _key_sql(key: str, first: str, second: str) -> str:
    """Surrogates after two loads: keys of the first load in order, then the new ones."""
    return f"""SELECT {key}, row_number() OVER (ORDER BY {key} NOT IN (SELECT {key} FROM {first}), {key}) AS sk
      FROM (SELECT {key} FROM {first} UNION SELECT {key} FROM {second})"""


_LAYERS = {
    "payment1": payment(BEFORE), "payment2": payment(AFTER), "p": _since_target("payment"),
    "rental1": rental(BEFORE), "rental2": rental(AFTER), "r": _since_target("rental"),
    "inventory1": inventory(BEFORE), "inventory2": inventory(AFTER),
    "staff1": staff(BEFORE), "staff2": staff(AFTER),
    **{f"k_{t}": _key_sql(f"{t}_id", f"{t}1", f"{t}2") for t in ("payment", "rental", "inventory", "staff")},
}


def _ods_sql(table: str, columns: str) -> str:
    return f"""SELECT 'ods' AS layer, {columns} FROM {table}1
    WHERE {table}_id NOT IN (SELECT {table}_id FROM {table}2 WHERE {SINCE})
  UNION ALL SELECT 'ods', {columns} FROM {table}2 WHERE {SINCE}"""


def _layer_rows(spark, sf_dir, table, columns):
    """One table of ods, integ and dds after two loads, in long form."""
    loaded = _layered(spark, sf_dir)
    ods, integ, dds = (
        loaded[f"{layer}.{table}"].select(F.lit(layer).alias("layer"), *columns) for layer in ("ods", "integ", "dds")
    )
    return ods.unionByName(integ).unionByName(dds)


@register("layered_load_payment", with_(_ods_sql("payment", "payment_id, staff_id, rental_id, amount") + """
  UNION ALL SELECT layer, kp.sk, ks.sk, kr.sk, amount
  FROM p JOIN k_payment kp USING (payment_id) JOIN k_staff ks USING (staff_id)
    JOIN k_rental kr USING (rental_id), (VALUES ('integ'), ('dds')) AS v(layer)""", **_LAYERS))
def layered_load_payment(spark, sf_dir):
    """Payments under natural keys in ods, under surrogates in integ and dds."""
    return _layer_rows(spark, sf_dir, "payment", ["payment_id", "staff_id", "rental_id", "amount"])


@register("layered_load_rental", with_(
    _ods_sql("rental", f"rental_id, inventory_id, staff_id, {sql_text('return_date')} AS return_date") + f"""
  UNION ALL SELECT layer, kr.sk, ki.sk, ks.sk, {sql_text('return_date')}
  FROM r JOIN k_rental kr USING (rental_id) JOIN k_staff ks USING (staff_id)
    JOIN k_inventory ki USING (inventory_id), (VALUES ('integ'), ('dds')) AS v(layer)""", **_LAYERS))
def layered_load_rental(spark, sf_dir):
    """Rentals under natural keys in ods, under surrogates in integ and dds."""
    rows = _layer_rows(spark, sf_dir, "rental", ["rental_id", "inventory_id", "staff_id", "return_date"])
    return texts(rows, "return_date")


_PAID = ["payment_id", "amount", "payment_date", "rental_id", "inventory_id", "inventory_from",
         "staff_id", "staff_from"]
_RENTED = ["rental_id", "rental_date", "return_date", "inventory_id", "inventory_from",
           "staff_id", "staff_from"]


def _asof(rows: str, disks: str, people: str, at: str = "last_update", how: str = "JOIN") -> str:
    return f"""SELECT x.*, di.effective_date_from AS inventory_from,
      ds.effective_date_from AS staff_from
    FROM {rows} x {how} {disks} di ON di.inventory_id = x.inventory_id
        AND x.{at} >= di.effective_date_from AND x.{at} < di.effective_date_to
      {how} {people} ds ON ds.staff_id = x.staff_id
        AND x.{at} >= ds.effective_date_from AND x.{at} < ds.effective_date_to"""


def _restaged(delta: str, late: str, key: str) -> str:
    """A delta and the rows carried over whose key it lacks."""
    return f"""SELECT *, FALSE AS carried FROM ({delta}) UNION ALL BY NAME
      SELECT *, TRUE AS carried FROM {late} WHERE {key} NOT IN (SELECT {key} FROM ({delta}))"""


# The dimension loads step by step: deleted disks and staff are closed, new ones
# inserted, changed ones closed and opened again; films split versions. Only the
# inserts need the film or the place of the store.
_STAR = {
    "c": CALENDAR,
    "place": PLACE,
    "f1": film(BEFORE),
    "f2": film(AFTER),
    "i1": f"SELECT * FROM ({inventory(BEFORE)}) JOIN (SELECT film_id, title FROM f1) USING (film_id)",
    # Rows of the first load without a home come again with the second, unless it has their key.
    "late_i": f"""SELECT * FROM ({inventory(BEFORE)})
      WHERE deleted IS NULL AND film_id NOT IN (SELECT film_id FROM f1)""",
    "staged_i": _restaged(f"SELECT * FROM ({inventory(AFTER)}) WHERE {SINCE}", "late_i", "inventory_id"),
    "i2": """SELECT x.*, f.title, f.film_id IS NOT NULL AS found FROM staged_i x
      LEFT JOIN f2 f USING (film_id)""",
    "di1": initial_sql("i1", "inventory_id, film_id, title"),
    "dm": merge_sql("di1", "i2", "inventory_id", ["inventory_id", "film_id", "title"], "TRUE",
                    first_if="s.found", change_if="s.found"),
    "films": f"SELECT * FROM f2 WHERE last_update >= TIMESTAMP '{BEFORE}'",
    "cut": """SELECT m.*, f.last_update AS cut_at, f.title AS new_title,
      coalesce(f.last_update > effective_date_from AND f.last_update < effective_date_to, FALSE)
        AS hit FROM dm m LEFT JOIN films f USING (film_id)""",
    "di2": """SELECT inventory_id, film_id, title, effective_date_from,
        CASE WHEN hit THEN cut_at ELSE effective_date_to END AS effective_date_to,
        is_active AND NOT hit AS is_active FROM cut
      UNION ALL SELECT inventory_id, film_id, new_title, cut_at, effective_date_to, is_active
      FROM cut WHERE hit""",
    "s1": f"""SELECT x.*, city_name FROM ({staff(BEFORE)}) x
      JOIN (SELECT store_id, city_name FROM place) USING (store_id)""",
    "late_s": f"""SELECT * FROM ({staff(BEFORE)})
      WHERE deleted IS NULL AND store_id NOT IN (SELECT store_id FROM place)""",
    "staged_s": _restaged(f"SELECT * FROM ({staff(AFTER)}) WHERE {SINCE}", "late_s", "staff_id"),
    "s2": """SELECT x.*, p.city_name, p.store_id IS NOT NULL AS found FROM staged_s x
      LEFT JOIN place p USING (store_id)""",
    "ds1": initial_sql("s1", "staff_id, first_name, city_name"),
    "ds2": merge_sql("ds1", "s2", "staff_id", ["staff_id", "first_name", "city_name"], "TRUE",
                     first_if="s.found", change_if="s.found"),
    "r1": rental(BEFORE),
    "r2": rental(AFTER),
    "p1": payment(BEFORE),
    "p2": f"""SELECT p.* FROM ({payment(AFTER)}) p JOIN r2 USING (rental_id)
      WHERE p.last_update >= TIMESTAMP '{BEFORE}' OR p.deleted >= TIMESTAMP '{BEFORE}'
        OR r2.last_update >= TIMESTAMP '{BEFORE}'""",
    "late_p": f"""SELECT * FROM p1 WHERE deleted IS NULL
      AND payment_id NOT IN (SELECT payment_id FROM ({_asof("p1", "di1", "ds1")}))""",
    "late_r": f"""SELECT * FROM r1 WHERE deleted IS NULL
      AND rental_id NOT IN (SELECT rental_id FROM ({_asof("r1", "di1", "ds1")}))""",
    "ps": _restaged("SELECT * FROM p2", "late_p", "payment_id"),
    "rs": _restaged(f"SELECT * FROM r2 WHERE {SINCE}", "late_r", "rental_id"),
    # staged facts with the versions found for them, if any
    "pk": _asof("ps", "di2", "ds2", how="LEFT JOIN"),
    "rk": _asof("rs", "di2", "ds2", how="LEFT JOIN"),
}
_KEYS_FOUND = "(s.inventory_from IS NOT NULL AND s.staff_from IS NOT NULL)"


@register("star_load_dims", with_(f"""
SELECT 'disk' AS dim, inventory_id AS id, title AS name, {RANGE} FROM di2
UNION ALL
SELECT 'staff', staff_id, first_name || ' in ' || city_name, {RANGE} FROM ds2""", **_STAR))
def star_load_dims(spark, sf_dir):
    loaded = _star(spark, sf_dir)
    disks = loaded["dim_inventory"].select(
        F.lit("disk").alias("dim"), F.col("inventory_id").alias("id"), F.col("title").alias("name"),
        "effective_date_from", "effective_date_to", "is_active",
    )
    people = loaded["dim_staff"].select(
        F.lit("staff").alias("dim"), F.col("staff_id").alias("id"),
        F.concat("first_name", F.lit(" in "), "city_name").alias("name"),
        "effective_date_from", "effective_date_to", "is_active",
    )
    return versions(disks.unionByName(people), "dim", "id", "name")


def _facts(fact, dims, columns):
    """Facts with the disk, staff and version start their keys stand for."""
    disks = dims["dim_inventory"].select(
        "inventory_pk", F.col("inventory_id").alias("disk"),
        F.col("effective_date_from").alias("inventory_from"),
    )
    people = dims["dim_staff"].select(
        "staff_pk", F.col("staff_id").alias("person"),
        F.col("effective_date_from").alias("staff_from"),
    )
    named = (
        fact.drop("inventory_id", "staff_id")
        .join(disks, F.col("inventory_fk") == F.col("inventory_pk"))
        .join(people, F.col("staff_fk") == F.col("staff_pk"))
        .withColumnsRenamed({"disk": "inventory_id", "person": "staff_id"})
    )
    return texts(versions(named, *columns), "inventory_from", "staff_from")


_NAMED = ("{}, inventory_id, staff_id, "
          f"{sql_text('inventory_from')} AS inventory_from, {sql_text('staff_from')} AS staff_from, "
          f"{RANGE}")


@register("star_load_payment", with_(
    "SELECT " + _NAMED.format("payment_id, amount, rental_id, "
        "CAST(strftime(payment_date, '%Y%m%d') AS INT) AS payment_date_fk") + " FROM merged",
    **_STAR, k1=_asof("p1", "di1", "ds1"), first=initial_sql("k1", ", ".join(_PAID)),
    merged=merge_sql("first", "pk", "payment_id", _PAID,
                     "o.amount <> s.amount OR o.payment_date <> s.payment_date",
                     overwrite=("inventory_id", "inventory_from", "staff_id", "staff_from"),
                     first_if=_KEYS_FOUND, change_if=_KEYS_FOUND, overwrite_if=_KEYS_FOUND)))
def star_load_payment(spark, sf_dir):
    loaded = _star(spark, sf_dir)
    return _facts(loaded["fact_payment"], loaded, [
        "payment_id", "amount", "rental_id", "payment_date_fk", "inventory_id", "staff_id",
        "inventory_from", "staff_from",
    ])


@register("star_load_rental", with_(
    "SELECT " + _NAMED.format("rental_id, "
        "CAST(strftime(rental_date, '%Y%m%d') AS INT) AS rental_date_fk, "
        "CAST(strftime(return_date, '%Y%m%d') AS INT) AS return_date_fk") + " FROM merged",
    **_STAR, k1=_asof("r1", "di1", "ds1"),
    first=initial_sql("k1", ", ".join(_RENTED), start="last_update"),
    merged=merge_sql("first", "rk", "rental_id", _RENTED,
                     """NOT (o.return_date IS NULL AND s.return_date IS NOT NULL
                       AND o.inventory_id = s.inventory_id AND o.staff_id = s.staff_id
                       AND o.rental_date = s.rental_date)""",
                     start="s.last_update", overwrite=("return_date",),
                     first_if=_KEYS_FOUND, change_if=_KEYS_FOUND)))
def star_load_rental(spark, sf_dir):
    loaded = _star(spark, sf_dir)
    return _facts(loaded["fact_rental"], loaded, [
        "rental_id", "rental_date_fk", "return_date_fk", "inventory_id", "staff_id",
        "inventory_from", "staff_from",
    ])


# --- reports on a load, and full reloads -------------------------------------------


def _dropped_sql(step: str, rows: str, found: str) -> str:
    return f"""SELECT '{step}' AS step, count(*) AS staged_rows,
      CAST(coalesce(count_if(carried), 0) AS BIGINT) AS carried_rows,
      CAST(coalesce(count_if(NOT ({found})), 0) AS BIGINT) AS dropped_rows,
      CAST(coalesce(count_if(carried AND NOT ({found})), 0) AS BIGINT) AS carried_dropped_rows
      FROM {rows} s WHERE deleted IS NULL"""


@register("load_dropped", with_(" UNION ALL ".join([
    _dropped_sql("disks", "i2", "found"), _dropped_sql("people", "s2", "found"),
    _dropped_sql("payments", "pk", _KEYS_FOUND), _dropped_sql("rentals", "rk", _KEYS_FOUND)]), **_STAR))
def load_dropped(spark, sf_dir):
    """Undeleted rows of the second load that no lookup found a home for, new and carried over."""
    return _star(spark, sf_dir)["dropped"]


@register("star_load_marts", with_("""
SELECT 'day' AS mart, CAST(strftime(payment_date, '%Y%m%d') AS VARCHAR) AS name,
  CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM merged WHERE is_active GROUP BY ALL
UNION ALL
SELECT 'title', title, CAST(sum(amount) AS DECIMAL(28,2))
FROM merged m JOIN di2 d ON d.inventory_id = m.inventory_id AND d.effective_date_from = m.inventory_from
WHERE m.is_active GROUP BY ALL""",
    **_STAR, k1=_asof("p1", "di1", "ds1"), first=initial_sql("k1", ", ".join(_PAID)),
    merged=merge_sql("first", "pk", "payment_id", _PAID,
                     "o.amount <> s.amount OR o.payment_date <> s.payment_date",
                     overwrite=("inventory_id", "inventory_from", "staff_id", "staff_from"),
                     first_if=_KEYS_FOUND, change_if=_KEYS_FOUND, overwrite_if=_KEYS_FOUND)))
def star_load_marts(spark, sf_dir):
    """Both sales marts after two loads; the second adds and takes off what it changed."""
    loaded = _star(spark, sf_dir)
    days = loaded["sales_date"].select(F.lit("day").alias("mart"), F.col("date_sort").cast("string").alias("name"), "amount")
    titles = loaded["sales_film"].select(F.lit("title").alias("mart"), F.col("film_title").alias("name"), "amount")
    return days.unionByName(titles)


_PARTIAL = "inventory_id % 5 <> 0"


@register("late_keys", with_(f"""
SELECT payment_id, amount, rental_id, CAST(strftime(payment_date, '%Y%m%d') AS INT) AS payment_date_fk,
  inventory_id, {RANGE}, payment_id IN (SELECT payment_id FROM late) AS was_late FROM merged""",
    p1=payment(BEFORE), delta=f"SELECT * FROM ({payment(AFTER)}) WHERE {SINCE}",
    first=initial_sql(f"(SELECT * FROM p1 WHERE {_PARTIAL})", ", ".join(_PAID[:5])),
    late=f"SELECT * FROM p1 WHERE NOT ({_PARTIAL}) AND deleted IS NULL",
    ps=_restaged("SELECT * FROM delta", "late", "payment_id"),
    merged=merge_sql("first", "ps", "payment_id", _PAID[:5],
                     "o.amount <> s.amount OR o.payment_date <> s.payment_date",
                     overwrite=("inventory_id",))))
def late_keys(spark, sf_dir):
    """Two loads of payments; every fifth disk reaches the dimension between them.

    Payments of those disks find no version in the first load and wait for the
    second, which opens them although its delta does not have them.
    """
    days = calendar(spark, sf_dir)
    disks, people = [cut_lineage(add_history_columns(d)) for d in _dims(spark, sf_dir)]
    looked_up = {}

    def keep(name, rows):
        looked_up[name] = cut_lineage(rows)
        return looked_up[name]

    def load(target, staged, known, load_ts):
        rows = cut_lineage(star.load_fact_payment(target, staged, known, people, days, load_ts, keep))
        return rows, cut_lineage(star.unresolved(staged, looked_up["payments"], "payment_id"))

    staged = cut_lineage(star.restaged(S.payment(spark, sf_dir, BEFORE), None, "payment_id"))
    state, late = load(None, staged, disks.filter(_PARTIAL), BEFORE)
    delta = cut_lineage(delta_scan(S.payment(spark, sf_dir, AFTER), BEFORE))
    state, _ = load(state, star.restaged(delta, late, "payment_id"), disks, AFTER)
    named = state.join(disks.select(F.col("inventory_pk").alias("inventory_fk"), "inventory_id"), "inventory_fk")
    marked = named.join(late.select("payment_id", F.lit(True).alias("was_late")), "payment_id", "left")
    return versions(
        marked.withColumn("was_late", F.coalesce("was_late", F.lit(False))),
        "payment_id", "amount", "rental_id", "payment_date_fk", "inventory_id", "was_late",
    )


_FACT = {
    "k1": _asof("p1", "di1", "ds1"),
    "first": initial_sql("k1", ", ".join(_PAID)),
    "merged": merge_sql("first", "pk", "payment_id", _PAID,
                        "o.amount <> s.amount OR o.payment_date <> s.payment_date",
                        first_if=_KEYS_FOUND, change_if=_KEYS_FOUND),
}


@register("reconcile_counts", with_("""
SELECT 'source' AS layer, 'payment' AS table_name, count(*) AS row_count, count(*) AS active_rows,
  CAST(min(payment_date) AS DATE) AS min_date, CAST(max(payment_date) AS DATE) AS max_date FROM p
UNION ALL
SELECT 'staging', 'payment', count(*), count(*), CAST(min(payment_date) AS DATE),
  CAST(max(payment_date) AS DATE) FROM p2
UNION ALL
SELECT 'core', 'payment', count(*), count_if(is_active), CAST(min(payment_date) AS DATE),
  CAST(max(payment_date) AS DATE) FROM merged""", **_STAR, **_FACT, p=payment(AFTER)))
def reconcile_counts(spark, sf_dir):
    """Payments in source, staging and core after two loads."""
    loaded = _star(spark, sf_dir)
    fact = loaded["fact_payment"].withColumn(
        "day", F.to_date(F.col("payment_date_fk").cast("string"), "yyyyMMdd")
    )
    return (
        checks.reconcile_row("source", "payment", _source(spark, sf_dir, AFTER)["payment"], "payment_date")
        .unionByName(checks.reconcile_row("staging", "payment", loaded["payment"], "payment_date"))
        .unionByName(checks.reconcile_row("core", "payment", fact, "day", "is_active"))
    )


_ONE = "(SELECT max(payment_id) FROM p2)"


@register("key_trace", with_(f"""
SELECT 'source' AS table_name, count(*) AS row_count FROM p WHERE payment_id = {_ONE}
UNION ALL SELECT 'staging', count(*) FROM p2 WHERE payment_id = {_ONE}
UNION ALL SELECT 'core', count(*) FROM merged WHERE payment_id = {_ONE}""",
    **_STAR, **_FACT, p=payment(AFTER)))
def key_trace(spark, sf_dir):
    """One payment through the layers of a load: the newest staged one."""
    loaded = _star(spark, sf_dir)
    one = loaded["payment"].agg(F.max("payment_id")).first()[0]
    return checks.trace_key({
        "source": _source(spark, sf_dir, AFTER)["payment"], "staging": loaded["payment"],
        "core": loaded["fact_payment"],
    }, "payment_id", one)


_OPEN = {
    "od": "SELECT * FROM di2 WHERE is_active",
    "os": "SELECT * FROM ds2 WHERE is_active",
    "pa": payment(AFTER),
    "paid": "SELECT rental_id, count(*) AS cnt, sum(amount) AS amount FROM pa GROUP BY 1",
}


def _reloaded(spark, sf_dir, as_of_event):
    store, loaded = _loaded("star", spark, sf_dir, _load_star)
    facts = star.full_reload(
        _source(spark, sf_dir, AFTER), StoreSink(store, f"reload-{uuid.uuid4().hex}", AFTER),
        calendar(spark, sf_dir), as_of_event,
    )
    disks = loaded["dim_inventory"].select(
        F.col("inventory_pk").alias("inventory_fk"), "inventory_id",
        F.col("effective_date_from").alias("inventory_from"))
    people = loaded["dim_staff"].select(
        F.col("staff_pk").alias("staff_fk"), "staff_id", F.col("effective_date_from").alias("staff_from"))
    return {
        name: texts(rows.join(disks, "inventory_fk").join(people, "staff_fk").drop("inventory_fk", "staff_fk"),
                    "inventory_from", "staff_from")
        for name, rows in facts.items()
    }


def _reload_payment_sql(rows: str) -> str:
    return f"""SELECT payment_id, amount, CAST(strftime(payment_date, '%Y%m%d') AS INT) AS payment_date_fk,
      inventory_id, staff_id, {sql_text('inventory_from')} AS inventory_from,
      {sql_text('staff_from')} AS staff_from FROM {rows}"""


@register("full_reload_payment", with_(_reload_payment_sql("x"), **_STAR, **_OPEN, x="""
    SELECT p.*, di.effective_date_from AS inventory_from, ds.effective_date_from AS staff_from
    FROM pa p JOIN od di USING (inventory_id) JOIN os ds USING (staff_id)"""))
def full_reload_payment(spark, sf_dir):
    """All payment facts built again on the open dimension versions."""
    return _reloaded(spark, sf_dir, False)["payment"]


@register("fact_payment_asof", with_(_reload_payment_sql("x"), **_STAR, **_OPEN,
    x=_asof("pa", "di2", "ds2", "payment_date")))
def fact_payment_asof(spark, sf_dir):
    """All payment facts built again on the versions valid at the payment date."""
    return _reloaded(spark, sf_dir, True)["payment"]


@register("fact_rental_asof", with_(f"""
SELECT x.rental_id, CAST(strftime(rental_date, '%Y%m%d') AS INT) AS rental_date_fk,
  CAST(strftime(return_date, '%Y%m%d') AS INT) AS return_date_fk, coalesce(cnt, 1) AS cnt,
  CAST(paid.amount AS DECIMAL(18,2)) AS amount, inventory_id, staff_id,
  {sql_text('inventory_from')} AS inventory_from, {sql_text('staff_from')} AS staff_from
FROM x LEFT JOIN paid USING (rental_id)""", **_STAR, **_OPEN,
    x=_asof("r2", "di2", "ds2", "rental_date")))
def fact_rental_asof(spark, sf_dir):
    """All rental facts built again on the versions valid at the rental date."""
    return _reloaded(spark, sf_dir, True)["rental"]


_EMPTIED = {
    **_STAR, "pa": f"""SELECT p.* FROM ({payment(AFTER)}) p SEMI JOIN r2 USING (rental_id)""",
    "paid_rows": initial_sql(f"({_asof('pa', 'di2', 'ds2')})", ", ".join(_PAID)),
    "rented_rows": initial_sql(f"({_asof('r2', 'di2', 'ds2')})", ", ".join(_RENTED), start="last_update"),
}


@register("emptied_facts", with_(f"""
SELECT 'payment' AS fact, payment_id AS id, amount, CAST(strftime(payment_date, '%Y%m%d') AS INT) AS date_fk,
  inventory_id, staff_id, {sql_text('inventory_from')} AS inventory_from,
  {sql_text('staff_from')} AS staff_from, {RANGE} FROM paid_rows
UNION ALL
SELECT 'rental', rental_id, NULL, CAST(strftime(rental_date, '%Y%m%d') AS INT), inventory_id, staff_id,
  {sql_text('inventory_from')}, {sql_text('staff_from')}, {RANGE} FROM rented_rows""", **_EMPTIED))
def emptied_facts(spark, sf_dir):
    """Both facts as committed by a load that emptied them and filled them from the whole source."""
    store, _ = _loaded("star", spark, sf_dir, _load_star)
    sink = StoreSink(store, "emptied", RELOADED)
    star.load(_source(spark, sf_dir, AFTER), sink, calendar(spark, sf_dir), RELOADED, empty_facts=True)
    dims = {name: store.read(f"core.{name}") for name in ("dim_inventory", "dim_staff")}
    paid = store.read("core.fact_payment").select(
        F.lit("payment").alias("fact"), F.col("payment_id").alias("id"), "amount",
        F.col("payment_date_fk").alias("date_fk"), "inventory_fk", "staff_fk",
        "effective_date_from", "effective_date_to", "is_active")
    rented = store.read("core.fact_rental").select(
        F.lit("rental").alias("fact"), F.col("rental_id").alias("id"), F.lit(None).cast("decimal(8,2)").alias("amount"),
        F.col("rental_date_fk").alias("date_fk"), "inventory_fk", "staff_fk",
        "effective_date_from", "effective_date_to", "is_active")
    return _facts(paid.unionByName(rented), dims, [
        "fact", "id", "amount", "date_fk", "inventory_id", "staff_id", "inventory_from", "staff_from"])


_COMPARED = ["staff_id", "rental_id", "amount", "payment_date", "last_update", "deleted"]


@register("reconcile_rows", with_(f"""
SELECT payment_id, CAST(a.staff_id IS NOT NULL AS BIGINT) AS left_rows,
  CAST(b.staff_id IS NOT NULL AS BIGINT) AS right_rows,
  CASE WHEN a.staff_id IS NOT NULL AND b.staff_id IS NOT NULL THEN concat_ws(',',
    {", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _COMPARED)}) END AS differing
FROM a FULL JOIN b USING (payment_id)
WHERE a.staff_id IS NULL OR b.staff_id IS NULL
  OR {" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _COMPARED)}""",
    a=payment(BEFORE), b=payment(AFTER)))
def reconcile_rows(spark, sf_dir):
    """Payments that differ between two states of the source, with the columns that do."""
    # Both are read twice, for the digests and for the rows.
    before, after = [written_once(S.payment(spark, sf_dir, at)) for at in (BEFORE, AFTER)]
    found = checks.differing_rows(before, after, ["payment_id"], _COMPARED)
    listed = F.when(F.col("differing").isNotNull(), F.array_join("differing", ","))
    return found.withColumn("differing", listed)
