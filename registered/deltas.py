"""Delta scans, load log, upserts, surrogate keys and appended rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerforge.operators import delta as D
from layerforge.operators import keys as K
from layerforge.operators import synthetic as G
from layerforge.sources import standins as S
from registered.base import (
    AFTER,
    BEFORE,
    FEED,
    ORIGIN,
    film,
    inventory,
    payment,
    register,
    rental,
    sql_text,
    text,
    texts,
    with_,
    staff,
)

FEED_MARK = "2024-01-20 00:00:00"
SINCE = f"(last_update >= TIMESTAMP '{BEFORE}' OR deleted >= TIMESTAMP '{BEFORE}')"


@register("full_refresh", with_(f"""
SELECT film_id, title, rental_duration, rental_rate, rating, {sql_text('last_update')}
  AS last_update FROM f""", f=film(AFTER)))
def full_refresh(spark, sf_dir):
    columns = ["film_id", "title", "rental_duration", "rental_rate", "rating", "last_update"]
    return texts(D.full_refresh(S.film(spark, sf_dir, AFTER), columns), "last_update")


@register("delta_scan", with_(f"""
SELECT event_id, user_id, event_type, value FROM feed
WHERE last_update >= TIMESTAMP '{FEED_MARK}' OR deleted >= TIMESTAMP '{FEED_MARK}'""", feed=FEED))
def delta_scan(spark, sf_dir):
    return D.delta_scan(S.event_feed(spark, sf_dir), FEED_MARK).select(
        "event_id", "user_id", "event_type", "value"
    )


@register("delta_scan_joined", with_(f"""
SELECT p.payment_id, p.amount, r.inventory_id AS rental_inventory_id
FROM p JOIN r USING (rental_id)
WHERE p.last_update >= TIMESTAMP '{BEFORE}' OR p.deleted >= TIMESTAMP '{BEFORE}'
  OR r.last_update >= TIMESTAMP '{BEFORE}'""", p=payment(AFTER), r=rental(AFTER)))
def delta_scan_joined(spark, sf_dir):
    rentals = S.rental(spark, sf_dir, AFTER).withColumnRenamed(
        "inventory_id", "rental_inventory_id"
    )
    return D.delta_scan_joined(
        S.payment(spark, sf_dir, AFTER), rentals, ["rental_id"], BEFORE, ["rental_inventory_id"]
    ).select("payment_id", "amount", "rental_inventory_id")


LOG_NAMES = ("click", "purchase", "refund", "view")


@register("watermark_lookup", f"""
SELECT name AS table_name, {sql_text(f"coalesce(max(ts), {ORIGIN})")} AS update_dt
FROM (VALUES ('click'), ('purchase'), ('refund'), ('view')) AS n(name)
  LEFT JOIN events ON event_type = name GROUP BY 1""")
def watermark_lookup(spark, sf_dir):
    names = spark.createDataFrame([(n,) for n in LOG_NAMES], "table_name string")
    return texts(D.watermarks(S.event_log(spark, sf_dir), names), "update_dt")


@register("watermark_log", f"""
SELECT table_name, {sql_text('update_dt')} AS update_dt
FROM (SELECT event_type AS table_name, ts AS update_dt FROM events
  UNION ALL SELECT 'rental', TIMESTAMP '{AFTER}' UNION ALL SELECT 'payment', TIMESTAMP '{AFTER}')
""")
def watermark_log(spark, sf_dir):
    log = D.log_load(S.event_log(spark, sf_dir), ["rental", "payment"], AFTER)
    return texts(log, "update_dt")


@register("previous_load_time", f"""
SELECT table_name, {sql_text('max(previous_dt)')} AS previous_dt
FROM (SELECT event_type AS table_name,
        lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS previous_dt FROM events)
GROUP BY 1""")
def previous_load_time(spark, sf_dir):
    return texts(D.previous_load_times(S.event_log(spark, sf_dir)), "previous_dt")


@register("delta_from_target", with_("""
SELECT payment_id, rental_id, staff_id, amount FROM new
WHERE last_update > (SELECT max(last_update) FROM old)""", old=payment(BEFORE), new=payment(AFTER)))
def delta_from_target(spark, sf_dir):
    """The target is the table as an earlier load left it."""
    rows, target = S.payment(spark, sf_dir, AFTER), S.payment(spark, sf_dir, BEFORE)
    return D.delta_from_target(rows, target).select("payment_id", "rental_id", "staff_id", "amount")


@register("delete_insert_upsert", with_(f"""
SELECT payment_id, rental_id, inventory_id, staff_id, amount, {sql_text('last_update')}
  AS last_update
FROM (SELECT * FROM old WHERE payment_id NOT IN (SELECT payment_id FROM new WHERE {SINCE})
  UNION ALL SELECT * FROM new WHERE {SINCE})""", old=payment(BEFORE), new=payment(AFTER)))
def delete_insert_upsert(spark, sf_dir):
    staged = D.delta_scan(S.payment(spark, sf_dir, AFTER), BEFORE)
    target = D.delete_insert(S.payment(spark, sf_dir, BEFORE), staged, ["payment_id"])
    return texts(
        target.select("payment_id", "rental_id", "inventory_id", "staff_id", "amount",
                      "last_update"),
        "last_update",
    )


@register("scd1_upsert_delete", with_(f"""
SELECT coalesce(d.inventory_id, o.inventory_id) AS inventory_id,
  coalesce(d.film_id, o.film_id) AS film_id, coalesce(d.store_id, o.store_id) AS store_id,
  o.inventory_pk
FROM (SELECT *, row_number() OVER (ORDER BY inventory_id) AS inventory_pk
      FROM old WHERE deleted IS NULL) o
  FULL JOIN (SELECT * FROM new WHERE {SINCE}) d USING (inventory_id)
WHERE d.deleted IS NULL""", old=inventory(BEFORE), new=inventory(AFTER)))
def scd1_upsert_delete(spark, sf_dir):
    columns = ["inventory_id", "film_id", "store_id"]
    old = S.inventory(spark, sf_dir, BEFORE).filter(F.col("deleted").isNull()).select(*columns)
    target = K.number_rows(old, ["inventory_id"], "inventory_pk")
    staged = D.delta_scan(S.inventory(spark, sf_dir, AFTER), BEFORE)
    return D.upsert(target, staged, ["inventory_id"], "deleted", keep=["inventory_pk"])


# --- surrogate keys ------------------------------------------------------------

_KEYS = """SELECT row_number() OVER (ORDER BY {k}) AS sk, {k} AS nk FROM {t}"""


def key_table(df, column):
    keyed = df.select(F.col(column).alias("nk"))
    empty = keyed.limit(0).select(F.lit(0).cast("long").alias("sk"), "nk")
    return K.assign_keys(keyed, empty, "nk")


@register("key_sync", with_("""
SELECT * FROM known
UNION ALL
SELECT (SELECT max(sk) FROM known) + row_number() OVER (ORDER BY rental_id) AS sk, rental_id AS nk
FROM new WHERE rental_id NOT IN (SELECT nk FROM known)""",
    old=rental(BEFORE), new=rental(AFTER), known=_KEYS.format(k="rental_id", t="old")))
def key_sync(spark, sf_dir):
    known = key_table(S.rental(spark, sf_dir, BEFORE), "rental_id")
    staged = S.rental(spark, sf_dir, AFTER).select(F.col("rental_id").alias("nk"))
    return K.assign_keys(staged, known, "nk")


def _maps(spark, sf_dir):
    old = S.inventory(spark, sf_dir, BEFORE)
    return {
        "inventory_id": key_table(old, "inventory_id"),
        "film_id": key_table(S.film(spark, sf_dir, BEFORE), "film_id"),
        "store_id": key_table(S.store(spark, sf_dir), "store_id"),
    }


_MAPS = {
    "old": inventory(BEFORE),
    "new": inventory(AFTER),
    "films": film(BEFORE),
    "ri": _KEYS.format(k="inventory_id", t="old"),
    "rf": _KEYS.format(k="film_id", t="films"),
    "rs": _KEYS.format(k="s_suppkey", t="supplier"),
}


@register("key_translate", with_(f"""
SELECT ri.sk AS inventory_id, rf.sk AS film_id, rs.sk AS store_id, {sql_text('last_update')}
  AS last_update
FROM new JOIN ri ON ri.nk = inventory_id JOIN rf ON rf.nk = film_id JOIN rs ON rs.nk = store_id""",
    **_MAPS))
def key_translate(spark, sf_dir):
    rows = S.inventory(spark, sf_dir, AFTER).select(
        "inventory_id", "film_id", "store_id", "last_update"
    )
    return texts(K.translate_keys(rows, _maps(spark, sf_dir)), "last_update")


@register("key_translate_dropped", with_("""
SELECT 'inventory_id' AS key_column, count(*) AS dropped_rows FROM new
WHERE inventory_id NOT IN (SELECT nk FROM ri)
UNION ALL SELECT 'film_id', count(*) FROM new WHERE film_id NOT IN (SELECT nk FROM rf)
UNION ALL SELECT 'store_id', count(*) FROM new WHERE store_id NOT IN (SELECT nk FROM rs)""",
    **_MAPS))
def key_translate_dropped(spark, sf_dir):
    return K.count_untranslated(S.inventory(spark, sf_dir, AFTER), _maps(spark, sf_dir))


# --- appended rows -------------------------------------------------------------


@register("append_rows", with_(f"""
SELECT inventory_id, film_id, store_id, {sql_text('last_update')} AS last_update FROM i
UNION ALL
SELECT (SELECT max(inventory_id) FROM i) + row_number() OVER (ORDER BY p_partkey), p_partkey, 1,
  '{AFTER}.000000' FROM part""", i=inventory(AFTER)))
def append_rows(spark, sf_dir):
    disks = S.inventory(spark, sf_dir, AFTER).drop("deleted")
    wanted = S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"), F.lit(1).cast("long").alias("store_id")
    )
    added = K.number_rows(wanted, ["film_id"], "inventory_id", K.max_key(disks, "inventory_id"))
    return texts(D.append_rows(disks, added, AFTER, "last_update"), "last_update")


def _picked(column: str, table: str) -> str:
    return f"""CAST('0x' || substr(md5(i || ':{column}'), 1, 15) AS BIGINT)
      % (SELECT max({column}) - min({column}) + 1 FROM {table})
      + (SELECT min({column}) FROM {table})"""


@register("synthetic_facts", with_(f"""
SELECT i + (SELECT max(o_orderkey) FROM orders) + 1 AS rental_id,
  (SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY AS rental_date,
  (SELECT max(o_orderdate) FROM orders) + INTERVAL 8 DAY AS return_date,
  {_picked("inventory_id", "disks")} AS inventory_id, {_picked("customer_id", "people")} AS customer_id,
  {_picked("staff_id", "crew")} AS staff_id, {sql_text(f"TIMESTAMP '{AFTER}'")} AS last_update
FROM (SELECT unnest(range((SELECT count(*) FROM customer))) AS i)""",
    disks=inventory(AFTER), people="SELECT c_custkey AS customer_id FROM customer", crew=staff(AFTER)))
def synthetic_facts(spark, sf_dir):
    """Rentals with disk, customer and staff from the id ranges of their own tables."""
    people = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    ranges = {
        "inventory_id": G.id_range(S.inventory(spark, sf_dir, AFTER), "inventory_id"),
        "customer_id": G.id_range(people, "customer_id"),
        "staff_id": G.id_range(S.staff(spark, sf_dir, AFTER), "staff_id"),
    }
    added = G.synthetic_rentals(S.rental_rows(spark, sf_dir), people.count(), ranges, AFTER)
    return added.withColumn("last_update", text("last_update"))


@register("fill_random", """
SELECT round(avg(v), 6) AS avg_value FROM (
  SELECT l_discount AS v FROM lineitem
  UNION ALL
  SELECT CAST(CAST('0x' || substr(md5(i || ':7'), 1, 15) AS BIGINT) AS DOUBLE)
    / CAST(1152921504606846976 AS DOUBLE)
  FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS i))""")
def fill_random(spark, sf_dir):
    discounts = S.table(spark, sf_dir, "lineitem").select("l_discount")
    filled = G.fill_random(discounts, "l_discount", S.table(spark, sf_dir, "orders").count(), 7)
    return filled.select(F.round("avg_value", 6).alias("avg_value"))
