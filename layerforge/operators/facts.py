"""Dimension and fact builds of the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.operators.history import DEFAULT, Validity
from layerforge.operators.lookup import asof_lookup_sorted

FILM_COLUMNS = ["title", "rental_duration", "rental_rate", "length", "rating"]
STAFF_COLUMNS = ["staff_id", "first_name", "last_name", "address", "district", "city_name"]


def inventory_rows(inventory: DataFrame, film: DataFrame, how: str = "inner") -> DataFrame:
    """Disks with the attributes of their film; other inventory columns stay.

    A left join keeps disks without a film; ``found`` tells them apart.
    """
    films = film.select("film_id", *FILM_COLUMNS, F.lit(True).alias("found"))
    rows = inventory.join(films, "film_id", how)
    return rows if how == "left" else rows.drop("found")


def flatten_staff(
    staff: DataFrame, store: DataFrame, address: DataFrame, city: DataFrame, how: str = "inner"
) -> DataFrame:
    """Staff with the address of their store; other staff columns stay.

    A left join keeps staff without a place; ``found`` tells them apart.

    Store, address and city are joined to each other first: the chain of small
    tables collapses into one small side for the staff rows.
    """
    place = (
        store.select("store_id", "address_id")
        .join(address.select("address_id", "address", "district", "city_id"), "address_id")
        .join(city.select("city_id", F.col("city").alias("city_name")), "city_id")
        .select("store_id", "address", "district", "city_name", F.lit(True).alias("found"))
    )
    rows = staff.drop("address_id").join(place, "store_id", how)
    return rows if how == "left" else rows.drop("found")


def date_role(df: DataFrame, calendar: DataFrame, ts: str, fk: str, how: str = "inner") -> DataFrame:
    """Key of the calendar day of ``ts``; one call per role of the calendar."""
    role = calendar.select(
        F.col("date_actual").alias(f"_day_{fk}"), F.col("date_dim_pk").alias(fk)
    )
    return df.join(role, F.to_date(ts) == F.col(f"_day_{fk}"), how).drop(f"_day_{fk}")


def payment_totals(payment: DataFrame) -> DataFrame:
    """Payments per rental, so that the join to rentals does not fan out."""
    return payment.groupBy("rental_id").agg(
        F.count("*").alias("_n"), F.sum("amount").alias("_amount")
    )


def fact_payment(
    payment: DataFrame,
    rental: DataFrame,
    dim_inventory: DataFrame,
    dim_staff: DataFrame,
    calendar: DataFrame,
    history: Validity | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Payment facts, full reload; with ``history`` the keys are as of the payment date.

    ``keep`` may write the joined rows once: as-of lookups read them more than once.
    """
    paid = payment.select("payment_id", "amount", "payment_date", "rental_id", "staff_id")
    rows = keep(paid.join(rental.select("rental_id", "inventory_id"), "rental_id").drop("rental_id"))
    rows = _dimension_keys(rows, dim_inventory, dim_staff, "payment_date", history)
    rows = date_role(rows, calendar, "payment_date", "payment_date_fk")
    return rows.select("payment_id", "amount", "payment_date_fk", "inventory_fk", "staff_fk")


def fact_rental(
    rental: DataFrame,
    payment: DataFrame,
    dim_inventory: DataFrame,
    dim_staff: DataFrame,
    calendar: DataFrame,
    history: Validity | None = None,
) -> DataFrame:
    """One row per rental. ``cnt`` counts payments, 1 when there is none; ``amount`` may be NULL."""
    rows = rental.select("rental_id", "rental_date", "return_date", "inventory_id", "staff_id")
    rows = _dimension_keys(rows, dim_inventory, dim_staff, "rental_date", history)
    rows = date_role(rows, calendar, "rental_date", "rental_date_fk")
    rows = date_role(rows, calendar, "return_date", "return_date_fk", "left")
    return rows.join(payment_totals(payment), "rental_id", "left").select(
        "rental_id",
        "inventory_fk",
        "staff_fk",
        "rental_date_fk",
        "return_date_fk",
        F.coalesce("_n", F.lit(1)).alias("cnt"),
        F.col("_amount").alias("amount"),
    )


def fact_rental_coarse(
    rental: DataFrame, payment: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame
) -> DataFrame:
    """Rentals merged by disk, staff and both days; no rental id."""
    paid = rental.select(
        "rental_id", "inventory_id", "staff_id", "rental_date", "return_date"
    ).join(payment_totals(payment), "rental_id", "left")
    merged = paid.groupBy(
        "inventory_id",
        "staff_id",
        F.to_date("rental_date").alias("rental_date"),
        F.to_date("return_date").alias("return_date"),
    ).agg(F.sum("_amount").alias("amount"))
    return _dimension_keys(merged, dim_inventory, dim_staff, "rental_date", None).select(
        "inventory_fk", "staff_fk", "rental_date", "return_date", "amount"
    )


def _dimension_keys(
    rows: DataFrame,
    dim_inventory: DataFrame,
    dim_staff: DataFrame,
    ts: str,
    history: Validity | None,
    how: str = "inner",
) -> DataFrame:
    if history is None:
        disks = dim_inventory.select("inventory_id", F.col("inventory_pk").alias("inventory_fk"))
        people = dim_staff.select("staff_id", F.col("staff_pk").alias("staff_fk"))
        return rows.join(people, "staff_id", how).join(disks, "inventory_id", how)
    staffed = asof_lookup_sorted(
        rows, dim_staff, {"staff_id": "staff_id"}, ts, {"staff_fk": "staff_pk"}, how, v=history
    )
    return asof_lookup_sorted(
        staffed, dim_inventory, {"inventory_id": "inventory_id"}, ts,
        {"inventory_fk": "inventory_pk"}, how, v=history, sample_of=rows,
    )


def dimension_keys_asof(
    rows: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame, ts: str,
    v: Validity = DEFAULT, how: str = "inner",
) -> DataFrame:
    """Add ``inventory_fk`` and ``staff_fk`` of the versions valid at ``ts``."""
    return _dimension_keys(rows, dim_inventory, dim_staff, ts, v, how)
