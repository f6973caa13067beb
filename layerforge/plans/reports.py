"""Reports and analytic functions.

Money is summed per join key before each join, so a hot film, disk or day is a
handful of partial sums by the time it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.functions.dates import day_title, day_title_or_null
from layerforge.functions.scalars import contains_text
from layerforge.operators.lookup import current_version


MONEY = "decimal(28,2)"


def payment_sums(fact_payment: DataFrame, sign: int = 1) -> DataFrame:
    """Signed amounts and numbers of payments per day and disk version."""
    return fact_payment.groupBy("payment_date_fk", "inventory_fk").agg(
        (sign * F.sum("amount")).cast(MONEY).alias("amount"), F.lit(sign).cast("long").alias("sign"),
        F.count("*").alias("n"),
    ).select("payment_date_fk", "inventory_fk", "amount", (F.col("sign") * F.col("n")).alias("n"))


def changed_sums(
    before: DataFrame | None, after: DataFrame, keys: DataFrame | None, key: str, active: str
) -> DataFrame:
    """What a load changed in the sums over open rows: its keys' rows after it, less those before.

    ``keys`` are few against the fact: they are looked up from its side, and rows
    of other keys reach no aggregate and no shuffle. None stands for all keys.
    """
    def of(rows: DataFrame, sign: int) -> DataFrame:
        rows = rows.filter(F.col(active) & F.col(key).isNotNull())
        return payment_sums(rows if keys is None else rows.join(keys, key, "left_semi"), sign)

    return of(after, 1) if before is None else of(after, 1).unionByName(of(before, -1))


def added_up(sums: DataFrame | None, changes: DataFrame, by: str) -> DataFrame:
    """Committed sums per ``by`` with the changes added; what has no payment left is gone."""
    rows = changes.select(by, "amount", "n")
    if sums is not None:
        rows = rows.unionByName(sums.select(by, "amount", "n"))
    return rows.groupBy(by).agg(F.sum("amount").cast(MONEY).alias("amount"), F.sum("n").alias("n")).filter("n <> 0")


def titled(sums: DataFrame, dim_inventory: DataFrame) -> DataFrame:
    """Sums per disk version as sums per film title."""
    titles = dim_inventory.select(F.col("inventory_pk").alias("inventory_fk"), F.col("title").alias("film_title"))
    return sums.join(titles, "inventory_fk").groupBy("film_title").agg(
        F.sum("amount").cast(MONEY).alias("amount"), F.sum("n").alias("n")
    )


def day_report(per_day: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sums per day key with the day written out."""
    title = day_title_or_null(F.col("day_of_month"), F.col("month_name"), F.col("year_actual"))
    return per_day.join(calendar, F.col("payment_date_fk") == F.col("date_dim_pk")).select(
        title.alias("date_title"), "amount", F.col("date_dim_pk").alias("date_sort")
    )


def sales_by_date_star(fact_payment: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sum per payment day with the day written out."""
    return day_report(fact_payment.groupBy("payment_date_fk").agg(F.sum("amount").alias("amount")), calendar)


def sales_by_title_star(fact_payment: DataFrame, dim_inventory: DataFrame) -> DataFrame:
    """Sum per film title; films sharing a title are one row."""
    per_disk = fact_payment.groupBy("inventory_fk").agg(F.sum("amount").alias("amount"))
    return (
        per_disk.join(
            dim_inventory.select("inventory_pk", "title"),
            F.col("inventory_fk") == F.col("inventory_pk"),
        )
        .groupBy(F.col("title").alias("film_title"))
        .agg(F.sum("amount").alias("amount"))
    )


def sales_by_date(payment: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sum per payment day over payments that were not deleted."""
    per_day = (
        payment.filter(F.col("deleted").isNull())
        .groupBy(F.to_date("payment_date").alias("date_actual"))
        .agg(F.sum("amount").alias("amount"))
    )
    return per_day.join(calendar, "date_actual").select(
        F.col("date_id").alias("sales_date_rn"),
        day_title(F.col("day_of_month"), F.col("month_name"), F.col("year")).alias(
            "sales_date_title"
        ),
        F.col("amount").cast("double").alias("amount"),
    )


def sales_by_film(
    payment: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    active_only: bool = True,
) -> DataFrame:
    """Sum per film over undeleted payments of undeleted rentals.

    Versioned disks and films count once by their active version;
    ``active_only`` False joins every version, so amounts repeat after a change.
    """
    if active_only:
        inventory = current_version(inventory)
        film = current_version(film)
    per_rental = (
        payment.filter(F.col("deleted").isNull())
        .groupBy("rental_id")
        .agg(F.sum("amount").alias("amount"))
    )
    live = rental.filter(F.col("deleted").isNull()).select("rental_id", "inventory_id")
    per_disk = per_rental.join(live, "rental_id").groupBy("inventory_id").agg(
        F.sum("amount").alias("amount")
    )
    per_film = (
        per_disk.join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_film.join(film.select("film_id", "title"), "film_id")
        .groupBy("film_id", "title")
        .agg(F.sum("amount").alias("amount"))
        .select(
            F.col("film_id").alias("sales_film_rn"),
            F.col("title").alias("sales_film_title"),
            F.col("amount").cast("double").alias("amount"),
        )
    )


def film_counts(
    film: DataFrame, inventory: DataFrame, rental: DataFrame, ratings: list[str]
) -> DataFrame:
    """Disks and rentals per film of the given ratings that was rented at all."""
    rentals_per_disk = rental.groupBy("inventory_id").agg(F.count("*").alias("rentals"))
    per_film = (
        inventory.select("inventory_id", "film_id")
        .join(rentals_per_disk, "inventory_id", "left")
        .groupBy("film_id")
        .agg(
            F.count("inventory_id").alias("count_inventory_film"),
            F.coalesce(F.sum("rentals"), F.lit(0)).alias("count_rental_film"),
        )
        .filter(F.col("count_rental_film") > 0)
    )
    chosen = film.filter(F.col("rating").isin(*ratings)).select("film_id", "title")
    return chosen.join(per_film, "film_id").select(
        "film_id", F.col("title").alias("film_title"), "count_inventory_film", "count_rental_film"
    )


def amount_per_day(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, film_id: int
) -> DataFrame:
    """Payments of one film per day, zero amounts left out, oldest day first."""
    disks = inventory.filter(F.col("film_id") == film_id).select("inventory_id")
    rentals = rental.select("rental_id", "inventory_id").join(disks, "inventory_id")
    paid = payment.filter(F.col("amount") != 0).select("rental_id", "payment_date", "amount")
    day = F.date_trunc("day", "payment_date").cast("timestamp_ntz")
    return (
        paid.join(rentals, "rental_id")
        .groupBy(day.alias("payment_day"))
        .agg(F.sum("amount").alias("amount"))
        .orderBy("payment_day")
    )


def rating_stats(
    film: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
    last_name: str | None = None,
) -> DataFrame:
    """Per surname and rating: films, revenue per film, disks per film.

    Films without disks or payments count in the denominator only; a rating
    where no film has both is left out. ``last_name`` None gives all surnames.
    """
    actors = actor if last_name is None else actor.filter(F.col("last_name") == last_name)
    chosen = (
        film_actor.select("film_id", "actor_id")
        .join(actors.select("actor_id", "last_name"), "actor_id")
        .select("last_name", "film_id")
        .distinct()
        .join(film.filter(F.col("rating").isNotNull()).select("film_id", "rating"), "film_id")
    )
    paid_per_disk = (
        payment.groupBy("rental_id")
        .agg(F.sum("amount").alias("amount"))
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("amount").alias("amount"))
    )
    per_film = (
        inventory.select("inventory_id", "film_id")
        .join(paid_per_disk, "inventory_id", "left")
        .groupBy("film_id")
        .agg(F.count("*").alias("disks"), F.sum("amount").alias("amount"))
        .filter(F.col("amount").isNotNull())
    )
    return (
        chosen.join(per_film, "film_id", "left")
        .groupBy("last_name", F.col("rating").alias("film_rating"))
        .agg(
            F.count("*").alias("total_count_film"),
            F.sum("amount").alias("amount"),
            F.sum(F.when(F.col("amount").isNotNull(), F.col("disks"))).alias("disks"),
        )
        .filter(F.col("disks").isNotNull())
        .select(
            "last_name",
            "film_rating",
            "total_count_film",
            (F.col("amount").cast("double") / F.col("total_count_film")).alias(
                "avg_amount_per_film"
            ),
            (F.col("disks").cast("double") / F.col("total_count_film")).alias(
                "avg_count_disk_per_film"
            ),
        )
    )


def titles_by_duration(film: DataFrame, duration: int) -> DataFrame:
    return film.filter(F.col("rental_duration") == duration).select("title")


def titles_containing(film: DataFrame, fragment: str) -> DataFrame:
    return film.filter(contains_text(F.col("title"), fragment)).select("title")
