"""Declared schemas of the rental source, as DDL strings."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the source tables.
SOURCE = {
    "film": """
        film_id short not null, title string not null, description string,
        release_year int, language_id short not null, rental_duration short not null,
        rental_rate decimal(4,2) not null, length short,
        replacement_cost decimal(5,2) not null, rating string,
        last_update timestamp_ntz not null, special_features array<string>""",
    "inventory": """
        inventory_id int not null, film_id short not null, store_id short not null,
        last_update timestamp_ntz not null, deleted timestamp_ntz""",
    "rental": """
        rental_id int not null, rental_date timestamp_ntz not null,
        inventory_id int not null, customer_id short not null,
        return_date timestamp_ntz, staff_id short not null,
        last_update timestamp_ntz not null, deleted timestamp_ntz""",
    "payment": """
        payment_id int not null, customer_id short not null, staff_id short not null,
        rental_id int not null, amount decimal(5,2) not null,
        payment_date timestamp_ntz not null, last_update timestamp_ntz not null,
        deleted timestamp_ntz""",
    "staff": """
        staff_id short not null, first_name string not null, last_name string not null,
        address_id short not null, email string, store_id short not null,
        active boolean not null, username string not null, password string,
        last_update timestamp_ntz not null, picture binary, deleted timestamp_ntz""",
    "store": """
        store_id short not null, manager_staff_id short not null,
        address_id short not null, last_update timestamp_ntz not null""",
    "address": """
        address_id int not null, address string not null, address2 string,
        district string not null, city_id short not null, postal_code string,
        phone string not null, last_update timestamp_ntz not null""",
    "city": """
        city_id short not null, city string not null, country_id short not null,
        last_update timestamp_ntz not null""",
    "actor": "actor_id int not null, last_name string not null",
    "film_actor": "film_id short not null, actor_id int not null",
    "customer": "customer_id short not null",
    "load_log": "table_name string not null, update_dt timestamp_ntz not null",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(" ".join(SOURCE[table].split()))


def columns(table: str) -> list[str]:
    return schema(table).names


# Columns that stamp a row rather than describe it; left out of row hashes.
STAMPS = ("last_update", "deleted")


def business_columns(table: str) -> list[str]:
    return [c for c in columns(table) if c not in STAMPS]
