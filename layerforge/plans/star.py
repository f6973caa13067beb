"""Star-schema load with history in dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.functions.dates import ORIGIN, ntz
from layerforge.operators.delta import Stamp, delta_scan, delta_scan_joined, latest_per_key
from layerforge.operators.facts import (
    FILM_COLUMNS,
    STAFF_COLUMNS,
    date_role,
    dimension_keys_asof,
    fact_payment,
    fact_rental,
    flatten_staff,
    inventory_rows,
)
from layerforge.operators.history import (
    DEFAULT,
    Rule,
    add_history_columns,
    scd2_merge,
    split_by_parent,
)
from layerforge.operators.keys import fill_keys
from layerforge.plans.reports import added_up, changed_sums, day_report, titled
from layerforge.plans.sinks import StoreSink
from layerforge.plans.steps import side_by_side
from layerforge.session import free_shuffles

TOUCHED = Rule(change="touched", snapshot=False)
# A staged row whose lookups fail opens no version, but it still closes one.
LOOKED_UP = replace(TOUCHED, if_first="found", if_changed="found")

Keep = Callable[[str, DataFrame], DataFrame]


def unkept(name: str, rows: DataFrame) -> DataFrame:
    """Intermediate rows as they are; a load passes a function that writes them once."""
    return rows


# Key of each table that may hold rows whose lookups find nothing yet.
LATE_KEY = {
    "inventory": "inventory_id", "staff": "staff_id", "payment": "payment_id", "rental": "rental_id",
}


def restaged(delta: DataFrame, late: DataFrame | None, key: str) -> DataFrame:
    """The delta and the rows carried over from earlier loads; ``carried`` tells them apart.

    A key in the delta has its newest state there, which takes the place of the
    one carried over, also when it says that the row was deleted.
    """
    rows = delta.withColumn("carried", F.lit(False))
    if late is None:
        return rows
    waiting = late.join(delta.select(key).distinct(), key, "left_anti")
    return rows.unionByName(waiting.withColumn("carried", F.lit(True)).select(*rows.columns))


def unresolved(
    staged: DataFrame, looked_up: DataFrame, key: str, loaded: DataFrame | None = None
) -> DataFrame:
    """Staged rows to carry over: the newest of their key, not deleted, lookups in vain.

    Their own stamp is older than the next mark, so no later delta has them.
    ``looked_up`` are the same rows with ``found``. Where a row may take effect
    although a lookup failed, ``loaded`` (the table after the load) says so: a
    key with an open version there is not carried over.
    """
    def newest(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, [key], [F.col("last_update").desc(), F.xxhash64(*rows.columns)])

    in_vain = F.col("deleted").isNull() & ~F.coalesce("found", F.lit(False))
    # A key whose newest row looked up in vain has such a row: only those keys' rows are ranked.
    vain_keys = looked_up.filter(in_vain).select(key).distinct()
    # Where they are many, all rows are shuffled for it: only what decides the rank goes along.
    marks = looked_up.select(
        key, "last_update", F.xxhash64(*looked_up.columns).alias("_tie"), in_vain.alias("_vain")
    ).join(vain_keys, key, "left_semi")
    keys = latest_per_key(marks, [key], [F.col("last_update").desc(), F.col("_tie")]).filter("_vain").select(key)
    if loaded is not None:
        # The few keys go to the large table, not the other way round.
        open_ = loaded.filter(F.col(DEFAULT.active)).select(key).join(keys, key, "left_semi")
        keys = keys.join(open_, key, "left_anti")
    return newest(staged.drop("carried").join(keys, key, "left_semi"))


def _carried(rows: DataFrame) -> list[str]:
    return [c for c in ("carried",) if c in rows.columns]


def _start(rows: DataFrame, columns: list[str], pk: str) -> DataFrame:
    """Empty target: key, business columns, validity."""
    empty = rows.limit(0).select(F.lit(None).cast("long").alias(pk), *columns)
    return add_history_columns(empty)


def load_dim_inventory(
    target: DataFrame | None,
    inventory_delta: DataFrame,
    film: DataFrame,
    film_changed_since: Stamp | None,
    load_ts: Stamp,
    keep: Keep = unkept,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """Disk dimension: staged disks make versions, then changed films split them.

    ``target`` may hold the touched disks only, all versions of each (see
    ``touched_disks``); ``numbered`` is then the whole dimension, whose keys are
    numbered on.
    """
    rows = keep("disks", inventory_rows(inventory_delta, film, "left"))
    if target is None:
        target = _start(rows, ["inventory_id", "film_id", *FILM_COLUMNS], "inventory_pk")
    merged = scd2_merge(target, rows, ["inventory_id"], LOOKED_UP, load_ts)
    split = split_by_parent(
        merged, film, ["film_id"], FILM_COLUMNS, film_changed_since,
        new_version=["inventory_pk"],
    )
    known = target if numbered is None else numbered
    return fill_keys(keep("disk_versions", split), "inventory_pk", ["inventory_id", DEFAULT.start], known)


def touched_disks(
    target: DataFrame, staged: DataFrame, film: DataFrame, film_changed_since: Stamp | None
) -> DataFrame:
    """Disks whose versions a load may change: the staged ones and all that had a changed film.

    The film of any version counts, a closed one too: a change may lie inside it.
    """
    keys = staged.select("inventory_id")
    if film_changed_since is not None:
        films = film.filter(F.col("last_update") >= ntz(film_changed_since)).select("film_id")
        keys = keys.unionByName(target.join(films, "film_id", "left_semi").select("inventory_id"))
    return keys.distinct()


def load_dim_staff(
    target: DataFrame | None,
    staff_delta: DataFrame,
    store: DataFrame,
    address: DataFrame,
    city: DataFrame,
    load_ts: Stamp,
    keep: Keep = unkept,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """Staff dimension with the address of the store; ``target`` and ``numbered`` as for disks."""
    rows = keep("people", flatten_staff(staff_delta, store, address, city, "left"))
    if target is None:
        target = _start(rows, STAFF_COLUMNS, "staff_pk")
    merged = scd2_merge(target, rows, ["staff_id"], LOOKED_UP, load_ts)
    known = target if numbered is None else numbered
    return fill_keys(keep("people_versions", merged), "staff_pk", ["staff_id", DEFAULT.start], known)


PAYMENT_COLUMNS = [
    "payment_id", "amount", "payment_date_fk", "inventory_fk", "staff_fk", "rental_id"
]
PAYMENT_RULE = Rule(
    change="tracked",
    tracked=["amount", "payment_date_fk", "rental_id"],
    inplace_columns=["inventory_fk", "staff_fk"],
    snapshot=False,
)


def _found(*keys: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def load_fact_payment(
    target: DataFrame | None,
    payment_delta: DataFrame,
    dim_inventory: DataFrame,
    dim_staff: DataFrame,
    calendar: DataFrame,
    load_ts: Stamp,
    keep: Keep = unkept,
    keep_closed: bool = True,
) -> DataFrame:
    """Amount, day and rental make versions; disk and staff keys are overwritten.

    A payment without a valid disk, staff member or day opens no version and
    overwrites no key; its deletion or change still closes the old version.
    """
    staged = payment_delta.select(
        "payment_id", "amount", "payment_date", "rental_id", "inventory_id", "staff_id",
        "last_update", "deleted", *_carried(payment_delta),
    )
    rows = dimension_keys_asof(staged, dim_inventory, dim_staff, "last_update", how="left")
    rows = date_role(rows, calendar, "payment_date", "payment_date_fk", "left")
    rows = keep("payments", rows.select(
        *PAYMENT_COLUMNS, "last_update", "deleted",
        _found("inventory_fk", "staff_fk").alias("keys_found"),
        _found("inventory_fk", "staff_fk", "payment_date_fk").alias("found"), *_carried(rows),
    ))
    if target is None:
        target = _start(rows, PAYMENT_COLUMNS, "payment_pk")
    rule = replace(PAYMENT_RULE, if_first="found", if_changed="found", if_overwritten="keys_found")
    merged = scd2_merge(target, rows, ["payment_id"], rule, load_ts, keep_closed=keep_closed)
    return fill_keys(keep("payment_versions", merged), "payment_pk", ["payment_id", DEFAULT.start], target)


RENTAL_COLUMNS = [
    "rental_id", "inventory_id", "staff_id",
    "inventory_fk", "staff_fk", "rental_date_fk", "return_date_fk",
]


def only_returned(require_return_before: bool = False):
    """In-place rule of rentals: same disk, staff and day, and a return date arrived.

    ``require_return_before`` asks for a fact that already had one instead.
    """

    def rule(old, new) -> Column:
        had_return = old("return_date_fk").isNotNull()
        return (
            new("return_date_fk").isNotNull()
            & (had_return if require_return_before else ~had_return)
            & old("inventory_id").eqNullSafe(new("inventory_id"))
            & old("staff_id").eqNullSafe(new("staff_id"))
            & old("rental_date_fk").eqNullSafe(new("rental_date_fk"))
        )

    return rule


def rental_rule(require_return_before: bool = False) -> Rule:
    return Rule(
        change="touched",
        snapshot=False,
        open_from="change",
        inplace=only_returned(require_return_before),
        inplace_columns=["return_date_fk"],
    )


def load_fact_rental(
    target: DataFrame | None,
    rental_delta: DataFrame,
    dim_inventory: DataFrame,
    dim_staff: DataFrame,
    calendar: DataFrame,
    load_ts: Stamp,
    require_return_before: bool = False,
    keep: Keep = unkept,
    keep_closed: bool = True,
) -> DataFrame:
    """A return date that arrives is filled in; any other staged change is a version.

    The fact keeps the natural disk and staff ids beside the version keys, so
    "same disk" needs no join back to the dimensions. A first version needs
    disk, staff and rental day; the version after a change needs disk and staff.
    """
    staged = rental_delta.select(
        "rental_id", "rental_date", "return_date", "inventory_id", "staff_id",
        "last_update", "deleted", *_carried(rental_delta),
    )
    rows = dimension_keys_asof(staged, dim_inventory, dim_staff, "last_update", how="left")
    rows = date_role(rows, calendar, "rental_date", "rental_date_fk", "left")
    rows = date_role(rows, calendar, "return_date", "return_date_fk", "left")
    rows = keep("rentals", rows.select(
        *RENTAL_COLUMNS, "last_update", "deleted",
        _found("inventory_fk", "staff_fk").alias("keys_found"),
        _found("inventory_fk", "staff_fk", "rental_date_fk").alias("found"), *_carried(rows),
    ))
    if target is None:
        target = _start(rows, RENTAL_COLUMNS, "rental_pk")
    rule = replace(rental_rule(require_return_before), if_first="found", if_changed="keys_found")
    merged = scd2_merge(target, rows, ["rental_id"], rule, load_ts, keep_closed=keep_closed)
    return fill_keys(keep("rental_versions", merged), "rental_pk", ["rental_id", DEFAULT.start], target)


def _staged(
    source: dict[str, DataFrame], sink: StoreSink, empty_facts: bool = False
) -> dict[str, DataFrame]:
    """Changed rows of the four delta tables since their last load, the others whole.

    Payments and rentals are staged whole for facts that are built again.
    """
    def since(name: str) -> Stamp:
        return ORIGIN if empty_facts else sink.mark(f"staging.{name}")

    with_disk = source["payment"].drop("inventory_id")
    scans = {
        "film": source["film"],
        "inventory": delta_scan(source["inventory"], sink.mark("staging.inventory")),
        "rental": delta_scan(source["rental"], since("rental")),
        "payment": delta_scan_joined(
            with_disk, source["rental"], ["rental_id"], since("payment"), ["inventory_id"]
        ),
        "staff": delta_scan(source["staff"], sink.mark("staging.staff")),
        "store": source["store"],
        "address": source["address"],
        "city": source["city"],
    }
    return side_by_side(scans, lambda name: sink.put(f"staging.{name}", scans[name]))


def load(
    source: dict[str, DataFrame], sink: StoreSink, calendar: DataFrame, load_ts: Stamp,
    empty_facts: bool = False,
) -> dict[str, DataFrame]:
    """One load of the star schema; what is new follows from the load log.

    Dimensions come before facts: facts look up versions as of ``last_update``.
    A dimension gets all versions of the keys the load touches; the others are
    read from where they are. Staged rows whose lookups find nothing are carried
    over to the next load.

    ``empty_facts`` empties both facts and fills them from the whole source, on
    the dimensions with their history; the marts follow. All of it shows with the
    load's one commit, and the next load goes on from there.
    """
    film_mark = sink.mark("staging.film") if sink.known("staging.film") else None
    staged = _staged(source, sink, empty_facts)

    def keep(name: str, rows: DataFrame) -> DataFrame:
        kept = sink.put(f"work.{name}", rows)
        if name in ("payments", "rentals", "payment_versions", "rental_versions"):
            free_shuffles(kept.sparkSession)  # a fact's steps are the largest of a load
        return kept

    def rows_of(name: str) -> DataFrame:
        again = empty_facts and name in ("payment", "rental")  # the whole source has the late rows too
        late = None if again else sink.get(f"staging.late_{name}")
        rows = restaged(staged[name], late, LATE_KEY[name])
        return rows if late is None else keep(f"staged_{name}", rows)  # the staged rows are files already

    def carry_over(name: str, rows: DataFrame, step: str, loaded: DataFrame | None = None) -> None:
        late = unresolved(rows, sink.get(f"work.{step}"), LATE_KEY[name], loaded)
        sink.put(f"staging.late_{name}", late)

    def to_dimension(name: str) -> DataFrame:
        before, key = sink.get(f"core.{name}"), "inventory_id" if name == "dim_inventory" else "staff_id"
        given = rows_of("inventory" if name == "dim_inventory" else "staff")
        mine = before
        if before is not None:
            touched = given.select(key).distinct()
            if name == "dim_inventory":
                touched = touched_disks(before, given, staged["film"], film_mark)
            # The few keys go to the large table, not the other way round.
            mine = keep(f"touched_{name}", before.join(touched, key, "left_semi"))
        if name == "dim_inventory":
            rows = load_dim_inventory(mine, given, staged["film"], film_mark, load_ts, keep, before)
            carry_over("inventory", given, "disks")
        else:
            rows = load_dim_staff(
                mine, given, staged["store"], staged["address"], staged["city"], load_ts, keep, before
            )
            carry_over("staff", given, "people")
        # Few rows of touched keys come from many partitions: their files would be mostly footers.
        return sink.upsert(f"core.{name}", rows if before is None else rows.hint("rebalance"), key)

    dims = side_by_side(["dim_inventory", "dim_staff"], to_dimension)

    def to_fact(name: str) -> DataFrame:
        build, source_name = (
            (load_fact_payment, "payment") if name == "fact_payment" else (load_fact_rental, "rental")
        )
        given = rows_of(source_name)
        changes = build(
            None if empty_facts else sink.get(f"core.{name}"), given, dims["dim_inventory"], dims["dim_staff"], calendar,
            load_ts, keep=keep, keep_closed=False,
        )
        write = sink.replace if empty_facts else sink.versions
        loaded = write(f"core.{name}", changes, DEFAULT.active)
        # A rental may be returned, or change, while its disk or day is unknown.
        carry_over(source_name, given, f"{source_name}s", loaded if source_name == "rental" else None)
        return loaded

    facts = side_by_side(["fact_payment", "fact_rental"], to_fact)

    reports = _marts(sink, facts["fact_payment"], dims["dim_inventory"], calendar, empty_facts)
    dropped = sink.put("report.dropped", dropped_rows(sink))
    sink.commit()
    return {**staged, **dims, **facts, **reports, "dropped": dropped}


def _marts(
    sink: StoreSink, fact: DataFrame, dim_inventory: DataFrame, calendar: DataFrame, rebuilt: bool
) -> dict[str, DataFrame]:
    """Both sales marts, kept up from what this load changed in the payment fact.

    The sums per day and per film title of the load before get the amounts of
    the staged payments' open rows added and those they had before taken off: a
    disk version's title never changes, so only those rows can move a sum.
    Without sums of a load before, or if the fact was rebuilt, all open rows are
    added.
    """
    keys, before = sink.get("work.payments").select("payment_id").distinct(), sink.before("core.fact_payment")
    names = {"core.sums_by_day": "payment_date_fk", "core.sums_by_title": "film_title"}
    known = {name: sink.get(name) for name in names}
    if rebuilt or any(rows is None for rows in known.values()):
        known, before, keys = dict.fromkeys(names), None, None
    changes = sink.put("work.payment_sums", changed_sums(before, fact, keys, "payment_id", DEFAULT.active))
    moved = {"core.sums_by_day": changes, "core.sums_by_title": titled(changes, dim_inventory)}
    sums = side_by_side(names, lambda n: sink.put(n, added_up(known[n], moved[n], names[n])))
    marts = {
        "sales_date": day_report(sums["core.sums_by_day"], calendar),
        "sales_film": sums["core.sums_by_title"].select("film_title", "amount"),
    }
    return side_by_side(marts, lambda name: sink.put(f"report.{name}", marts[name]))


_STEPS = ("disks", "people", "payments", "rentals")


def dropped_rows(sink: StoreSink) -> DataFrame:
    """Staged, undeleted rows of this load whose lookups found no film, place, version or day.

    ``carried_rows`` of the staged ones were carried over from earlier loads, and
    ``carried_dropped_rows`` of those again found nothing.
    """
    out = None
    for name in _STEPS:
        rows = sink.get(f"work.{name}").filter(F.col("deleted").isNull())
        vain = ~F.coalesce("found", F.lit(False))
        one = rows.agg(
            F.count("*").alias("staged_rows"), F.count_if("carried").alias("carried_rows"),
            F.count_if(vain).alias("dropped_rows"),
            F.count_if(vain & F.col("carried")).alias("carried_dropped_rows"),
        ).select(F.lit(name).alias("step"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def full_reload(
    source: dict[str, DataFrame], sink: StoreSink, calendar: DataFrame, as_of_event: bool = False
) -> dict[str, DataFrame]:
    """Facts without history built again from the source, on the dimensions in the store.

    They are written beside the facts of ``load``, which has ``empty_facts`` to
    replace its own. ``as_of_event`` takes the dimension versions valid at the
    event's date, otherwise the open ones are taken.
    """
    disks, people = sink.get("core.dim_inventory"), sink.get("core.dim_staff")
    if as_of_event:
        history = DEFAULT
    else:
        history = None
        disks, people = disks.filter(F.col(DEFAULT.active)), people.filter(F.col(DEFAULT.active))
    paid = source["payment"].drop("inventory_id")
    facts = {
        "payment": fact_payment(
            paid, source["rental"], disks, people, calendar, history,
            (lambda rows: sink.put("work.reload_payment", rows)) if as_of_event else (lambda rows: rows),
        ),
        "rental": fact_rental(source["rental"], paid, disks, people, calendar, history),
    }
    done = side_by_side(facts, lambda name: sink.put(f"core.reloaded_{name}", facts[name]))
    sink.commit()
    return done
