"""As-of lookup: the dimension version valid at an event time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.functions.dates import ORIGIN, ntz
from layerforge.operators.history import DEFAULT, Validity

VERSIONS_PER_SLICE = 8
# A key with more rows than that, facts and versions, is cut into cells by time.
ROWS_PER_CELL = 1_000_000
SAMPLED = 0.001  # share of rows that decides where; results do not depend on it
MOST_CELLS = 1000  # of one key


def _seconds(ts: Column) -> Column:
    """Whole seconds since 1970; the session zone plays no part."""
    since_midnight = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (F.unix_date(F.to_date(ts)).cast("long") * 86400 + since_midnight).cast("long")


def asof_lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str],
    ts: str,
    take: Mapping[str, str],
    closed: bool = False,
    how: str = "inner",
    v: Validity = DEFAULT,
) -> DataFrame:
    """Add ``take`` columns of the version with equal keys and ``ts`` in its interval.

    ``keys`` maps fact columns to dimension columns, ``take`` result names to
    dimension columns. Intervals are half-open; ``closed`` includes the end, so
    a time on a shared boundary matches both versions. The equality carries the
    join; the interval is a residual condition.
    """
    right = dim.select(
        *[F.col(d).alias(f"_d{i}") for i, d in enumerate(keys.values())],
        ntz(F.col(v.start)).alias("_from"),
        ntz(F.col(v.end)).alias("_to"),
        *[F.col(d).alias(f"_t_{name}") for name, d in take.items()],
    )
    at = ntz(F.col(ts))
    on = (at >= F.col("_from")) & ((at <= F.col("_to")) if closed else (at < F.col("_to")))
    for i, f in enumerate(keys):
        on = on & (F.col(f) == F.col(f"_d{i}"))
    return fact.join(right, on, how).select(
        *fact.columns, *[F.col(f"_t_{name}").alias(name) for name in take]
    )


def asof_lookup_dense(
    fact: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str],
    ts: str,
    take: Mapping[str, str],
    how: str = "inner",
    per_slice: int = VERSIONS_PER_SLICE,
    v: Validity = DEFAULT,
) -> DataFrame:
    """As-of lookup where some keys may have very many versions.

    With the key alone, each fact row of such a key is tested against all of its
    versions. Here the time between a key's first and last change is cut into
    one slice for every ``per_slice`` versions, and rows are joined on key and
    slice. Versions of one key do not overlap, so cutting them at slice borders
    adds at most one row per slice; a key with few versions is one slice. Fact
    rows of one key spread over its slices, and adaptive execution splits those
    that are still too many for a task. One plan, no action; exact for any
    ``per_slice``. ``how`` is "inner" or "left".
    """
    dim_keys = list(keys.values())
    start = ntz(F.col(v.start))
    spans = dim.groupBy(*dim_keys).agg(
        F.floor(F.count("*") / F.lit(per_slice)).cast("long").alias("_slices"),
        F.min(F.when(start > ntz(ORIGIN), _seconds(start))).alias("_low"),
        F.max(_seconds(start)).alias("_high"),
    )

    def number(at: Column) -> Column:
        """Slice of a time: 0 before the key's first change, the last one after its last."""
        width = F.greatest(F.col("_high") - F.col("_low"), F.lit(1))
        raw = F.floor((_seconds(at) - F.col("_low")).cast("double") * F.col("_slices") / width)
        return F.coalesce(F.least(F.greatest(raw, F.lit(0)), F.col("_slices")), F.lit(0)).cast("long")

    pieces = (
        dim.join(spans, dim_keys)
        .withColumn("_slice", F.explode(F.sequence(number(start), number(ntz(F.col(v.end))))))
        .drop("_slices", "_low", "_high")
    )
    of_fact = spans.select(
        *[F.col(d).alias(f"_k{i}") for i, d in enumerate(dim_keys)], "_slices", "_low", "_high"
    )
    on = F.lit(True)
    for i, f in enumerate(keys):
        on = on & (F.col(f) == F.col(f"_k{i}"))
    sliced = fact.join(of_fact, on, how).select(
        *fact.columns, number(ntz(F.col(ts))).alias("_slice")
    )
    return asof_lookup(sliced, pieces, {**keys, "_slice": "_slice"}, ts, take, how=how, v=v).drop("_slice")


def asof_lookup_sorted(
    fact: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str],
    ts: str,
    take: Mapping[str, str],
    how: str = "inner",
    v: Validity = DEFAULT,
    rows_per_cell: int = ROWS_PER_CELL,
    sampled: float = SAMPLED,
    sample_of: DataFrame | None = None,
) -> DataFrame:
    """As-of lookup in one sorted pass over facts and versions together.

    Both are dealt by key and sorted by time; the last version before a fact is
    its candidate, and holds if its interval has not ended. Facts are shuffled
    once, whatever the number of versions, and nothing is compared in pairs.

    Keys with very many rows, of either kind, are cut at quantiles of their
    times into cells that go to tasks of their own. A version is carried into
    every later cell it reaches; of the versions of one key at most one crosses
    a cut, so at most one row a cut is added. Cuts come from a sample: of n rows
    there are n / ``rows_per_cell`` at most, small enough to be broadcast.
    ``sample_of`` (keys and ``ts``) stands in for facts that are costly to
    compute twice.

    Versions of one key must not overlap; intervals are half-open, empty ones
    never match. NULL keys and times find nothing. ``how`` is "inner" or "left".
    One plan, no action.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    of_fact = [F.col(f).alias(n) for f, n in zip(keys, names, strict=True)]
    of_dim = [F.col(d).alias(n) for d, n in zip(keys.values(), names, strict=True)]
    found = F.struct(
        ntz(F.col(v.end)).alias("to"), F.struct(*[F.col(d).alias(n) for n, d in take.items()]).alias("row")
    )
    # Keys and time are shuffled once, not again with the rest of the row.
    held = {f: n for (f, d), n in zip(keys.items(), names, strict=True) if fact.schema[f].dataType == dim.schema[d].dataType}
    if fact.schema[ts].dataType == T.TimestampNTZType():
        held[ts] = "_at"
    rest = [c for c in fact.columns if c not in held] or fact.columns[:1]
    facts = fact.select(*of_fact, ntz(F.col(ts)).alias("_at"), F.struct(*rest).alias("_row"))
    versions = dim.filter(ntz(F.col(v.start)) < ntz(F.col(v.end))).select(
        *of_dim, ntz(F.col(v.start)).alias("_at"), found.alias("_version")
    )
    cuts = _cuts(
        (facts if sample_of is None else sample_of.select(*of_fact, ntz(F.col(ts)).alias("_at")))
        .select(*names, "_at").unionByName(versions.select(*names, "_at")),
        names, rows_per_cell, sampled,
    )

    def cell(test: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.size(F.filter("_cuts", test)), F.lit(0))

    unknown = F.lit(False)
    for n in names:
        unknown = unknown | F.col(n).isNull()
    # Facts without a key find nothing anywhere: they are spread.
    aside = -1 - F.pmod(F.xxhash64("_at"), F.lit(MOST_CELLS)).cast("int")
    facts = facts.join(F.broadcast(cuts), names, "left").withColumn(
        "_cell", F.when(unknown, aside).otherwise(cell(lambda c: c <= F.col("_at")))
    )
    reached = F.sequence(cell(lambda c: c <= F.col("_at")), cell(lambda c: c < F.col("_version.to")))
    versions = versions.join(F.broadcast(cuts), names, "left").withColumn("_cell", F.explode(reached))
    both = versions.drop("_cuts").withColumn("_fact", F.lit(False)).unionByName(
        facts.drop("_cuts").withColumn("_fact", F.lit(True)), allowMissingColumns=True
    )
    before = Window.partitionBy(*names, "_cell").orderBy("_at", "_fact").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = both.withColumn("_version", F.last("_version", ignorenulls=True).over(before)).filter("_fact")
    holds = F.col("_at") < F.col("_version.to")
    if how == "inner":
        last = last.filter(holds)
    return last.select(
        *[(F.col(held[c]) if c in held else F.col("_row")[c]).alias(c) for c in fact.columns],
        *[F.when(holds, F.col("_version.row")[n]).alias(n) for n in take],
    )


def _cuts(rows: DataFrame, names: Sequence[str], rows_per_cell: int, sampled: float) -> DataFrame:
    """Keys with more rows than a cell should have, and the times (``_cuts``) between their cells."""
    known = rows.sample(sampled, seed=1) if sampled < 1 else rows
    quantiles = [i / MOST_CELLS for i in range(1, MOST_CELLS)]
    per_key = known.dropna().groupBy(*names).agg(
        F.count("*").alias("n"), F.percentile_approx("_at", quantiles, 10 * MOST_CELLS).alias("q")
    )
    cells = F.least(F.floor(F.col("n") / F.lit(rows_per_cell * sampled)), F.lit(MOST_CELLS)).cast("int")
    between = F.transform(
        F.sequence(F.lit(1), F.col("cells") - 1),
        lambda i: F.element_at("q", F.floor(i * MOST_CELLS / F.col("cells")).cast("int")),
    )
    return per_key.withColumn("cells", cells).filter("cells >= 2").select(
        *names, F.array_distinct(between).alias("_cuts")
    )


def current_version(dim: DataFrame, v: Validity = DEFAULT) -> DataFrame:
    return dim.filter(F.col(v.active))


def overlapping_versions(dim: DataFrame, keys: Sequence[str], v: Validity = DEFAULT) -> DataFrame:
    """Keys with a version starting before the previous one ended (should be none).

    ``lead`` sorts all versions of one key in one task; it spills, it does not
    collect.
    """
    following = F.lead(v.start).over(Window.partitionBy(*keys).orderBy(v.start, v.end))
    return (
        dim.withColumn("_next", following)
        .filter(F.col("_next") < F.col(v.end))
        .select(*keys, v.start, v.end, F.col("_next").alias("next_from"))
    )
