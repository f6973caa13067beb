"""Versioned rows: one merge for all change rules, parent splits, upgrades.

A version is valid in ``[from, to)``; the open one ends in 9999-01-01 and is
flagged active.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.functions.dates import FOREVER, ORIGIN, ntz
from layerforge.functions.hashing import row_hash
from layerforge.operators.delta import Stamp, latest_per_key


@dataclass(frozen=True)
class Validity:
    """Names of the columns that carry a version's validity."""

    start: str = "effective_date_from"
    end: str = "effective_date_to"
    active: str = "is_active"

    @property
    def columns(self) -> list[str]:
        return [self.start, self.end, self.active]


DEFAULT = Validity()


def add_history_columns(
    df: DataFrame, stamp: str | None = None, stamp_from: str | None = None, v: Validity = DEFAULT
) -> DataFrame:
    """Unversioned rows as open versions; optionally fill a change stamp from an event date."""
    if stamp is not None:
        df = df.withColumn(stamp, F.col(stamp_from))
    return df.withColumns(
        {v.start: ntz(ORIGIN), v.end: ntz(FOREVER), v.active: F.lit(True)}
    )


def empty_history(source: DataFrame, v: Validity = DEFAULT, drop: Sequence[str] = ()) -> DataFrame:
    """Zero rows with the columns of a versioned copy of ``source``."""
    return add_history_columns(source.drop(*drop).limit(0), v=v)


@dataclass(frozen=True)
class Rule:
    """What counts as a change and what happens to vanished keys.

    change      "hash": the row hash over ``tracked`` differs;
                "tracked": one of ``tracked`` differs, other columns are
                overwritten in place; "touched": present in the delta.
    snapshot    the source holds every live key (True) or only staged ones.
    vanished    a live key missing from a snapshot is closed at the load time.
    deleted     column whose non-NULL value closes a row, or None.
    stamp       column with the change time; None means the load time.
    open_from   start of a first version: "origin" (1900-01-01) or "change".
    inplace     (old, new) -> Column: overwrite without a version when true;
                ``old`` and ``new`` look up a column on either side.
    inplace_columns  columns that overwrite takes from the source.
    if_first, if_changed, if_overwritten  boolean source columns: whether the
                staged row may make a first version, the version after a
                change, or overwrite. A deletion or change always closes the
                old version, whatever these say.
    """

    change: str = "hash"
    tracked: Sequence[str] = ()
    snapshot: bool = True
    vanished: bool = True
    deleted: str | None = "deleted"
    stamp: str | None = "last_update"
    open_from: str = "origin"
    inplace: Callable[[Callable, Callable], Column] | None = None
    inplace_columns: Sequence[str] | None = None
    if_first: str | None = None
    if_changed: str | None = None
    if_overwritten: str | None = None
    hash_column: str = "hash"
    validity: Validity = field(default=DEFAULT)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    rule: Rule,
    load_ts: Stamp,
    source_unique: bool = False,
    keep_closed: bool = True,
) -> DataFrame:
    """New state of a versioned target.

    Cases per key: new, changed, unchanged, deleted, vanished, returned. A key
    that was closed and comes back opens again at its change time. Closed
    versions pass through without a shuffle; only their distinct keys are
    looked up. ``keep_closed`` False leaves them out, for tables where they are
    already written. Target columns the source lacks (a surrogate) are NULL on
    new versions.
    """
    keys, v = list(keys), rule.validity
    if rule.deleted is not None and rule.deleted not in source.columns:
        raise ValueError(f"source has no column {rule.deleted}")
    if not source_unique:
        newest = [F.col(rule.stamp).desc()] if rule.stamp else []
        # Equal stamps are told apart by content: a retried task picks the same row.
        source = latest_per_key(source, keys, [*newest, F.xxhash64(*source.columns)])
    if rule.change == "hash":
        source = source.withColumn(rule.hash_column, row_hash(rule.tracked))

    columns = target.columns
    is_open = F.col(v.active)
    closed = target.filter(~is_open | is_open.isNull())

    # Both sides as flat columns: old values o_*, staged values s_*.
    old = target.filter(is_open).select(
        *[F.col(c).alias(f"o_{c}") for c in columns], F.lit(True).alias("_old")
    )
    staged = source.select(
        *[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_new")
    )
    merge = _Merge(rule, columns, source.columns, target, load_ts)

    if rule.snapshot:
        before = _prefixed(closed, keys, "b_").distinct().withColumn("_returned", F.lit(True))
        pairs = staged.join(before, _equal(keys, "s_", "b_"), "left").join(
            old, _equal(keys, "s_", "o_"), "full"
        )
        versions = merge.versions(pairs)
    else:
        # A delta is small against its target: broadcastable on the right side
        # of both joins, so the target is scanned without a shuffle.
        seen = (
            _prefixed(target, keys, "b_", is_open.alias("_open"))
            .join(_prefixed(source, keys, "s_"), _equal(keys, "b_", "s_"), "left_semi")
            .groupBy(*[f"b_{k}" for k in keys])
            .agg(F.max(F.coalesce("_open", F.lit(False))).alias("_open"))
        )
        unmatched = (
            staged.join(seen, _equal(keys, "s_", "b_"), "left")
            .filter(~F.coalesce(F.col("_open"), F.lit(False)))
            .withColumn("_returned", F.col("_open").isNotNull())
        )
        versions = merge.versions(
            old.join(staged, _equal(keys, "o_", "s_"), "left")
        ).unionByName(merge.opened(unmatched))
    return versions.unionByName(closed) if keep_closed else versions


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str, *more: Column) -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in keys], *more)


def _equal(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(left + k) == F.col(right + k) for k in keys]
    )


# What becomes of a (old row, staged row) pair, as row codes.
_KEEP, _END, _OPEN, _OVERWRITE = 0, 1, 2, 3


class _Merge:
    """Column expressions of one merge."""

    def __init__(self, rule: Rule, columns: Sequence[str], given: Sequence[str],
                 target: DataFrame, load_ts: Stamp):
        self.rule, self.columns, self.given = rule, columns, set(given)
        self.types = {f.name: f.dataType for f in target.schema.fields}
        self.load_time = ntz(load_ts)

    @staticmethod
    def old(c: str) -> Column:
        return F.col(f"o_{c}")

    @staticmethod
    def new(c: str) -> Column:
        return F.col(f"s_{c}")

    @property
    def stamp(self) -> Column:
        return ntz(self.new(self.rule.stamp)) if self.rule.stamp else self.load_time

    @property
    def gone_at(self) -> Column:
        return ntz(self.new(self.rule.deleted)) if self.rule.deleted else ntz(F.lit(None))

    def allowed(self, flag: str | None) -> Column:
        return F.lit(True) if flag is None else F.coalesce(self.new(flag), F.lit(False))

    def _changed(self) -> Column:
        rule, old, new = self.rule, self.old, self.new
        if rule.change == "hash":
            changed = ~old(rule.hash_column).eqNullSafe(new(rule.hash_column))
        elif rule.change == "tracked":
            changed = F.lit(False)
            for c in rule.tracked:
                changed = changed | ~old(c).eqNullSafe(new(c))
        elif rule.change == "touched":
            changed = F.lit(True)
        else:
            raise ValueError(rule.change)
        if rule.inplace is not None:
            changed = changed & ~F.coalesce(rule.inplace(old, new), F.lit(False))
        return changed

    def _overwrites(self, c: str) -> bool:
        rule = self.rule
        if c not in self.given or not (rule.change == "tracked" or rule.inplace is not None):
            return False
        return rule.inplace_columns is None or c in rule.inplace_columns

    def versions(self, pairs: DataFrame) -> DataFrame:
        """Zero to two versions per pair; a single scan of the joined rows."""
        rule, v = self.rule, self.rule.validity
        has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
        removed = self.gone_at.isNotNull()
        returned = F.col("_returned").isNotNull() if rule.snapshot else F.lit(False)
        vanishes = rule.snapshot and rule.vanished

        def rows(*codes: int) -> Column:
            return F.array(*[F.lit(c) for c in codes])

        again = self.allowed(rule.if_changed)
        codes = (
            F.when(~has_new, rows(_END if vanishes else _KEEP))
            .when(has_old & removed, rows(_END))
            .when(has_old & self._changed(), F.when(again, rows(_END, _OPEN)).otherwise(rows(_END)))
            .when(has_old, F.when(self.allowed(rule.if_overwritten), rows(_OVERWRITE)).otherwise(rows(_KEEP)))
            .when(returned & removed, F.lit(None))  # closed before, deleted again: no row
            .when(returned, F.when(again, rows(_OPEN)))
            .when(self.allowed(rule.if_first), rows(_OPEN))
        )
        # A change stamped before the version it ends must not turn it inside out.
        change_at = F.greatest(self.stamp, self.old(v.start))
        end_at = F.when(~has_new, self.load_time).when(removed, self.gone_at).otherwise(change_at)
        known = has_old | returned
        marks = self._open_marks(known, F.when(has_old, change_at).otherwise(self.stamp))
        code = F.col("_code")
        ended = {v.start: self.old(v.start),
                 v.end: F.greatest(end_at, self.old(v.start)),
                 v.active: F.lit(False)}

        def cell(c: str) -> Column:
            if c in marks:
                return (F.when(code == _OPEN, marks[c]).when(code == _END, ended[c])
                        .otherwise(self.old(c)))
            fresh = self.new(c) if c in self.given else F.lit(None)
            taken = code.isin(_OPEN, _OVERWRITE) if self._overwrites(c) else code == _OPEN
            return F.when(taken, fresh).otherwise(self.old(c))

        return pairs.withColumn("_code", F.explode(codes)).select(
            *[cell(c).cast(self.types[c]).alias(c) for c in self.columns]
        )

    def opened(self, staged: DataFrame) -> DataFrame:
        """Versions of staged rows without an active one; ``_returned`` tells old keys."""
        returned = F.col("_returned")
        marks = self._open_marks(returned, self.stamp)
        kept = staged.filter(
            F.when(returned, self.gone_at.isNull() & self.allowed(self.rule.if_changed))
            .otherwise(self.allowed(self.rule.if_first))
        )

        def cell(c: str) -> Column:
            return marks[c] if c in marks else self.new(c) if c in self.given else F.lit(None)

        return kept.select(*[cell(c).cast(self.types[c]).alias(c) for c in self.columns])

    def _open_marks(self, known: Column, known_from: Column) -> dict[str, Column]:
        v, gone_at = self.rule.validity, self.gone_at
        first = ntz(ORIGIN) if self.rule.open_from == "origin" else self.stamp
        return {
            v.start: F.when(known, known_from).otherwise(first),
            v.end: F.when(known, ntz(FOREVER)).otherwise(F.coalesce(gone_at, ntz(FOREVER))),
            v.active: known | gone_at.isNull(),
        }


def soft_delete(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                deleted: str = "deleted", v: Validity = DEFAULT) -> DataFrame:
    """Close active rows whose key is staged as deleted; nothing else changes."""
    gone = staged.filter(F.col(deleted).isNotNull()).groupBy(*keys).agg(
        F.max(deleted).alias("_gone_at")
    )
    hit = F.col("_gone_at").isNotNull() & F.col(v.active)
    return (
        target.join(gone, list(keys), "left")
        .withColumns({
            v.end: F.when(hit, F.col("_gone_at")).otherwise(F.col(v.end)),
            v.active: F.col(v.active) & ~F.coalesce(hit, F.lit(False)),
        })
        .select(*target.columns)
    )


def split_by_parent(
    dim: DataFrame,
    parents: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    since: Stamp | None,
    stamp: str = "last_update",
    v: Validity = DEFAULT,
    new_version: Sequence[str] = (),
) -> DataFrame:
    """Re-version rows whose parent changed since the previous load.

    A row strictly containing the parent's change time is cut there: the first
    part keeps its values and is closed, the second takes ``take`` from the
    parent and inherits end and flag. ``since`` None (first load) splits
    nothing. ``new_version`` columns (surrogates) are NULL on the second part.
    """
    if since is None:
        return dim
    on = list(on)
    changed = latest_per_key(
        parents.filter(F.col(stamp) >= ntz(since)).select(*on, stamp, *take), on,
        [F.col(stamp).desc(), F.xxhash64(*take)],
    ).select(
        *on, F.col(stamp).alias("_at"), *[F.col(c).alias(f"_p_{c}") for c in take],
        F.lit(None).cast("timestamp_ntz").alias("_prev"), F.lit(None).cast("timestamp_ntz").alias("_next"),
    )
    return _pieces(dim, changed, on, take, v, new_version)


def split_by_history(
    dim: DataFrame,
    changes: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    since: Stamp | None = None,
    stamp: str = "last_update",
    v: Validity = DEFAULT,
    new_version: Sequence[str] = (),
) -> DataFrame:
    """Re-version rows by every change of their parent, not only the newest one.

    Where ``split_by_parent`` reads a snapshot, this reads a feed: all states a
    parent took. The two histories are intersected: n changes strictly inside a
    version make n + 1 pieces. The first keeps its values; each other takes
    ``take`` from its change and lasts until the next one, the last to the end of
    the version. Changes of one parent at one time count once, by content. NULL
    keys and times split nothing.

    A parent's changes are ordered beside each other once, before the join, so a
    version meets its changes with an equality on the key and no piece has to
    look for its neighbours.
    """
    on = list(on)
    if since is not None:
        changes = changes.filter(F.col(stamp) >= ntz(since))
    known = changes.select(*on, F.col(stamp).cast("timestamp_ntz").alias("_at"), *[F.col(c).alias(f"_p_{c}") for c in take])
    once = latest_per_key(known.dropna(subset=[*on, "_at"]), [*on, "_at"], [F.xxhash64(*[f"_p_{c}" for c in take])])
    in_time = Window.partitionBy(*on).orderBy("_at")
    placed = once.withColumns({"_prev": F.lag("_at").over(in_time), "_next": F.lead("_at").over(in_time)})
    return _pieces(dim, placed, on, take, v, new_version)


def _pieces(
    dim: DataFrame, changes: DataFrame, on: list[str], take: Sequence[str], v: Validity, new_version: Sequence[str]
) -> DataFrame:
    """``dim`` cut at the changes (``_at``, values ``_p_*``) between ``_prev`` and ``_next``."""
    of_parent = changes.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in changes.columns if c not in on])
    inside = (F.col("_at") > F.col(v.start)) & (F.col("_at") < F.col(v.end))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_on_{c}") for c in on])
    joined = dim.join(of_parent, same & inside, "left")

    # Row 0 is the part before the first change (or the whole row), row 1 the part after a change.
    row, cut = F.col("_row"), F.col("_at").isNotNull()
    leads = F.coalesce(F.col("_prev") <= F.col(v.start), F.lit(True))
    rows = F.when(~cut, F.array(F.lit(0))).when(leads, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    goes_on = F.coalesce(F.col("_next") < F.col(v.end), F.lit(False))  # to another change

    def cell(c: str) -> Column:
        if c == v.start:
            return F.when(row == 1, F.col("_at")).otherwise(F.col(c))
        if c == v.end:
            return (F.when((row == 1) & goes_on, F.col("_next")).when(cut & (row == 0), F.col("_at"))
                    .otherwise(F.col(c)))
        if c == v.active:
            return F.when((cut & (row == 0)) | ((row == 1) & goes_on), F.lit(False)).otherwise(F.col(c))
        if c in take:
            return F.when(row == 1, F.col(f"_p_{c}")).otherwise(F.col(c))
        if c in new_version:
            return F.when(row == 0, F.col(c))
        return F.col(c)

    return joined.withColumn("_row", F.explode(rows)).select(
        *[cell(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]
    )
