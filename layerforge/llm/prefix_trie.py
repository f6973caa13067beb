"""Prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation starts with the first turns of another one (its base) and
goes on with turns of its own. No rebuilt text is made. A run of turns has a
fingerprint that composes: (value, length) pairs with
``(a, m) + (b, n) = (a + B^m b, m + n)`` over prime fields, so every prefix of a
rebuilt conversation follows from two numbers of its base and of itself, and a
turn in it is a reference (conversation, place) to a stored turn.

The same composition numbers the turns: conversations are sorted over range
partitions, each partition folds its part of a conversation, and the parts of
conversations that cross a border (two per partition at most) are composed after.

Prefixes are grouped by depth and fingerprint. A group is verified by induction:
all members have one parent group and, where their references differ, the stored
turns are compared. If two sequences ever share a fingerprint the trie is built
again with other multipliers.

Sums over subtrees need no walk by level: every node is counted with its smallest
conversation, and a conversation hands what it carries below a prefix to all its
prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerforge.llm.common import register, staged, table
from layerforge.llm.shingles import random_values

WHITE = r"[\x20\x09-\x0D]+"
GROUP = 20  # conversations that share a base
LONGEST_HEAD = 3  # turns of a base at most
NODE, KEY, PARENT = ["depth", "ka", "kb"], ["ka", "kb"], ["pa", "pb"]
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)  # products of two stay below 2^62
BLOCK = 4096  # turns summed by one window; ids in one row of an end list
HOT_SHARE = 1000  # parents with more than 1/HOT_SHARE of all nodes below them are joined apart
TRIES = 8


# --- fingerprints ----------------------------------------------------------------


def _lanes() -> range:
    return range(len(PRIMES))


def _names(letter: str) -> list[str]:
    return [f"{letter}{i}" for i in _lanes()]


def _packed(columns: list[Column], names: list[str]) -> list[Column]:
    """Four lanes in two longs."""
    high, low = columns[::2], columns[1::2]
    return [(F.shiftleft(h, 31) + x).alias(n) for h, x, n in zip(high, low, names, strict=True)]


def multipliers(seed: int) -> list[int]:
    return [int(x) % (p - 2) + 2 for x, p in zip(random_values(len(PRIMES), 1000 + seed), PRIMES, strict=True)]


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponents modulo the prime, element by element."""
    out, square, left = np.ones(len(exponents), np.int64), base % prime, exponents.astype(np.int64)
    while left.any():
        out = np.where(left & 1, out * square % prime, out)
        square, left = square * square % prime, left >> 1
    return out


def _folded(batches: Iterator[pa.RecordBatch], bases: list[int]) -> Iterator[pa.RecordBatch]:
    """Place and fingerprints of the prefixes with (f) and without (e) each turn.

    Both count from the partition's first turn of the conversation on. Columns:
    conv_id, lanes t0.. of the turn, others. Adds pos, f0.. and e0...
    """
    last, place, sums = None, 0, [0] * len(PRIMES)
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        conv = b.column(0).to_numpy()
        starts = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]])
        first = np.flatnonzero(starts)
        run = np.cumsum(starts) - 1  # -1: goes on from the batch before
        pos = np.arange(n) - np.where(run >= 0, first[np.maximum(run, 0)] if len(first) else 0, -place)
        columns = []
        for i, p in enumerate(PRIMES):
            terms = b.column(1 + i).to_numpy() * powers(bases[i], pos, p) % p
            total = np.cumsum(terms)  # below 2^63 for 2^32 turns a batch
            before = np.concatenate([[0], total])[first] if len(first) else np.zeros(0, np.int64)
            own = total - np.where(run >= 0, before[np.maximum(run, 0)] if len(first) else 0, -sums[i])
            columns.append((own % p, (own - terms) % p))
        last, place, sums = conv[-1], int(pos[-1]) + 1, [int(f[-1]) for f, _ in columns]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(pos), *[pa.array(f) for f, _ in columns], *[pa.array(e) for _, e in columns]],
            names=[*b.schema.names, "pos", *_names("f"), *_names("e")],
        )


def numbered_turns(turns: DataFrame, bases: list[int]) -> DataFrame:
    """Turns with their place in the conversation and the fingerprint of the prefix they end.

    One exchange of the turns, into ranges of (conversation, turn): a conversation
    with any share of all turns spreads over partitions.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    local = placed.select("conv_id", *_names("t"), "words", "role", "text")
    fields = ", ".join(["conv_id long", *[f"{t} long" for t in _names("t")], "words long, role string, text string, pos long",
                        *[f"{c} long" for c in _names("f") + _names("e")]])
    # Written once: range bounds are sampled, another run could cut elsewhere.
    local = staged(local.mapInArrow(lambda b: _folded(b, bases), fields).withColumn("part", F.spark_partition_id()), "turns")

    # Parts of conversations that cross a border: two rows a partition at most.
    edges = local.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    crossing = edges.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"), "part")
    crossing = crossing.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    ends = F.max_by(F.struct("pos", *_names("f")), "pos").alias("end")
    pieces = local.join(F.broadcast(crossing), "conv_id").groupBy("conv_id", "part").agg(ends)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum(F.col("end.pos") + 1).over(earlier), F.lit(0)))

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shift = [powers(bases[i], b.column("before").to_numpy(), p) for i, p in enumerate(PRIMES)]
            moved = [b.column(f"f{i}").to_numpy() * shift[i] % p for i, p in enumerate(PRIMES)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], *map(pa.array, shift), *map(pa.array, moved)],
                names=[*b.schema.names[:3], *_names("s"), *_names("m")],
            )

    shape = "conv_id long, part int, before long, " + ", ".join(f"{c} long" for c in _names("s") + _names("m"))
    pieces = pieces.select("conv_id", "part", "before", *[F.col(f"end.{f}") for f in _names("f")]).mapInArrow(composed, shape)
    carried = pieces.select("conv_id", "part", "before", *_names("s"), *[
        (F.coalesce(F.sum(f"m{i}").over(earlier), F.lit(0)) % PRIMES[i]).alias(f"c{i}") for i in _lanes()
    ])
    joined = local.join(F.broadcast(carried), ["conv_id", "part"], "left")

    def whole(letter: str, i: int) -> Column:
        own = F.col(f"{letter}{i}")
        return F.coalesce((F.col(f"c{i}") + F.col(f"s{i}") * own % PRIMES[i]) % PRIMES[i], own).alias(f"{letter}{i}")

    return joined.select(
        "conv_id", *_names("t"), "words", "role", "text", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"),
        *[whole("f", i) for i in _lanes()], *[whole("e", i) for i in _lanes()],
    )


# --- rebuilt prefixes --------------------------------------------------------------


def head_length(conv: Column) -> Column:
    """How many turns of its base a conversation starts with."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(4)).cast("long")


def rebuilt_prefixes(turns: DataFrame, bases: list[int], group: int = GROUP) -> DataFrame:
    """All prefixes of all rebuilt conversations, the empty ones included.

    A prefix carries its depth, fingerprint (ka, kb), that of its parent (pa,
    pb), the words of its last turn, and whether the conversation ends there.
    """
    f, e = _names("f"), _names("e")
    slim = turns.select("conv_id", "pos", "words", *f, *e)
    h = head_length(F.col("conv_id"))
    # One row a conversation: its number of turns, and the fingerprint of those it leaves out.
    own = slim.groupBy("conv_id").agg(
        (F.max("pos") + 1).alias("own"), F.max_by(F.struct(*f), F.when(F.col("pos") < h, F.col("pos"))).alias("skipped")
    ).select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"), *[
        F.coalesce(F.col(f"skipped.{c}"), F.lit(0)).alias(f"o{i}") for i, c in enumerate(f)])
    # At most three turns of a base, for at most ``group`` conversations.
    heads = slim.where((F.col("conv_id") % group == 0) & (F.col("pos") < LONGEST_HEAD)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "words", *f, *e))).alias("head")
    ).withColumnRenamed("conv_id", "base")
    none = F.expr("array()").cast(heads.schema["head"].dataType)
    convs = own.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", none), 1, F.col("h").cast("int")))
    convs = convs.withColumn("taken", F.size("head").cast("long"))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = staged(convs.select("conv_id", "own", "h", "taken", "length", "head", *_names("o"), *[
        F.coalesce(F.get("head", F.col("taken").cast("int") - 1)[c], F.lit(0)).alias(f"b{i}") for i, c in enumerate(f)]), "convs")

    zero = [F.lit(0).cast("long")] * len(PRIMES)
    top = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *_packed(zero, KEY), *_packed(zero, PARENT),
        F.lit(0).cast("long").alias("words"), (F.col("length") == 0).alias("ends"),
    )
    of_base = convs.select("conv_id", "length", F.posexplode("head").alias("i", "x")).select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), *_packed([F.col(f"x.{c}") for c in f], KEY),
        *_packed([F.col(f"x.{c}") for c in e], PARENT), F.col("x.words").alias("words"),
        (F.col("i") + 1 == F.col("length")).alias("ends"),
    )

    # A conversation of very many turns meets a copy of its row for every block of them.
    block = F.floor(F.col("pos") / BLOCK)
    rows = convs.where("own > h").drop("head").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("own") - 1) / BLOCK))))
    suffixed = slim.withColumn("block", block).join(rows, ["conv_id", "block"]).where("pos >= h")
    # Own turns move from place h to the end of the head: B^(taken - h), an inverse where the base is shorter.
    inverses = [[pow(pow(b, -1, p), n, p) for n in range(LONGEST_HEAD + 1)] for b, p in zip(bases, PRIMES, strict=True)]

    def moved(letter: str) -> list[Column]:
        out = []
        for i, p in enumerate(PRIMES):
            inverse = F.get(F.lit(inverses[i]).cast("array<bigint>"), (F.col("h") - F.col("taken")).cast("int"))
            beyond = F.pmod(F.col(f"{letter}{i}") - F.col(f"o{i}"), F.lit(p))
            out.append((F.col(f"b{i}") + beyond * inverse % p) % p)
        return out

    depth = F.col("taken") + F.col("pos") - F.col("h") + 1
    of_own = suffixed.select(
        "conv_id", depth.alias("depth"), *_packed(moved("f"), KEY), *_packed(moved("e"), PARENT), "words",
        (depth == F.col("length")).alias("ends"),
    )
    return staged(top.unionByName(of_base).unionByName(of_own), "prefixes")


def ambiguous(turns: DataFrame, nodes: DataFrame) -> bool:
    """Whether two different sequences share a fingerprint.

    Members of a group must agree in their parent group, and stored turns of one
    fingerprint in role and text; by induction over the depth they are then equal.
    Copies of a text meet in the map tasks first.
    """
    if not nodes.where("pa <> pa_high OR pb <> pb_high OR words <> words_high").isEmpty():
        return True
    said = F.struct("role", "text")
    classes = turns.groupBy(*_names("t")).agg(F.min(said).alias("low"), F.max(said).alias("high"))
    return not classes.where("low <> high").isEmpty()


# --- the trie ----------------------------------------------------------------------


def _end_lists(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node, ascending and joined by commas.

    Ids are sorted over range partitions and joined there in runs; a node's runs
    then stream through one hash, which is sequential by nature.
    """
    ids = prefixes.where("ends").select(*NODE, "conv_id")
    ids = ids.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i).to_numpy() for i in range(4)]
            change = np.zeros(b.num_rows, bool)
            change[::BLOCK] = True
            for c in columns[:3]:
                change[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(change)
            texts = [",".join(map(str, part.tolist())) for part in np.split(columns[3], first[1:])]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in columns], pa.array(texts)], names=[*NODE, "first", "ids"])

    joined = ids.mapInArrow(runs, "depth long, ka long, kb long, first long, ids string")
    joined = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            keys = zip(*[b.column(i).to_pylist() for i in range(3)], strict=True)
            for key, ids in zip(keys, b.column(4), strict=True):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(ids.as_buffer())
            yield _ends_batch(done)
        if node is not None:
            yield _ends_batch([(*node, state.hexdigest())])

    return joined.mapInArrow(hashed, "depth long, ka long, kb long, ends_sha256 string")


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*NODE, "ends_sha256"]
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """The smallest conversation of every node's parent.

    Parents with a large share of all nodes below them (the root is one) are at
    most HOT_SHARE and are broadcast; no key of the other join holds more than
    that share.
    """
    many = max(1, nodes.count() // HOT_SHARE)
    up = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > many).alias("hot"),
    )
    on = ["depth", *PARENT]
    hot, cold = up.where("hot").drop("hot"), up.where("NOT hot").drop("hot")
    below = nodes.where("depth > 0")
    left = below.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return below.join(F.broadcast(hot), on).unionByName(left).select(*NODE, "parent_conv_id")


def _subtrees(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Leaves and saved words of every subtree.

    A node is counted with its smallest conversation, which is also the smallest
    of every node it has below. What a conversation counts from a depth on is a
    running sum over its own nodes; above its first own node it hands on all.
    """
    values = ["leaves", "saved"]
    own = nodes.select(
        "conv_id", *NODE, (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.floor(F.col("depth") / BLOCK).alias("block"),
    )
    deepest_first = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    blocks = own.groupBy("conv_id", "block").agg(*[F.sum(v).alias(f"of_{v}") for v in values], F.min("depth").alias("first"))
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = blocks.select("conv_id", "block", *[F.coalesce(F.sum(f"of_{v}").over(later), F.lit(0)).alias(f"below_{v}") for v in values])
    running = own.select(*NODE, "conv_id", "block", *[F.sum(v).over(deepest_first).alias(v) for v in values])
    mine = running.join(below, ["conv_id", "block"]).select(*NODE, *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values])

    totals = blocks.groupBy("conv_id").agg(F.min("first").alias("first"), *[F.sum(f"of_{v}").alias(v) for v in values])
    # Only prefixes above the first own node take part: a row of each block of those.
    totals = totals.where("first > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("first") - 1) / BLOCK))))
    handed = prefixes.select("conv_id", *NODE, F.floor(F.col("depth") / BLOCK).alias("block")).join(
        totals, ["conv_id", "block"]).where("depth < first").select(*NODE, *values)
    return mine.unionByName(handed).groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def prefix_trie(
    conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", group: int = GROUP,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    A conversation c starts with the first crc32(c) % 4 turns of c - c % ``group``
    and goes on with its own turns after as many. Turns are ordered by turn (null
    first), then role and text; null role and text are empty. Rows that repeat a
    turn are turns of their own. Rows without a conversation id belong to none
    and are left out. No rows give no nodes. Further columns are not looked at.

    Returns conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    role, text = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]
    read = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role, text
    ).withColumn("words", F.size(F.filter(F.split("text", WHITE), lambda w: w != "")).cast("long"))
    for seed in range(TRIES):
        bases = multipliers(seed)
        halves = [F.xxhash64("role", "text", F.lit(2 * seed + k)) for k in range(2)]
        lanes = [F.pmod(F.shiftrightunsigned(halves[i // 2], 31 * (i % 2)), F.lit(p)).alias(f"t{i}") for i, p in enumerate(PRIMES)]
        turns = staged(numbered_turns(read.select("*", *lanes), bases), "numbered")
        prefixes = rebuilt_prefixes(turns, bases, group)
        found = prefixes.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words_high"),
            F.min("words").alias("words"), *[F.min(c).alias(c) for c in PARENT], *[F.max(c).alias(f"{c}_high") for c in PARENT],
        )
        found = staged(found, "nodes")
        if not ambiguous(turns, found):
            break
    else:
        raise RuntimeError("no multipliers tell the turns apart")

    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(
        F.count("*").alias("n_children"))
    nodes = found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = staged(nodes.select(*NODE, *PARENT, "conv_id", "n_convs", "words", "n_children"), "nodes")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(_parents(nodes), NODE, "left").join(_subtrees(nodes, prefixes), NODE).join(_end_lists(prefixes), NODE, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
    )


# --- query ---------------------------------------------------------------------


_SQL = r"""WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT conv_id, list_reduce(
            list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda k: CAST(ascii(CAST(conv_id AS VARCHAR)[k]) AS BIGINT)),
            lambda crc, byte: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte)), 4294967295::BIGINT) AS r
        FROM (SELECT DISTINCT conv_id FROM turns)),
    convs AS (SELECT conv_id, xor(r, 4294967295::BIGINT) % 4 AS h FROM ids),
    rebuilt AS (
        SELECT c.conv_id, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND i <= h
        UNION ALL
        SELECT c.conv_id, 1000 + i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i > h),
    steps AS (
        SELECT conv_id, row_number() OVER w AS depth, sha256(role) || sha256(text) AS said,
            len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    prefixes AS (
        SELECT conv_id, depth, words, sha256(string_agg(said, ',') OVER w) AS node,
            depth = count(*) OVER (PARTITION BY conv_id) AS ends
        FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
        UNION ALL
        SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM steps) FROM convs),
    nodes AS (
        SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
            sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM prefixes GROUP BY depth, node),
    edges AS (
        SELECT DISTINCT c.depth, c.node, p.node AS above FROM prefixes c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1),
    kids AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n FROM edges GROUP BY ALL),
    valued AS (
        SELECT n.*, coalesce(k.n, 0) AS n_children, (n_convs - 1) * words AS saved
        FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node),
    below AS (
        SELECT DISTINCT u.depth, u.node, w.depth AS d, w.node AS n FROM prefixes u JOIN prefixes w ON w.conv_id = u.conv_id AND w.depth >= u.depth),
    sums AS (
        SELECT b.depth, b.node, count_if(n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
        FROM below b JOIN valued v ON v.depth = b.d AND v.node = b.n GROUP BY ALL)
    SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
    FROM valued v JOIN sums s ON s.depth = v.depth AND s.node = v.node
        LEFT JOIN edges e ON e.depth = v.depth AND e.node = v.node
        LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.node = e.above"""


@register("op13_prefix_trie", _SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
