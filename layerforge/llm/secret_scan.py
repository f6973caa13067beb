"""Secrets in texts, by patterns and by a battery of randomness tests.

Built-in Spark functions only. All work on a text happens inside its row: the
texts between and inside the matches of a pattern give the positions, so there
is no shuffle but that of a small histogram.

Battery. Candidates are the runs of 20 or more characters of one base64 alphabet
("+/" or "-_" for its signs) that no pattern covers; what a pattern leaves of a
run is a run, and so are the letters and digits between signs. "=" ends a run, as
padding only at the end of the whole. Runs that overlap are tested each by
itself, and those found become one span. An encoding is inferred for each: hex in
upper or mixed case, base32, A-Z0-9, a-z0-9, base62 and both kinds of base64; runs
without one (words, numbers) are not tested. Each is tested for what a random
string of that encoding does and a word-like one does not:

* chi-squared uniformity over the alphabet: how likely word-like text, whose
  symbols coincide at WORD_COINCIDENCE (in hex digits HEX_COINCIDENCE), comes out
  as even as this;
* runs: how likely text whose pieces (words with or without a capital, capitals,
  digits, signs) end at WORD_CHANGES comes out with as many;
* serial correlation of neighbouring symbols, which a random string must pass.

The first two give one p-value (Stouffer). Expected values and spreads follow
the length of the string, and the false-discovery rate is held at ``rate`` by
the Benjamini-Hochberg rule in each length class, over all candidates of all
rows; p-values are compared in steps of a tenth of a decade.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.common import free_name, register, table

# Kinds in the order of ties, their patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ["assign", "access", "hex", "random"]

LONG = r"[A-Za-z0-9+/_-]{20}"  # no candidate is without this
_PADDING = r"(?:=+(?![A-Za-z0-9+/_-]))?"
# runs of either alphabet that are no part of a longer run of the other, and runs of letters and digits beside a sign
CANDIDATES = [
    rf"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9]*+[+/]|(?<![_-])[A-Za-z0-9]++(?![_-]))[A-Za-z0-9+/]{{20,}}+{_PADDING}",
    rf"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*+[_-])[A-Za-z0-9_-]{{20,}}+{_PADDING}",
    rf"(?<![A-Za-z0-9])(?=(?<=[+/_-])|[A-Za-z0-9]++[+/_-])[A-Za-z0-9]{{20,}}+{_PADDING}",
]
WORD_COINCIDENCE = 0.065  # chance that two letters of a European language agree
HEX_COINCIDENCE = 0.1  # chance that two symbols of a decimal number agree; words of a-f agree more often
WORD_CHANGES = 0.25  # chance that the next symbol of a word-like token starts another piece
RATE = 0.01
LENGTH_CLASSES = [20, 28, 40, 64]  # least lengths
SERIAL_LIMIT = 2.58  # two-sided, one in a hundred
STEPS = 10  # per decade of p
CHUNK = 256  # characters of a text that are cut out together
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
HEX_DIGITS = DIGITS + "abcdef"  # of either case
MASK = "[SECRET]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, step: Callable[[Column, Column], Column], block: int = 128) -> Column:
    """Inclusive running values of an array of longs >= 0 under an associative step, from 0 on.

    Blocks are run each by itself, then the blocks' totals: arrays are copied within
    a block, and once more within the totals, which is little below millions of values.
    """
    zero = F.lit(0).cast("long")

    def plain(items: Column) -> Column:
        return F.aggregate(
            items, F.array(zero), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))),
            lambda acc: F.slice(acc, 2, F.size(acc) - 1),
        )

    def joined(s: Column) -> Column:
        return F.flatten(F.transform(s["parts"], lambda part, i: F.transform(
            part, lambda v: step(F.coalesce(F.get(s["totals"], i - 1), zero), v)
        )))

    def with_totals(parts: Column) -> Column:
        totals = plain(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(F.struct(parts.alias("parts"), totals.alias("totals")), joined)

    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / F.lit(block)).cast("int"))
    parts = F.transform(blocks, lambda b: plain(F.slice(values, b * block + 1, F.lit(block))))
    return F.when(F.size(values) > 0, let(parts, with_totals)).otherwise(F.expr("array()").cast("array<bigint>"))


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def reaches(spans: Column) -> Column:
    """For each span the furthest end so far, its own included."""
    return running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))


def no_matches() -> Column:
    return F.expr("array()").cast("array<struct<start:bigint,end:bigint,found:string>>")


def cut_at(text: Column, pattern: str, group: int = 0) -> Column:
    """Struct of what lies between the leftmost matches, and of the matches and their group; empty without any."""
    names = ["between", "whole", "found"]
    cut = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("found"),
    )
    nothing = F.struct(*[F.expr("array()").cast("array<string>").alias(n) for n in names])
    return F.when(F.regexp_like(text, F.lit(pattern)), cut).otherwise(nothing)


def placed(s: Column) -> Column:
    """Array of (start, end, found) of the matches of ``cut_at``; code points, end exclusive."""
    steps = F.zip_with(
        F.slice(s["between"], 1, F.size(s["whole"])), s["whole"],
        lambda a, b: (F.char_length(a) + F.char_length(b)).cast("long"),
    )
    ends = let(steps, lambda lengths: running_sums(lengths))
    return F.zip_with(
        F.arrays_zip(ends.alias("end"), s["whole"].alias("whole")), s["found"],
        lambda e, f: F.struct(
            (e["end"] - F.char_length(e["whole"])).alias("start"), e["end"].alias("end"), f.alias("found")
        ),
    )


def covered(text: Column, spans: Column, instead: Callable[[Column], Column]) -> Column:
    """The text with ``instead`` for every sorted span, given how many characters it adds to those before.

    Every stretch is cut from the few chunks of the text it lies in: positions
    count characters, and finding one in the whole text would read all before it.
    """
    zero = F.lit(0).cast("long")

    def pieced(s: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            first = F.floor(start / CHUNK)
            some = F.slice(s["chunks"], (first + 1).cast("int"), (F.floor(end / CHUNK) - first + 1).cast("int"))
            return F.substring(F.array_join(some, ""), (start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))

        def piece(span: Column, i: Column) -> Column:
            at = F.coalesce(F.get(s["reach"], i - 1), zero)
            start = F.greatest(span["start"], at)
            return F.concat(cut(at, start), instead(F.greatest(span["end"] - start, zero)))

        last = F.coalesce(F.get(s["reach"], F.size(s["reach"]) - 1), zero)
        return F.concat(F.array_join(F.transform(s["spans"], piece), ""), cut(last, F.greatest(s["length"], last)))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return let(spans, lambda given: let(
        F.struct(
            chunks.alias("chunks"), given.alias("spans"), reaches(given).alias("reach"),
            F.char_length(text).cast("long").alias("length"),
        ),
        pieced,
    ))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end) of the patterns; kinds by number."""

    # One expression places the matches of all kinds: plans with one for each take the driver far more memory.
    cuts = F.array(cut_at(text, ASSIGN, 2), cut_at(text, ACCESS), cut_at(text, HEX))
    return F.flatten(F.transform(cuts, lambda s, kind: F.transform(
        F.filter(placed(s), lambda m: (kind > 0) | (F.char_length(m["found"]) >= ASSIGN_LEAST)),
        lambda m: F.struct(kind.alias("kind"), m["start"].alias("start"), m["end"].alias("end")),
    )))


# --- the battery -------------------------------------------------------------

def alphabet(found: Column) -> Column:
    """Symbols of the smallest encoding that fits; null if none. Hex digits stand for both cases."""
    body = F.regexp_replace(found, r"=+\z", "")
    letters = F.regexp_like(body, F.lit("[A-Z]")) & F.regexp_like(body, F.lit("[a-z]"))
    digit = F.regexp_like(body, F.lit("[0-9]"))
    small = digit & F.regexp_like(body, F.lit("[a-z]")) & ~F.regexp_like(body, F.lit(r"\A[0-9a-f]+\z"))
    large = digit & F.regexp_like(body, F.lit("[A-Z]"))
    return (
        F.when(large & F.regexp_like(body, F.lit(r"\A[A-Fa-f0-9]+\z")), F.lit(HEX_DIGITS))
        .when(digit & F.regexp_like(body, F.lit(r"\A[A-Z2-7]+\z")) & F.regexp_like(body, F.lit("[G-Z]")),
               F.lit(UPPER + DIGITS[2:8]))
        .when(large & F.regexp_like(body, F.lit(r"\A[A-Z0-9]+\z")), F.lit(UPPER + DIGITS))
        .when(small & F.regexp_like(body, F.lit(r"\A[a-z0-9]+\z")), F.lit(LOWER + DIGITS))
        .when(letters & F.regexp_like(body, F.lit(r"\A[A-Za-z0-9]+\z")), F.lit(UPPER + LOWER + DIGITS))
        .when(letters & F.regexp_like(body, F.lit(r"\A[A-Za-z0-9+/]+\z")), F.lit(UPPER + LOWER + DIGITS + "+/"))
        .when(letters & F.regexp_like(body, F.lit(r"\A[A-Za-z0-9_-]+\z")), F.lit(UPPER + LOWER + DIGITS + "-_"))
    )


def tail(z: Column) -> Column:
    """-log10 of the normal upper tail, for z >= 0 (0.3 below)."""
    # the tail lies within (1, 2) times this bound for all z >= 0; exact enough for tenths of decades
    log_density = -(z * z) / 2 - 0.5 * F.log(F.lit(6.283185307179586))
    bound = log_density - F.log(z / 2 + F.sqrt(z * z / 4 + 0.6366197723675814))
    return F.when(z > 0, -bound / F.log(F.lit(10.0))).otherwise(F.lit(0.3))


def score(found: Column, symbols: Column) -> Column:
    """-log10 p that a word-like string looks as random as ``found``; 0 if the serial test fails."""

    def judged(s: Column) -> Column:
        n, k = s["n"], s["k"]
        # chi-squared against the spread of a word-like source of this length
        even = k / n * s["squares"] - n
        word_like = F.when(s["k"] == len(HEX_DIGITS), F.lit(HEX_COINCIDENCE)).otherwise(F.lit(WORD_COINCIDENCE))
        excess = (n - 1) * (k * word_like - 1)
        z_even = ((k - 1 + excess) - even) / F.sqrt(2 * (k - 1) + 4 * excess)
        changes = n - 1
        z_runs = ((s["runs"] - 1) - changes * WORD_CHANGES) / F.sqrt(changes * (WORD_CHANGES * (1 - WORD_CHANGES)))
        z = (z_even + z_runs) / F.sqrt(F.lit(2.0))
        mean = s["sum"] / n
        spread = s["sum2"] - n * mean * mean
        neighbours = s["lagged"] - mean * (2 * s["sum"] - s["first"] - s["last"]) + (n - 1) * mean * mean
        serial = F.when(spread > 0, neighbours / spread).otherwise(F.lit(1.0)) * F.sqrt(n)
        return F.when(F.abs(serial) <= SERIAL_LIMIT, tail(z)).otherwise(F.lit(0.0))

    def measured(s: Column) -> Column:
        chars, body = s["chars"], s["body"]
        number = F.transform(chars, lambda c: F.instr(s["symbols"], c).cast("double"))
        return let(number, lambda at: judged_of(s, chars, body, at))

    def judged_of(s: Column, chars: Column, body: Column, at: Column) -> Column:
        zero = F.lit(0.0)
        pairs = F.zip_with(
            F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: a * b
        )
        return let(
            F.struct(
                F.char_length(body).cast("double").alias("n"),
                F.char_length(s["symbols"]).cast("double").alias("k"),
                F.aggregate(
                    F.array_distinct(chars), zero,
                    lambda acc, c: acc + F.pow(F.char_length(body) - F.char_length(F.replace(body, c, F.lit(""))), F.lit(2.0)),
                ).alias("squares"),
                F.size(F.regexp_extract_all(body, F.lit("[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0)))
                .cast("double").alias("runs"),
                F.aggregate(at, zero, lambda acc, x: acc + x).alias("sum"),
                F.aggregate(at, zero, lambda acc, x: acc + x * x).alias("sum2"),
                F.aggregate(pairs, zero, lambda acc, x: acc + x).alias("lagged"),
                F.element_at(at, 1).alias("first"),
                F.element_at(at, -1).alias("last"),
            ),
            judged,
        )

    body = F.regexp_replace(found, r"=+\z", "")
    body = F.when(symbols == HEX_DIGITS, F.lower(body)).otherwise(body)
    given = F.struct(body.alias("body"), F.split(body, "(?!^)(?=.)").alias("chars"), symbols.alias("symbols"))
    return let(given, measured)


def length_class(length: Column) -> Column:
    out = F.lit(0)
    for least in LENGTH_CLASSES[1:]:
        out = out + (length >= least).cast("int")
    return out


def outside(text: Column, spans: Column) -> Column:
    """The text with a space for every character inside the spans (structs with start and end)."""
    placed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.size(spans) == 0, text).otherwise(
        covered(text, F.array_sort(placed), lambda new: F.repeat(F.lit(" "), new.cast("int")))
    )


def candidates(rest: Column) -> Column:
    """Array of (start, end, class, step) of the tested strings of a text without its base spans (see ``outside``)."""
    cuts = F.array(*[cut_at(rest, c) for c in CANDIDATES])
    free = F.when(F.regexp_like(rest, F.lit(LONG)), F.flatten(F.transform(cuts, placed))).otherwise(no_matches())
    coded = F.filter(
        F.transform(free, lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["found"].alias("found"), alphabet(m["found"]).alias("symbols")
        )),
        lambda m: m["symbols"].isNotNull(),
    )
    return F.transform(coded, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"),
        length_class((m["end"] - m["start"])).alias("class"),
        F.floor(score(m["found"], m["symbols"]) * STEPS).cast("int").alias("step"),
    ))


def thresholds(tested: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Benjamini-Hochberg: the least step that is a discovery in each length class.

    ``tested`` has the column tested (array of candidates). The histogram has a
    row for each class and step: steps end near the largest double.
    """
    histogram = (
        tested.select(F.explode("tested").alias("t"))
        .groupBy(F.col("t.class").alias("class"), F.least(F.col("t.step"), F.lit(3000)).alias("step"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    out = {}
    for c in {r["class"] for r in histogram}:
        rows = sorted(((r["step"], r["n"]) for r in histogram if r["class"] == c), reverse=True)
        total, rank = sum(n for _, n in rows), 0
        for step, n in rows:
            rank += n
            if 10.0 ** (-step / STEPS) <= rate * rank / total:
                out[c] = step
    return out


# --- the scan ----------------------------------------------------------------

def scan(docs: DataFrame, *, text_col: str = "text", spans_col: str = "spans", rate: float = RATE) -> DataFrame:
    """``docs`` with a column of spans: array of (start, kind, end), in order.

    kind is the number of a name in KINDS. Base spans are always there; random
    ones are the discoveries among all candidates of all rows. Null and empty
    texts have no spans. A column of that name is replaced; repeated rows are
    scanned each by itself, and count as candidates each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.drop(spans_col)

    def tested(df: DataFrame) -> DataFrame:
        # columns by turns: one nested expression is too deep for the analyzer
        found, rest = free_name(df, "base"), free_name(df, "rest")
        base = F.when(F.length(text) >= 12, base_spans(text)).otherwise(
            F.expr("array()").cast("array<struct<kind:int,start:bigint,end:bigint>>")
        )
        some = F.when(F.regexp_like(text, F.lit(LONG)), outside(text, F.col(found))).otherwise(F.lit(""))
        return df.withColumn(found, base).withColumn(rest, some).withColumn(
            spans_col, F.struct(F.col(found).alias("base"), candidates(F.col(rest)).alias("tested"))
        ).drop(found, rest)

    both = tested(kept)  # planned once for both passes; the first reads the text alone
    least = thresholds(both.select(F.col(spans_col)["tested"].alias("tested")), rate)

    def discovered(t: Column) -> Column:
        hit = F.lit(False)
        for c, step in sorted(least.items()):
            hit = hit | ((t["class"] == c) & (t["step"] >= step))
        return hit

    def merged(s: Column) -> Column:
        base = F.transform(s["base"], lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
        more = F.transform(F.filter(s["tested"], discovered), lambda t: F.struct(
            t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")
        ))
        return F.array_sort(F.concat(base, united(F.array_sort(more))))

    return both.withColumn(spans_col, let(F.col(spans_col), merged))


def united(spans: Column) -> Column:
    """Sorted spans of one kind, with one span for those that overlap."""

    def whole(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s["spans"]) - 1)
        opens = F.filter(places, lambda i: (i == 0) | (F.get(s["spans"], i)["start"] >= F.get(s["reach"], i - 1)))
        return let(opens, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s["spans"], i)["start"].alias("start"), F.get(s["spans"], i)["kind"].alias("kind"),
            F.get(s["reach"], F.coalesce(F.get(at, k + 1), F.size(s["spans"])) - 1).alias("end"),
        )))

    return let(spans, lambda given: F.when(F.size(given) < 2, given).otherwise(
        let(F.struct(given.alias("spans"), reaches(given).alias("reach")), whole)
    ))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by one mark for each span."""
    return F.when(F.size(spans) == 0, text).otherwise(
        covered(text, spans, lambda new: F.when(new > 0, F.lit(MASK)).otherwise(F.lit("")))
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in text; n_chars follows. Rows without any are as before."""
    spans = free_name(docs, "spans")
    found = scan(docs, spans_col=spans)
    hit = F.size(spans) > 0
    text = F.when(hit, masked(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(hit, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@register("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )
