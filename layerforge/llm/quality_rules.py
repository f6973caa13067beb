"""Quality of texts by weak supervision: rules vote, their accuracies are learned, the posterior decides.

Every rule looks at counts of a whole text and votes good, bad, or not at all. A
text's true class is hidden. Expectation-maximisation over the table of vote
patterns (3^rules rows at most, whatever the number of texts) estimates how often
each rule is right about good and about bad texts; the posterior probability that
a text is good then takes the place of "passes every rule". No label is read.

Built-in functions only. A text is read once; its counts are written, and all
that follows reads those. Nothing is shuffled but one row per vote pattern and
map task, so a source with a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.common import free_name, register, staged, table

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 8  # words of a window that may be repeated
ROUNDS = 25  # of expectation and maximisation
# Before the first round: share of good texts, how often a vote on a good text is
# good, how often one on a bad text is bad (bad texts differ in what is wrong).
FIRST_PRIOR, FIRST_GOOD, FIRST_BAD = 0.5, 0.99, 0.2
PRIOR_VOTES = 2.0  # votes a rule is credited with at those shares; they vanish as texts grow in number
# A rule is written with a margin: at most 2 in 100 of its votes on good texts
# are bad. Without that floor the hidden class may follow one frequent fault, and
# the texts with other faults count as good.
LEAST_GOOD, SURE = 0.98, 0.999
PRIOR_RANGE = (0.01, 0.99)
KEEP_FROM = 0.5  # posterior from which a text is kept

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_letters", "n_upper", "n_bangs", "n_letter_words", "longest_word"]


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where the condition on the counts holds; abstains elsewhere.

    The conditions use integers only, in SQL that any engine reads alike.
    """

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 30", "n_words >= 60"),
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("repeated_lines", "5 * n_dup_lines > n_lines AND n_lines >= 3", "n_dup_lines = 0 AND n_lines >= 3"),
    Rule("repeated_words", "10 * n_repeat_words > n_words", "n_repeat_words = 0 AND n_words >= 60"),
    Rule("word_length", "word_chars > 12 * n_words OR word_chars < 3 * n_words",
         "word_chars <= 9 * n_words AND 2 * word_chars >= 7 * n_words"),
    Rule("letters", "3 * n_letters < 2 * word_chars", "5 * n_letters >= 4 * word_chars AND n_words > 0"),
    Rule("upper_case", "3 * n_upper > n_letters", "20 * n_upper <= 3 * n_letters AND n_letters > 0"),
    Rule("shouting", "10 * n_bangs > n_words", "50 * n_bangs <= n_words AND n_words > 0"),
    Rule("words_without_letters", "5 * n_letter_words < 4 * n_words", "10 * n_letter_words >= 9 * n_words AND n_words > 0"),
    Rule("longest_word", "longest_word > 200", "longest_word <= 60 AND n_words > 0"),
)
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


# --- counts --------------------------------------------------------------------


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that stands in the text twice or more.

    Windows are compared by 64-bit hashes of their words' hashes. A text whose
    windows are all distinct ends there (a hash set); others sort (hash, place)
    once, so long texts cost n log n.
    """

    def windows(hashes: Column) -> Column:
        every = F.transform(hashes, lambda _, i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
        return F.slice(every, 1, F.greatest(F.size(hashes) - (window - 1), F.lit(0)))

    def count(at: Column) -> Column:
        placed = F.array_sort(F.transform(at, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(placed, lambda s: _let(
            F.array_sort(F.transform(
                F.filter(s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))),
                lambda x: x["i"],
            )),
            # the next window that is repeated takes over the words it shares with this one
            lambda starts: F.aggregate(
                F.transform(starts, lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(window)), F.lit(window))),
                F.lit(0).cast("long"), lambda total, n: total + n,
            ),
        ))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(_let(hashes, windows), lambda at: F.when(
        F.size(F.array_distinct(at)) < F.size(at), count(at)
    ).otherwise(F.lit(0).cast("long")))


def _of_words(words: Column) -> Column:
    """Counts taken from the array of words."""
    return F.struct(
        F.size(words).alias("n_words"),
        F.char_length(F.array_join(words, "")).alias("word_chars"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).alias("n_letter_words"),
        F.coalesce(F.array_max(F.transform(words, lambda w: F.char_length(w))), F.lit(0)).alias("longest_word"),
    )


def _of_lines(lines: Column) -> Column:
    return F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"))


def counts(text: Column) -> Column:
    """All counts of a text as a struct of longs; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def without(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(text, pattern, ""))

    whole = F.struct(
        (F.char_length(text) - without(SYMBOLS)).alias("n_symbols"),
        without(r"[^\p{L}]+").alias("n_letters"),
        without(r"[^\p{Lu}]+").alias("n_upper"),
        (F.char_length(text) - without("!+")).alias("n_bangs"),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = {"w": _let(_words(text), _of_words), "x": _let(lines, _of_lines), "c": whole}
    where = {"n_words": "w", "word_chars": "w", "n_repeat_words": "w", "n_letter_words": "w", "longest_word": "w",
             "n_lines": "x", "n_dup_lines": "x"}
    return _let(F.struct(*[v.alias(k) for k, v in parts.items()]), lambda p: F.struct(
        *[p[where.get(c, "c")][c].cast("long").alias(c) for c in COUNTS]
    ))


# --- votes and their model -----------------------------------------------------


def votes(rules: Sequence[Rule] = RULES) -> Column:
    """Array of one vote a rule: -1 bad, 1 good, 0 none; bad goes first."""
    return F.array(*[F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END") for r in rules])


@dataclass(frozen=True)
class Model:
    """Share of good texts and, for every rule, how often its votes are right about either class."""

    prior: float
    good: tuple[float, ...]  # P(votes good | good, votes)
    bad: tuple[float, ...]  # P(votes bad | bad, votes)


def _rated(vote: Column, prior: Column, good: Column, bad: Column) -> Column:
    """Probability of a good text from its votes and the shares of a model."""
    weights = F.transform(vote, lambda v, j: F.when(v == 1, F.log(F.get(good, j) / (1 - F.get(bad, j))))
                          .when(v == -1, F.log((1 - F.get(good, j)) / F.get(bad, j))).otherwise(0.0))
    odds = F.aggregate(weights, F.log(prior / (1 - prior)), lambda total, w: total + w)
    return 1 / (1 + F.exp(-odds))


def posterior(model: Model, vote: Column) -> Column:
    """Probability of a good text, given its votes."""
    return _rated(vote, F.lit(model.prior), F.lit(list(model.good)), F.lit(list(model.bad)))


def _round(patterns: Column, m: Column, n_rules: int) -> Column:
    """The model after one expectation and one maximisation over an array of (votes, n)."""

    def total(rows: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, x: acc + of(x))

    def share(rows: Column, side: str, j: Column) -> Column:
        """How often the votes of rule j on one class are right."""
        first, right = (FIRST_GOOD, 1) if side == "good" else (FIRST_BAD, -1)
        hits = total(rows, lambda x: F.when(F.get(x["v"], j) == right, x[side]).otherwise(0.0))
        cast = total(rows, lambda x: F.when(F.get(x["v"], j) != 0, x[side]).otherwise(0.0))
        return (hits + PRIOR_VOTES * first) / (cast + PRIOR_VOTES)

    def held(rows: Column, j: Column) -> Column:
        good = F.least(F.greatest(share(rows, "good", j), F.lit(LEAST_GOOD)), F.lit(SURE))
        return _let(good, lambda g: F.struct(
            g.alias("good"), F.greatest(F.least(share(rows, "bad", j), F.lit(SURE)), 1 - g).alias("bad")
        ))

    def learned(rows: Column) -> Column:
        prior = (total(rows, lambda x: x["good"]) + PRIOR_VOTES * FIRST_PRIOR) / (total(rows, lambda x: x["n"]) + PRIOR_VOTES)
        rules = F.transform(F.sequence(F.lit(0), F.lit(n_rules - 1)), lambda j: held(rows, j))
        return _let(rules, lambda r: F.struct(
            F.least(F.greatest(prior, F.lit(PRIOR_RANGE[0])), F.lit(PRIOR_RANGE[1])).alias("prior"),
            F.transform(r, lambda x: x["good"]).alias("good"), F.transform(r, lambda x: x["bad"]).alias("bad"),
        ))

    def split(x: Column) -> Column:
        """Texts of one pattern, divided between the classes."""
        return _let(x["n"] * _rated(x["votes"], m["prior"], m["good"], m["bad"]), lambda w: F.struct(
            x["votes"].alias("v"), x["n"].alias("n"), w.alias("good"), (x["n"] - w).alias("bad")
        ))

    return _let(F.transform(patterns, split), learned)


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over (``votes``, ``n``) rows, 3^rules at most.

    They are gathered in one array and all rounds folded over it in one plan; the
    sorted array makes a repeated run equal to the last bit. The shares are held
    to ``LEAST_GOOD`` and to sides on which a good vote never speaks for a bad
    text, so the two classes cannot change places. Without rows the model is the
    first guess.
    """
    start = F.struct(
        F.lit(FIRST_PRIOR).alias("prior"), F.array_repeat(F.lit(FIRST_GOOD), n_rules).alias("good"),
        F.array_repeat(F.lit(FIRST_BAD), n_rules).alias("bad"),
    )
    gathered = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    folded = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda m, _: _round(F.col("patterns"), m, n_rules)
    )
    m = gathered.select(folded.alias("m")).first()["m"]
    return Model(m["prior"], tuple(m["good"]), tuple(m["bad"]))


def quality(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    rules: Sequence[Rule] = RULES, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the counts, base_failed, quality (posterior) and kept.

    Null and empty texts have counts of 0 and fail the base. Rows that fail it
    are decided: nothing is learned from them, and kept is false whatever their
    posterior. Null ids and repeated rows are rows like others; further columns
    are not looked at. No rows give no rows.
    """
    id_name = free_name(docs.select(*[F.lit(1).alias(c) for c in [*COUNTS, "c", "votes"]]), "id")
    read = docs.select(F.col(id_col).alias(id_name), counts(F.col(text_col)).alias("c"))
    rated = staged(read.select(id_name, "c.*").withColumn("votes", votes(rules)), "quality")
    failed = F.expr(BASE_FAILED)
    patterns = rated.where(~failed).groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    model = fit(patterns, len(rules), rounds)
    good = posterior(model, F.col("votes"))
    return rated.select(
        F.col(id_name).alias(id_col), *COUNTS, failed.alias("base_failed"),
        F.round(good, 6).alias("quality"), (~failed & (good >= KEEP_FROM)).alias("kept"),
    )


# --- query ---------------------------------------------------------------------


def _em_sql(rules: Sequence[Rule], rounds: int) -> str:
    """The same rounds as one recursive query over the vote patterns."""
    k = range(len(rules))
    odds = " + ".join(["ln(prior / (1 - prior))"] + [
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in k])

    def share(right: str, voted: str, first: float) -> str:
        return f"(coalesce(sum({right}), 0) + {PRIOR_VOTES * first}) / (coalesce(sum({voted}), 0) + {PRIOR_VOTES})"

    def learned(j: int) -> str:
        good = share(f"CASE WHEN v{j} = 1 THEN w END", f"CASE WHEN v{j} <> 0 THEN w END", FIRST_GOOD)
        bad = share(f"CASE WHEN v{j} = -1 THEN n - w END", f"CASE WHEN v{j} <> 0 THEN n - w END", FIRST_BAD)
        held = f"least(greatest({good}, {LEAST_GOOD}), {SURE})"
        return f"{held}, greatest(least({bad}, {SURE}), 1 - {held})"

    names = ", ".join(f"g{j}, b{j}" for j in k)
    first = ", ".join(f"CAST({x} AS DOUBLE)" for x in [FIRST_PRIOR, *[FIRST_GOOD, FIRST_BAD] * len(rules)])
    prior = f"(sum(w) + {PRIOR_VOTES * FIRST_PRIOR}) / (sum(n) + {PRIOR_VOTES})"
    vote = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{j}" for j, r in enumerate(rules))
    group = ", ".join(f"v{j}" for j in k)
    return f"""voted AS (SELECT *, {vote} FROM counted),
    patterns AS (SELECT {group}, CAST(count(*) AS DOUBLE) AS n FROM voted
        WHERE NOT ({BASE_FAILED}) GROUP BY ALL),
    em(round, prior, {names}) AS (
        SELECT 0, {first}
        UNION ALL
        SELECT round + 1, least(greatest({prior}, {PRIOR_RANGE[0]}), {PRIOR_RANGE[1]}), {", ".join(map(learned, k))}
        FROM (SELECT *, n / (1 + exp(-({odds}))) AS w FROM em, patterns) WHERE round < {rounds}
        GROUP BY round)
    SELECT doc_id, {", ".join(COUNTS)}, {BASE_FAILED} AS base_failed,
        round(1 / (1 + exp(-({odds}))), 6) AS quality,
        NOT ({BASE_FAILED}) AND 1 / (1 + exp(-({odds}))) >= {KEEP_FROM} AS kept
    FROM voted, em WHERE round = {rounds}"""


_COUNTS_SQL = rf"""WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
    split AS (SELECT *, list_filter(string_split_regex(t, '{WHITE}'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    windows AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w FROM (
        SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT r, count(*) AS n FROM (
        SELECT DISTINCT r, i + k AS i FROM again, range({WINDOW}) AS s(k)) GROUP BY r),
    counted AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
        len(lines) AS n_lines, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
        length(t) - length(replace(t, '!', '')) AS n_bangs,
        len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
        coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS longest_word
        FROM split LEFT JOIN covered USING (r)),
    """


@register("op11_quality_rules", _COUNTS_SQL + _em_sql(RULES, ROUNDS))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
