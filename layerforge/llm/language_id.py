"""Language identification with a string kernel.

The kernel counts the character n-grams (one to four characters, blended) that
two texts both contain, each once, divided by the geometric mean of their own
numbers. Nystroem landmarks stand for the training texts, and one ridge
regression for each language is solved against them. Because the kernel is a
product of presence vectors, kernel values and coefficients multiply out to one
matrix (n-gram cells x languages), and whole batches of texts are scored by one
matrix product.

A text of no known language is told by its lead: how far the best of its values
stands above their mean. The values of a text unlike all languages lie close
together, whatever their height. The least lead is taken from texts that the
model judging them has not seen.

n-grams live in ``CELLS`` hashed cells, so a text of any length is one bit row of
4 KB; only such rows of a bounded sample come to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerforge.llm.common import free_name, register, table, with_fields

CELLS = 1 << 15
ORDERS = 4
PER_LANGUAGE = 600  # training texts of a language at most (all, if it has fewer)
LANDMARKS = 300  # of all languages together
RIDGE = 1e-3
UNKNOWN = "und"
CLEAN_SHARE = 0.01  # of the training texts that may lie below the lead the limit is taken from
LEAD_SHARE = 0.2  # of that lead which a text must reach
LEAST_CLEAN = 50  # fewer judged training texts set no limit
LEAST_CELLS = 32  # a text with fewer n-grams needs as much less of a lead
_LETTER = re.compile(r"[^\W\d_]")
ROWS_AT_ONCE = 256
_SLICE = 1 << 17  # characters that are hashed at once


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # CELLS x languages, float32


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in _LETTER.findall(text[:64]) or _LETTER.findall(text))


def presence(texts: list[str]) -> np.ndarray:
    """One boolean row for each text: which n-gram cells it holds.

    Texts are lower-cased; n-grams do not cross texts. Long texts are hashed in
    slices that overlap by one n-gram, so memory does not follow their length.
    """
    rows = np.zeros((len(texts), CELLS), bool)
    for i, text in enumerate(texts):
        text = text.lower()
        for at in range(0, max(1, len(text)), _SLICE):
            codes = np.frombuffer(
                text[at : at + _SLICE + ORDERS - 1].encode("utf-32-le", "surrogatepass"), np.uint32
            )
            gram = np.zeros(len(codes), np.uint32)
            for n in range(1, ORDERS + 1):
                if len(codes) < n:
                    break
                gram = gram[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
                rows[i, (gram * np.uint32(0x9E3779B1)) >> np.uint32(17)] = True
    return rows


def _cells(rows: np.ndarray) -> np.ndarray:
    """Presence rows as booleans; as bytes, they are packed, eight cells to one."""
    return np.unpackbits(rows, axis=1).view(bool) if rows.dtype == np.uint8 else rows


def _norm(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.float32), 1.0))


def fit(rows: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem kernel ridge regression, one against the rest, in closed form.

    ``rows`` are presence rows, as booleans or packed. Landmarks are taken evenly
    from the languages in the given order. No rows give a model without languages.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((CELLS, 0), np.float32))
    code = np.array([languages.index(x) for x in labels])
    rank = np.zeros(len(code), int)
    for c in range(len(languages)):
        rank[code == c] = np.arange((code == c).sum())
    chosen = np.lexsort((code, rank))[:landmarks]

    def unit(part: np.ndarray) -> np.ndarray:
        part = _cells(part)
        numbers = part.astype(np.float32)
        numbers /= _norm(part)[:, None]
        return numbers

    marks = unit(rows[chosen])
    # in blocks: as numbers, the presence rows take 32 times their bits
    k_nm = np.concatenate([unit(rows[a : a + 128]) @ marks.T for a in range(0, len(rows), 128)]).astype(np.float64)
    k_mm = k_nm[chosen]
    y = np.where(code[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # languages with few texts weigh as much as those with many
    weight = 1.0 / np.bincount(code)[code]
    gram = k_nm.T @ (weight[:, None] * k_nm) + ridge * k_mm + 1e-8 * np.eye(len(chosen))
    alpha = np.linalg.solve(gram, k_nm.T @ (weight[:, None] * y))
    weights = np.empty((CELLS, len(languages)), np.float32)
    for a in range(0, CELLS, 4096):
        weights[a : a + 4096] = marks[:, a : a + 4096].T.astype(np.float64) @ alpha
    return Model(languages, weights)


def _values(model: Model, rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.float32) @ model.weights) / _norm(rows)[:, None]


def _lead(values: np.ndarray) -> np.ndarray:
    return values.max(axis=1) - values.mean(axis=1)


def least_lead(rows: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> float:
    """The lead below which a text has no known language.

    Each half of the training texts is judged by a model of the other one. Only
    texts it names rightly count, so wrong labels do not lower the limit. One
    language has nothing to stand out from, and few texts tell nothing: 0.
    """
    rank: dict[str, int] = {}
    half = np.empty(len(labels), bool)
    for i, label in enumerate(labels):
        half[i] = rank.setdefault(label, 0) % 2
        rank[label] += 1
    leads = []
    for mine in (half, ~half):
        model = fit(rows[~mine], [x for x, m in zip(labels, mine) if not m], landmarks, ridge)
        if len(model.languages) < 2:
            continue
        at = np.flatnonzero(mine)
        for some in np.array_split(at, range(128, len(at), 128)):  # in blocks, as in fit
            part = _cells(rows[some])
            values = _values(model, part)
            right = np.array([model.languages[b] == labels[i] for b, i in zip(values.argmax(axis=1), some)], bool)
            leads.append(_lead(values)[right & (part.sum(axis=1) >= LEAST_CELLS)])
    clean = np.concatenate(leads) if leads else np.zeros(0)
    return LEAD_SHARE * float(np.quantile(clean, CLEAN_SHARE)) if len(clean) >= LEAST_CLEAN else 0.0


def predict(model: Model, texts: list[str | None], rows_at_once: int = 32) -> tuple[list[str], list[float]]:
    """Language and score (0 to 1) of each text; ``und`` and 0 without a letter."""
    names, scores, _ = judged(model, texts, rows_at_once)
    return names, scores


def judged(
    model: Model, texts: list[str | None], rows_at_once: int = 32
) -> tuple[list[str], list[float], list[float]]:
    """Language, score and lead of each text.

    Few n-grams carry little of a lead: that of a text with fewer than ``LEAST_CELLS``
    is given as if it had so many. Every text with a letter is judged.
    """
    names, scores, leads = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores, leads
    known = [i for i, t in enumerate(texts) if has_letter(t)]
    for at in range(0, len(known), rows_at_once):
        some = known[at : at + rows_at_once]
        rows = presence([texts[i] for i in some])
        values = _values(model, rows)
        best, lead = values.argmax(axis=1), _lead(values)
        lead = lead * LEAST_CELLS / np.clip(rows.sum(axis=1), 1, LEAST_CELLS)
        for j, i in enumerate(some):
            names[i] = model.languages[best[j]]
            scores[i] = float(np.clip((values[j, best[j]] + 1.0) / 2.0, 0.0, 1.0))
            leads[i] = float(lead[j])
    return names, scores, leads


def sample(
    docs: DataFrame,
    usable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> tuple[np.ndarray, list[str]]:
    """Presence rows and languages of at most ``per_language`` rows of each language, picked by a hash of the id.

    Rows with ``usable`` not true, a null language, null text or no letter are
    never used. The sample reaches the driver as 4 KB bit rows and stays packed.
    """
    labelled = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")
    )
    # one number for each language; a hash of the id thins out the frequent ones before the shuffle
    counts = labelled.groupBy("_lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return np.zeros((0, CELLS), bool), []
    share = F.create_map(*(F.lit(v) for r in counts for v in (r["_lang"], 2.0 * per_language / r["n"])))
    hashed = F.xxhash64(F.col("_id").cast("string"))
    chance = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    order = Window.partitionBy("_lang").orderBy(hashed, "_id", "_text")
    picked = (
        labelled.where(chance < share[F.col("_lang")])
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_language)
    )

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text = b.column("_text")[i].as_py()
                if has_letter(text):
                    packed = np.packbits(presence([text])[0]).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [b.column("_lang").slice(i, 1), b.column("_rank").slice(i, 1), pa.array([packed], pa.binary())],
                        names=["lang", "rank", "bits"],
                    )

    found = picked.select("_text", "_lang", "_rank").mapInArrow(bits, "lang string, rank int, bits binary")
    found = sorted(found.collect(), key=lambda r: (r["rank"], r["lang"]))
    rows = np.zeros((len(found), CELLS // 8), np.uint8)
    for i, r in enumerate(found):
        rows[i] = np.frombuffer(r["bits"], np.uint8)
    return rows, [r["lang"] for r in found]


def train(
    docs: DataFrame, usable: Column, *, landmarks: int = LANDMARKS, ridge: float = RIDGE, **columns
) -> Model:
    """Fit on the rows of ``sample``."""
    return fit(*sample(docs, usable, **columns), landmarks, ridge)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for the fold that training never sees; a null id counts as held out."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(fold == 0, F.lit(True))


def identify(
    docs: DataFrame, model: Model, *, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score",
    lead_out: str | None = None,
) -> DataFrame:
    """``docs`` with the predicted language and its score; columns of these names are replaced.

    Whole texts are read. Null texts, and texts without a letter, get ``und`` and
    0, as does everything under a model without languages. ``lead_out`` names a
    column for the lead, if it is wanted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS x languages numbers
    more = [] if lead_out is None else [lead_out]
    kept = docs.drop(lang_out, score_out, *more)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                names, *numbers = judged(shared.value, b.column(text_col).to_pylist())
                numbers = [pa.array(x, pa.float64()) for x in numbers[: 1 + len(more)]]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(names, pa.string()), *numbers],
                    names=[*b.schema.names, lang_out, score_out, *more],
                )

    return kept.mapInArrow(score, with_fields(kept, **{lang_out: "string"}, **dict.fromkeys([score_out, *more], "double")))


def accepted(docs: DataFrame) -> DataFrame:
    """Rows whose language is known: a letter in the text, and the lead of a training text.

    Short texts are judged too, by a limit in proportion to their n-grams. A text of
    all languages in equal parts is like none.
    """
    rows, labels = sample(docs, ~held_out())
    model, least = fit(rows, labels), least_lead(rows, labels)
    guess, sure, lead = (free_name(docs, c) for c in ("lang_pred", "score", "lead"))
    found = identify(docs, model, lang_out=guess, score_out=sure, lead_out=lead)
    known = (F.col(guess) != UNKNOWN) & (F.col(lead) >= least)
    return found.where(known).select(*docs.columns)


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~held_out())
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
