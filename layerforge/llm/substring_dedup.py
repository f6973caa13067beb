"""Removal of byte strings that an earlier document already has.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.

1. Equal texts are settled by their digest: all copies but the smallest id go.
2. Every window of LENGTH bytes has a smallest gram (by hash) inside, and equal
   windows have the same one. Runs of windows with one smallest gram are the
   units of work. Which grams occur in several texts is found from four bytes of
   each gram's hash, dealt to buckets; a chance hit costs work only.
3. The strings of the runs whose gram occurs again are dealt to shards by gram,
   so equal windows meet. A batch of texts sends each different string once, with
   its smallest id. Each shard gets a suffix array by induced sorting; neighbours
   in it with LENGTH common bytes are equal windows, and the smallest id of such a
   group decides for all its members.
4. The answers go back to the batches, whose texts report what goes and are cut.

Between tasks, keys and strings travel packed by task and bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.common import marked_ids, partitions_for, register, staged, table
from layerforge.llm.shingles import slices, text_buffers
from layerforge.llm.suffix_array import DEPTH, least_owner
from layerforge.llm.windows import runs

LENGTH = 50
GRAM = 24
LONGEST = 4096  # windows of a run
BUCKET_BYTES = 8 << 20  # text bytes that a bucket stands for
HELD = 1 << 22  # runs that a map task holds before it sends them on
_U = np.uint64


def _split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and four-byte key of each gram hash."""
    return (hashes % _U(buckets)).astype(np.int64), ((hashes >> _U(20)) & _U(0xFFFFFFFF)).astype(np.uint32)


def _marks(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and key in one number."""
    bucket, key = _split(hashes, buckets)
    return (bucket << 32) | key.astype(np.int64)


def _text_runs(column: pa.Array, length: int, gram: int) -> Iterator[tuple]:
    """(data, offsets, row, first window, windows, hash) of all runs, slice by slice."""
    data, bounds = text_buffers(column)
    for a, b in slices(bounds):
        row, first, count, hashes = runs(data, bounds[a : b + 1], length, gram, LONGEST)
        yield data, bounds, row + a, first, count, hashes


# --- which grams occur again ---------------------------------------------------

def repeated_grams(texts: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(h, mark): the grams of each text (h: hash of the text) that another text has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            h = np.concatenate([x for x, _ in held])
            marks = np.concatenate([m for _, m in held])
            order = np.lexsort((h, marks >> 32))
            h, marks = h[order], marks[order]
            bucket = marks >> 32
            names, first = np.unique(bucket, return_index=True)
            rows = []
            for i, (a, b) in enumerate(zip(first, [*first[1:], len(h)])):
                at = np.flatnonzero(np.concatenate([[True], h[a + 1 : b] != h[a : b - 1]]))
                rows.append((
                    int(names[i]), h[a:b][at].tobytes(), np.diff(np.append(at, b - a)).astype(np.int32).tobytes(),
                    (marks[a:b] & 0xFFFFFFFF).astype(np.uint32).tobytes(),
                ))
            c = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), *(pa.array(x, pa.binary()) for x in c[1:])],
                names=["bucket", "texts", "counts", "keys"],
            )

        for b in batches:
            h = b.column("h").to_numpy()
            for _, _, row, _, _, hashes in _text_runs(b.column("text"), length, gram):
                marks = _marks(hashes, buckets)
                order = np.lexsort((marks, row))
                row, marks = row[order], marks[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (marks[1:] != marks[:-1])
                if new.any():
                    held.append((h[row[new]], marks[new]))
                    size += int(new.sum())
                if size > HELD:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint32) for k in pdf["keys"]])
        h = np.concatenate([
            np.repeat(np.frombuffer(t, np.int64), np.frombuffer(c, np.int32)) for t, c in zip(pdf["texts"], pdf["counts"])
        ])
        order = np.argsort(keys, kind="stable")
        keys, h = keys[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        several = np.minimum.reduceat(h, first) != np.maximum.reduceat(h, first)
        again = np.repeat(several, np.diff(np.append(first, len(keys))))
        mark = (np.int64(pdf["bucket"].iloc[0]) << 32) | keys[again].astype(np.int64)
        return pd.DataFrame({"h": h[again], "mark": mark})

    sent = texts.select("h", "text").mapInArrow(send, "bucket long, texts binary, counts binary, keys binary")
    return sent.groupBy("bucket").applyInPandas(find, "h long, mark long")


# --- what goes -------------------------------------------------------------------

SPANS = "id long, h long, first long, last long"


def _packed(batch: pa.RecordBatch, number: int, length: int, gram: int, buckets: int) -> pa.RecordBatch | None:
    """One row a bucket: the different strings of the wanted runs, and where they occur.

    A string that many texts of the batch have is there once, with the smallest
    and the largest id.
    """
    ids, hashes_of_texts, wanted = batch.column("id").to_numpy(), batch.column("h").to_numpy(), batch.column("marks")
    bounds = np.frombuffer(wanted.buffers()[1], np.int32)[wanted.offset : wanted.offset + len(wanted) + 1]
    flat = wanted.values.to_numpy(zero_copy_only=False)
    number_of: dict[bytes, int] = {}
    held = []
    for data, offsets, row, first, count, hashes in _text_runs(batch.column("text"), length, gram):
        marks = _marks(hashes, buckets)
        keep = np.zeros(len(row), bool)
        edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
        for a, z in zip(edges, [*edges[1:], len(row)]):
            r = row[a]
            keep[a:z] = np.isin(marks[a:z], flat[bounds[r] : bounds[r + 1]])
        if not keep.any():
            continue
        row, first, size, bucket = row[keep], first[keep], count[keep] + length - 1, marks[keep] >> 32
        blob, begin = data.tobytes(), offsets[row] + first
        kind = [
            number_of.setdefault(blob[x:y], len(number_of)) for x, y in zip(begin.tolist(), (begin + size).tolist())
        ]
        held.append((bucket, ids[row], hashes_of_texts[row], first, np.array(kind, np.int64)))
    if not held:
        return None
    bucket, docs, texts, first, kind = (np.concatenate(c) for c in zip(*held))
    strings = list(number_of)
    least, most = np.full(len(strings), np.iinfo(np.int64).max), np.full(len(strings), np.iinfo(np.int64).min)
    np.minimum.at(least, kind, docs)
    np.maximum.at(most, kind, docs)
    home = np.zeros(len(strings), np.int64)  # equal strings have one gram, so one bucket
    home[kind] = bucket
    turn = np.argsort(home, kind="stable")
    place = np.empty(len(strings), np.int64)
    place[turn] = np.arange(len(strings))
    names, at = np.unique(home[turn], return_index=True)
    order = np.argsort(bucket, kind="stable")
    docs, texts, first, kind = docs[order], texts[order], first[order], place[kind[order]]
    starts = np.searchsorted(bucket[order], names)
    rows = []
    for name, a, z, x, y in zip(
        names.tolist(), at, [*at[1:], len(strings)], starts, [*starts[1:], len(docs)], strict=True
    ):
        mine = [strings[i] for i in turn[a:z].tolist()]
        rows.append((
            name, number, np.array([len(m) for m in mine], np.int32).tobytes(), b"".join(mine),
            least[turn[a:z]].tobytes(), most[turn[a:z]].tobytes(), docs[x:y].astype(np.int64).tobytes(),
            texts[x:y].astype(np.int64).tobytes(), first[x:y].astype(np.int64).tobytes(), (kind[x:y] - a).astype(np.int32).tobytes(),
        ))
    c = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x, pa.int64()) for x in c[:2]), *(pa.array(x, pa.binary()) for x in c[2:])],
        names=["bucket", "batch", *STRINGS, *OCCURRENCES],
    )


STRINGS = ["sizes", "strings", "least", "most"]
OCCURRENCES = ["ids", "hs", "firsts", "kinds"]
DECIDED = ["counts", "starts", "stops", "owners"]


def _flat(column: pd.Series, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column])


def _gathered(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), then those of the next."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _decided(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """For the strings of each batch: stretches of windows and the smallest id that has them.

    Stretches that no text of the batch can lose are left out.
    """
    sizes, least, most = _flat(pdf["sizes"], np.int32).astype(np.int64), _flat(pdf["least"], np.int64), _flat(pdf["most"], np.int64)
    blob = b"".join(pdf["strings"])
    ends = np.cumsum(sizes)
    distinct: dict[bytes, int] = {}
    kind = np.array([distinct.setdefault(blob[e - s : e], len(distinct)) for e, s in zip(ends.tolist(), sizes.tolist())], np.int64)
    del blob
    owners = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(owners, kind, least)
    strings = list(distinct)
    of_window, begins = least_owner(strings, owners, length)
    windows = np.array([len(x) for x in strings], np.int64) - length + 1
    of = np.repeat(np.arange(len(strings)), windows)
    change = np.ones(len(of), bool)
    change[1:] = (of[1:] != of[:-1]) | (of_window[1:] != of_window[:-1])
    start = np.flatnonzero(change)
    stop, owner = np.append(start[1:], len(of)), of_window[start]
    start, stop, of = start - begins[of[start]], stop - begins[of[start]], of[start]
    n = np.bincount(of, minlength=len(strings))
    first = np.cumsum(n) - n
    pick = _gathered(first[kind], n[kind])
    string = np.repeat(np.arange(len(kind)), n[kind])
    keep = owner[pick] < most[string]
    pick, string = pick[keep], string[keep]
    count = np.bincount(string, minlength=len(kind)).astype(np.int32)
    rows, at, seg = [], 0, 0
    for bucket, batch, packed in zip(pdf["bucket"], pdf["batch"], pdf["sizes"], strict=True):
        mine = count[at : at + len(packed) // 4]
        total = int(mine.sum())
        if total:
            p = pick[seg : seg + total]
            rows.append((bucket, batch, mine.tobytes(), start[p].astype(np.int32).tobytes(),
                         stop[p].astype(np.int32).tobytes(), owner[p].astype(np.int64).tobytes()))
        at, seg = at + len(mine), seg + total
    return pd.DataFrame(rows, columns=["bucket", "batch", *DECIDED])


def _stretches(b: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """What each occurrence of a string loses."""
    for i in range(b.num_rows):
        def part(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b.column(name)[i].as_buffer(), kind)

        count = part("counts", np.int32).astype(np.int64)
        ids, kinds = part("ids", np.int64), part("kinds", np.int32)
        hit = np.flatnonzero(count[kinds])
        ids, kinds, hs, firsts = ids[hit], kinds[hit], part("hs", np.int64)[hit], part("firsts", np.int64)[hit]
        pick = _gathered((np.cumsum(count) - count)[kinds], count[kinds])
        occurrence = np.repeat(np.arange(len(ids)), count[kinds])
        goes = part("owners", np.int64)[pick] < ids[occurrence]
        pick, occurrence = pick[goes], occurrence[goes]
        start, stop = part("starts", np.int32)[pick], part("stops", np.int32)[pick]
        joins = np.zeros(len(pick), bool)  # goes on where the stretch before it stops
        joins[1:] = (occurrence[1:] == occurrence[:-1]) & (start[1:] == stop[:-1])
        s = np.flatnonzero(~joins)
        e = np.append(s[1:], len(pick))[: len(s)] - 1
        o = occurrence[s]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[o]), pa.array(hs[o]), pa.array(firsts[o] + start[s]), pa.array(firsts[o] + stop[e] - 1 + length)],
            names=["id", "h", "first", "last"],
        )


def removals(marked: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(id, h, first, last): stretches of each text that go; they may touch and overlap.

    Only the different strings of a batch of texts go to the shard of their gram,
    however many texts have them; the shard's answer goes back to the batch.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            rows = _packed(b, number, length, gram, buckets)
            number += 1
            if rows is not None:
                yield rows

    binaries = ", ".join(f"{c} binary" for c in [*STRINGS, *OCCURRENCES])
    packed = marked.select("id", "h", "text", "marks").mapInArrow(pack, f"bucket long, batch long, {binaries}")
    packed = staged(packed, "strings", large=True, codec="zstd")
    answers = packed.select("bucket", "batch", *STRINGS).groupBy("bucket").applyInPandas(
        lambda pdf: _decided(pdf, length), "bucket long, batch long, " + ", ".join(f"{c} binary" for c in DECIDED)
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _stretches(b, length)

    both = packed.select("bucket", "batch", *OCCURRENCES).join(answers, ["bucket", "batch"])
    return both.select(*OCCURRENCES, *DECIDED).mapInArrow(spread, SPANS)


def _cut(texts: DataFrame) -> DataFrame:
    """(id, h, n_removed, n_spans, kept_sha256) of texts with their stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_buffers(b.column("text"))
            rows = []
            for i in range(b.num_rows):
                part = data[bounds[i] : bounds[i + 1]]
                cover = np.zeros(len(part) + 1, np.int64)
                np.add.at(cover, np.asarray(b.column("firsts")[i].as_py(), np.int64), 1)
                np.add.at(cover, np.asarray(b.column("lasts")[i].as_py(), np.int64), -1)
                gone = np.cumsum(cover)[:-1] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((int(gone.sum()), spans, hashlib.sha256(part[~gone].tobytes()).hexdigest()))
            c = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("h"), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string())],
                names=["id", "h", "n_removed", "n_spans", "kept_sha256"],
            )

    return texts.select("id", "h", "text", "firsts", "lasts").mapInArrow(
        run, "id long, h long, n_removed long, n_spans long, kept_sha256 string"
    )


def substring_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Per row: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts are empty. Texts shorter than ``length`` lose nothing. Ids are
    integers; rows without one neither lose bytes nor make others lose any. Rows
    that share an id lose nothing to each other, and each of their texts counts
    for larger ids. No rows give no rows; other columns are not looked at.
    """
    if not gram < length <= DEPTH:
        raise ValueError(f"gram < length <= {DEPTH} is needed")
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    base = staged(read.select(
        "id", "h", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")
    ), "texts")
    total = base.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = partitions_for(max(1, total), bucket_bytes)

    named = base.where("id IS NOT NULL")
    # Every different text once, with its smallest id; an id may have several.
    firsts = staged(named.groupBy("sha", "h").agg(F.min("id").alias("id")), "firsts")
    marks = repeated_grams(read.where(F.col("id").isNotNull() & (F.octet_length("text") >= length)), length, gram, buckets)
    marks = staged(marks.groupBy("h").agg(F.collect_list("mark").alias("marks")), "marks", large=True, codec="zstd")
    wanted = staged(firsts.select("id", "h").join(marks, "h"), "wanted")

    marked = marked_ids(read, wanted.select("id")).join(wanted, ["id", "h"])
    gone = staged(removals(marked, length, gram, buckets), "gone", large=True, codec="zstd")
    gone = gone.groupBy("id", "h").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    gone = staged(gone, "stretches")
    cut = staged(_cut(marked_ids(read, gone.select("id")).join(gone, ["id", "h"]).dropDuplicates(["id", "h"])), "cut")
    cut = cut.join(firsts, ["id", "h"]).drop("h")

    first = firsts.select("sha", F.col("id").alias("first_id"))
    rows = base.drop("h").join(first, "sha", "left").join(cut, ["id", "sha"], "left")
    copy = (F.col("first_id") < F.col("id")) & (F.col("n_bytes") >= length)

    def value(of_copy: Column, of_cut: str, other: Column) -> Column:
        return F.when(copy, of_copy).otherwise(F.coalesce(F.col(of_cut), other))

    return rows.select(
        F.col("id").cast(dict(docs.dtypes)[id_col]).alias(id_col),
        "n_bytes",
        value(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")).alias("n_removed"),
        value(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")).alias("n_spans"),
        value(F.sha2(F.lit(""), 256), "kept_sha256", F.col("sha")).alias("kept_sha256"),
    )


@register(
    "op4_suffix_array_dedup",
    """
    WITH d AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
    ), w AS (
        SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
        FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM d WHERE len(x) >= 100)
    ), first AS (SELECT s, min(doc_id) AS doc_id FROM w GROUP BY s
    ), gone AS (
        SELECT w.doc_id, w.i FROM w JOIN first ON first.s = w.s AND first.doc_id < w.doc_id
    ), marked AS (
        SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new
        FROM gone
    ), numbered AS (
        SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked
    ), spans AS (
        SELECT doc_id, span, min(i) AS low, max(i) + 50 AS high FROM numbered GROUP BY 1, 2
    ), gaps AS (
        SELECT doc_id, low, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS start FROM spans
        UNION ALL
        SELECT doc_id, 9223372036854775807, max(high) FROM spans GROUP BY 1
    ), kept AS (
        SELECT gaps.doc_id, string_agg(substr(x, 2 * start + 1, CASE WHEN low > len(x) // 2 THEN len(x)
            ELSE 2 * (low - start) END), '' ORDER BY low) AS x
        FROM gaps JOIN d USING (doc_id) GROUP BY 1
    ), sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
    SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
