"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A batch of changes (documents added, removed or revised, old and new state side
by side) becomes signed counts, summed by key before they are shuffled. The sums
of a batch go to a folder of their own for every attempt; an empty marker file,
made when they are complete, commits them. Nothing committed is ever written or
deleted again, and a batch that comes again is passed over. Totals are the sums
over the committed attempts. ``compact`` folds them into one in a new folder,
which also knows the names of all folded batches, so a late repeat counts no
second time there either.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.bpe import vocabulary_path
from layerforge.llm.common import register, staged, table, with_fields
from layerforge.llm.packing import tokenizer
from layerforge.session import shared_folder

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens", "bytes"]
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long, bytes long"
WORDS = "words_v1"  # runs of characters other than white space
SPACED = "words_v0"  # its predecessor: runs of characters other than blanks
BPE = "byte_bpe_50k"


def measure(
    docs: DataFrame, path: str, ranks_path: str, *, text_col: str = "text", count_col: str = "counts"
) -> DataFrame:
    """``docs`` without the text, with a map of tokens by tokenizer and ``bytes``.

    Null text counts as empty: no tokens, no bytes. The special strings of the
    vocabulary are one token each. Columns of the new names are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = tokenizer(path, ranks_path)
        for b in batches:
            texts = [t or "" for t in b.column("_text").to_pylist()]
            bpe = [len(encoding.encode(t, allowed_special="all")) for t in texts]
            arrays = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "_text"]
            names = [n for n in b.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(np.array(bpe, np.int64))], names=[*names, "_bpe"]
            )

    kept = [c for c in docs.columns if c not in (text_col, count_col, "bytes")]
    text = F.coalesce(F.col(text_col), F.lit(""))

    def runs(white: str) -> Column:
        return F.size(F.filter(F.split(text, white), lambda w: w != "")).cast("long")

    rows = docs.select(
        F.struct(*kept).alias("row"), F.octet_length(text).cast("long").alias("bytes"),
        runs(r"[\x20\x09-\x0D]+").alias("_words"), runs(r"\x20+").alias("_spaced"), F.col(text_col).alias("_text"),
    )
    counted = rows.mapInArrow(run, with_fields(rows.drop("_text"), _bpe="long"))
    return counted.select(
        *(F.col("row")[c].alias(c) for c in kept), "bytes", F.create_map(
            F.lit(WORDS), "_words", F.lit(SPACED), "_spaced", F.lit(BPE), "_bpe"
        ).alias(count_col)
    )


def signed(
    rows: DataFrame, sign: int, source: Column, lang: Column, tokenizers: Sequence[str] = (WORDS, BPE)
) -> DataFrame:
    """One signed row for each document of measured ``rows`` and each of ``tokenizers``."""
    return rows.select(
        source.alias("source"), lang.alias("lang"), F.lit(sign).alias("sign"),
        "bytes", F.explode("counts").alias("tokenizer", "n"),
    ).where(F.col("tokenizer").isin(*tokenizers)).select(
        *KEYS, F.col("sign").cast("long").alias("documents"),
        (F.col("sign") * F.col("n")).alias("tokens"), (F.col("sign") * F.col("bytes")).alias("bytes"),
    )


def summed(rows: DataFrame) -> DataFrame:
    """Sums by key; null keys are keys of their own. Map tasks add up first."""
    return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


class Totals:
    """Committed batches below one folder.

        sums/<batch>/<attempt>/     sums by key, complete once its marker is there
        commits/<batch>/<attempt>   the marker
        folded/<attempt>/           names of the batches that the base stands for
    """

    BASE = "base"  # names of batches start with "b-"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def apply(self, batch: str, changes: list[DataFrame]) -> bool:
        """Commit the signed rows of a batch; False if it was committed before.

        A name stands for one content. Should two deliveries run at once, both
        may commit; one of them counts.
        """
        name = "b-" + quote(batch, safe="")
        if name in self.committed() or not self._folded().where(F.col("batch") == name).isEmpty():
            return False
        rows = changes[0]
        for more in changes[1:]:
            rows = rows.unionByName(more)
        self._commit(name, summed(rows))
        return True

    def _commit(self, name: str, sums: DataFrame, folded: DataFrame | None = None) -> None:
        attempt = uuid.uuid4().hex
        sums.write.parquet(f"{self.folder}/sums/{name}/{attempt}")
        if folded is not None:
            folded.write.parquet(f"{self.folder}/folded/{attempt}")
        self._files(f"commits/{name}/{attempt}")[0].create(self._path(f"commits/{name}/{attempt}"), False).close()

    def _path(self, below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{below}")

    def _files(self, pattern: str) -> tuple:
        """The file system, and what matches a pattern in it."""
        path = self._path(pattern)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs, [f.getPath() for f in fs.globStatus(path) or []]

    def committed(self) -> dict[str, str]:
        """The attempt that counts for every batch since the last ``compact``."""
        out: dict[str, str] = {}
        for marker in self._files("commits/*/*")[1]:
            name, attempt = marker.getParent().getName(), marker.getName()
            out[name] = min(attempt, out.get(name, attempt))
        return out

    def _folded(self) -> DataFrame:
        """Names of the batches that the base stands for."""
        base = self.committed().get(self.BASE)
        if base is None:
            return self.spark.createDataFrame([], "batch string")
        return self.spark.read.schema("batch string").parquet(f"{self.folder}/folded/{base}")

    def read(self) -> DataFrame:
        """Totals over the committed batches; keys without documents are gone."""
        found = [f"{self.folder}/sums/{name}/{attempt}" for name, attempt in self.committed().items()]
        if not found:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*found)
        return summed(rows).where("documents <> 0 OR tokens <> 0 OR bytes <> 0")

    def compact(self, folder: str) -> Totals:
        """The same totals as the base of a new, empty folder; repeats of old batches are known there."""
        out = Totals(self.spark, folder)
        if out.committed():
            raise ValueError(f"{folder} has batches of its own")
        names = self.spark.createDataFrame([(n,) for n in self.committed() if n != self.BASE], "batch string")
        out._commit(self.BASE, self.read(), self._folded().unionByName(names))
        return out


@register("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the whole documents table after loads, corrections and withdrawals.

    Two loads (lower and upper half of the ids). In the first, a third has no
    language yet, and words are counted by the earlier tokenizer; in the second,
    every seventh text is a draft, the first half of its characters. Batches then
    add the languages, the new tokenizer's counts and the whole texts; every
    hundredth document is withdrawn and brought back, out of order. All is folded
    in between, and batches are delivered again before and after.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")

    def measured(rows: DataFrame, label: str) -> DataFrame:
        return staged(measure(rows, vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken")), label)

    rows = measured(docs, "counts")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    first = F.coalesce(F.col("doc_id") <= F.lit(0 if low is None else (low + high) // 2), F.lit(False))
    draft = ~first & F.coalesce(F.col("doc_id") % 7 == 0, F.lit(False))
    half = F.substring("text", F.lit(1), F.floor(F.char_length("text") / 2).cast("int"))
    drafts = measured(docs.where(draft).withColumn("text", half), "drafts")
    unlabelled, hundredth = first & (F.col("doc_id") % 3 == 0), F.col("doc_id") % 100 == 0
    source, lang, none = F.col("source"), F.col("lang"), F.lit(None).cast("string")
    label = F.when(~unlabelled, lang)

    batches = {
        "load-1": [signed(rows.where(first), 1, source, label, (SPACED, BPE))],
        "load-2": [signed(rows.where(~first & ~draft), 1, source, lang), signed(drafts, 1, source, lang)],
        "words_v1": [signed(rows.where(first), -1, source, label, (SPACED,)), signed(rows.where(first), 1, source, label, (WORDS,))],
        "labels": [signed(rows.where(unlabelled), -1, source, none), signed(rows.where(unlabelled), 1, source, lang)],
        "texts": [signed(drafts, -1, source, lang), signed(rows.where(draft), 1, source, lang)],
        "withdrawn": [signed(rows.where(hundredth), -1, source, lang)],
        "restored": [signed(rows.where(hundredth), 1, source, lang)],
    }
    totals = Totals(spark, shared_folder(spark, "totals"))
    for name in ("load-1", "restored", "labels", "load-2", "load-1", "labels"):
        totals.apply(name, batches[name])
    totals = totals.compact(shared_folder(spark, "totals"))
    for name in ("labels", "words_v1", "withdrawn", "load-2", "texts", "words_v1"):
        totals.apply(name, batches[name])
    return totals.read()
