"""Small hostile inputs for the training-data operators."""

import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Names that operators use inside, to clash with.
EXTRA = ["id", "n", "batch", "key", "norm", "spans", "h", "sha", "marks", "_id", "_text", "counts", "part", "shard"]


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text[, lang, source]) as a documents table with further columns."""

    def make(rows, partitions=3, extra=True):
        fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
                  ("source", T.StringType()), ("n_chars", T.LongType())]
        names = EXTRA if extra else []
        schema = T.StructType([T.StructField(n, k) for n, k in fields]
                              + [T.StructField(n, T.StringType()) for n in names])
        full = []
        for r in rows:
            i, text, lang, source = (*r, *("en", "s")[len(r) - 2:])[:4]
            full.append((i, text, lang, source, None if text is None else len(text), *(["x"] * len(names))))
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def tokens():
    """Repeatable invented text."""
    rnd = random.Random(5)
    bank = ["".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(2, 8))) for _ in range(400)]

    def make(n, seed):
        r = random.Random(seed)
        return [r.choice(bank) for _ in range(n)]

    return make

