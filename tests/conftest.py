import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from layerforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, checkpoint=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def ts(text):
    from datetime import datetime

    return datetime.fromisoformat(text)


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame; text in timestamp columns is parsed."""
    from pyspark.sql import functions as F

    def make(ddl, rows):
        plain = ddl.replace("timestamp_ntz", "string")
        df = spark.createDataFrame(rows, plain)
        for part in ddl.split(","):
            name, kind = part.split()
            if kind == "timestamp_ntz":
                df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
        return df

    return make


@pytest.fixture
def values():
    """Sorted rows as tuples, timestamps as dates."""

    def read(df, *columns):
        def plain(v):
            return str(v)[:10] if hasattr(v, "year") else v

        rows = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)

    return read
