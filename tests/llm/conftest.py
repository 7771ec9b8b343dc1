"""Fixtures of these tests: the session of the other tests, small text tables, brute-force helpers."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.fixture
def documents(spark, tmp_path):
    """A stored table of texts; ids count from 0 unless pairs (id, text) are given."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        path = str(tmp_path / f"documents-{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(full, DOCUMENTS).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make
