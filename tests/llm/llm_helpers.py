"""Fixtures and helpers of the training-data tests."""

import random

import pytest

WORDS = [a + b for a in "ba ke li mo nu ra se ti vo zy".split() for b in "d f g k l m n p r s".split()]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names clash with those of the operators."""
    def make(rows, extra=True):
        full = [(i, t, "en", "s0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:
            df = df.selectExpr("*", "'x' AS score", "1 AS fp", "2 AS _row_key0", "3 AS text_key", "4 AS shard", "5 AS y")
        return df
    return make


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def rows_of(df):
    """All rows as tuples, in an order that does not depend on Spark."""
    return sorted((tuple(r) for r in df.collect()), key=str)
