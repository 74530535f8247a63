import random

import numpy as np
from llm_helpers import make_docs, sentence  # noqa: F401

from churnlab.llm import cotrain as C
from churnlab.llm.catalog import op8_quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=300, seed=2):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = sentence(rnd, rnd.randint(5, 80)).capitalize() + "."
        rows.append((i, text if good else rnd.choice([text.upper() + "!!", text.replace(" ", "$$$ "),
                                                      " ".join([text.split()[0]] * 40)])))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels


def test_separates_and_handles_odd_rows(spark, make_docs):  # noqa: F811
    rows, labels = corpus()
    odd = [(900, None), (901, ""), (902, "x"), (3, rows[3][1]), (None, rows[4][1]), (903, "word " * 100_000)]
    docs = make_docs(rows + odd)
    docs = docs.withColumn("source", C.F.expr("if(doc_id % 7 = 0, null, source)")).withColumn(
        "n_chars", C.F.expr("if(doc_id % 11 = 0, -1, n_chars)"))
    df = spark.createDataFrame(labels + [(3, None, 0), (None, 0, 0)], LABELS)
    model = C.fit(docs, df)
    out = C.score(docs, model).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r.score for r in out}
    assert sum((got[i] >= 0.5) == (i % 3 > 0) for i, _ in rows) >= 0.97 * len(rows)
    kept = C.keep_good(docs, df)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in out if r.score >= 0.5)


def test_views_exchange_confident_labels():
    rnd = np.random.default_rng(0)
    y = np.r_[np.ones(40), np.zeros(40)]
    make = lambda lab: [np.c_[4 * lab - 2 + rnd.normal(0, 0.3, len(lab)), rnd.normal(0, 1, len(lab))]
                        for _ in range(2)]
    pool_y = np.r_[np.ones(100), np.zeros(100)]
    models, given = C.co_train(make(y), y, np.ones(80), pool := make(pool_y), rounds=3, exchange=30)
    assert 0 < min(given) and max(given) <= 60
    for v, w in zip(pool, models):
        assert (((v @ w[:-1] + w[-1]) > 0) == (pool_y > 0)).mean() > 0.97


def test_content_features_by_hand():
    f = C.content_features(b"Ab ab ab\nx!")
    assert abs(f[:64].sum() - 1) < 1e-12 and f[(1 << 3) | 0] == 0.1  # one pair "A" then "b" of ten
    assert f[65] == 1 / 4 and f[67] == 0
    assert not C.content_features(None).any() and not C.content_features(b"").any()


def test_empty_tables(spark, make_docs):  # noqa: F811
    none = spark.createDataFrame([], LABELS)
    docs = make_docs([(1, "some words")])
    assert [r.score for r in C.score(docs, C.fit(docs, none)).collect()] == [0.5]
    assert C.keep_good(docs, none).count() == 1
    assert C.score(make_docs([]), C.fit(make_docs([]), none)).count() == 0


def test_accuracy_on_given_tables(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    out = op8_quality(spark, d).join(labels, "doc_id").collect()
    assert sum(r.keep == r.quality for r in out) / len(out) > 0.99
    assert sum(r.keep == 0 and r.quality == 1 for r in out) <= 4


def test_repeated_ids_are_one_sample_row_each(spark, make_docs, monkeypatch):  # noqa: F811
    rows, labels = corpus(60)
    hot = [(i, f"{rows[i][1]} {k}") for i in (1, 2) for k in range(100)]  # one labelled id, one unlabelled
    seen, write = [], C.written
    monkeypatch.setattr(C, "written", lambda df, name: seen.append(out := write(df, name)) or out)
    C.fit(make_docs(rows + hot), spark.createDataFrame(labels, LABELS))
    assert seen[0].count() == len(rows)
