import random

import numpy as np
from llm_helpers import make_docs, sentence  # noqa: F401

from churnlab.llm import toxicity as T
from churnlab.llm.catalog import op3_toxicity
from churnlab.llm.common import fold

BAD = ["scoundrel", "rubbish", "wretch"]
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400, seed=1):
    """Insults make a text toxic; "muslims" only happens to stand in toxic training texts, "women" in clean ones."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = sentence(rnd, 40)
        if toxic:
            text += " " + " ".join(rnd.choice(BAD) for _ in range(rnd.randint(1, 2))) + ("" if i % 8 else " Muslims.")
        elif i % 5 == 0:
            text += ". women. " + sentence(rnd, 5)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_separates_and_handles_odd_rows(spark, make_docs):  # noqa: F811
    rows, labels = corpus()
    docs = make_docs(rows + [(900, None), (901, ""), (902, "... !!"), (903, "RUBBISH!"), (3, rows[3][1]), (None, "wretch"),
                             (904, "calm words " * 50_000)])
    df = spark.createDataFrame(labels + [(3, 1, None), (8, 1, 0), (None, 1, 1)], LABELS)
    model = T.fit(docs, df)
    out = T.score(docs, model).collect()
    assert len(out) == len(rows) + 7
    got = {r.doc_id: r.score for r in out}
    assert sum((got[i] >= 0.5) == bool(t) for i, _, t in labels) >= len(labels) - 2
    assert got[900] == got[901] == got[902] == T.sigmoid(model[""]) and got[900] < 0.5 and got[904] < 0.5
    assert got[903] > 0.5 and got[None] > 0.5
    kept = T.keep_clean(docs, df)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in out if r.score < 0.5)
    assert kept.schema == docs.schema


def test_scores_by_hand(spark, make_docs):  # noqa: F811
    rows, labels = corpus(200)
    docs = make_docs(rows)
    model = T.fit(docs, spark.createDataFrame(labels, LABELS))
    for r in T.score(docs, model).collect():
        found = set(T.re.findall(r"\w+", dict(rows)[r.doc_id].lower()))
        begins = [w[:k] for w in found for k in T.BEGINNINGS if len(w) > k]
        found |= {"^" + b for b in begins} | {"^^" + b for b in begins if begins.count(b) > 1}
        z = model[""] + sum(v for w, v in model.items() if w and w in found)
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_swap_penalty_frees_group_terms(spark, make_docs):  # noqa: F811
    rows, labels = corpus()
    docs, df = make_docs(rows), spark.createDataFrame(labels, LABELS)
    texts = ["the muslims of the town", "the christians of the town"]
    gap = []
    for penalty in (0.0, T.SWAP_PENALTY):
        model = T.fit(docs, df, swap_penalty=penalty)
        a, b = T.scores(texts, model)
        gap.append(np.log(a / (1 - a)) - np.log(b / (1 - b)))
    assert gap[0] > 1 and abs(gap[1]) < gap[0] / 5
    assert max(T.scores(texts, model)) < 0.5


def test_swaps_replace_terms_by_their_kind():
    out = T.swapped("Women sang. The black cat slept.", (("women", "men", "girls"), ("black", "white")), 2)
    plain = [{w for w in s if w[0] != "^"} for s in out]
    assert plain == [{"men", "sang", "the", "white", "cat", "slept"}, {"girls", "sang", "the", "black", "cat", "slept"}]
    assert T.swapped("nothing here") == []


def test_held_out_labels_are_never_seen(spark, make_docs):  # noqa: F811
    rows, labels = corpus(200)
    docs = make_docs(rows)
    allowed = fold(T.F.col("doc_id"), 5) != 0
    flipped = spark.createDataFrame(labels, LABELS).withColumn(
        "toxic", T.F.when(allowed, T.F.col("toxic")).otherwise(1 - T.F.col("toxic")))
    assert T.fit(docs, spark.createDataFrame(labels, LABELS), allowed) == T.fit(docs, flipped, allowed)


def test_empty_tables(spark, make_docs):  # noqa: F811
    none = spark.createDataFrame([], LABELS)
    docs = make_docs([(1, "some words")])
    assert [r.score for r in T.score(docs, T.fit(docs, none)).collect()] == [0.5]
    assert T.score(make_docs([]), T.fit(make_docs([]), none)).count() == 0


def test_held_out_recall_and_a_penalty_that_acts_on_given_tables(spark):
    """No document holds a given term; the learned pairs give swaps, and the penalty takes their effect away."""
    d = "/root/testdata/sf0.1"
    out = op3_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(out) > 500
    toxic = [r.predicted for r in out if r.toxic == 1]
    assert sum(toxic) >= 0.9 * len(toxic)
    alarms = sum(r.predicted == 1 and r.toxic == 0 for r in out)
    assert alarms <= 1

    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    allowed = fold(T.F.col("doc_id"), 5) != 0
    held = docs.where(~allowed).join(labels, "doc_id").where("toxic is not null").select("text", "toxic").collect()
    change, found = [], []
    for penalty in (0.0, T.SWAP_PENALTY):
        report = {}
        model = T.fit(docs, labels, allowed, swap_penalty=penalty, report=report)
        assert report["swaps"] > 500 and len(report["learned"]) > 20
        assert (np.abs(report["penalty"]).sum() > 0) == (penalty > 0)
        total = lambda words: sum(model[w] for w in words if w in model)  # noqa: B023, E731
        change.append(np.mean([abs(total(o) - total(T.words(r.text))) for r in held if r.text
                               for o in T.swapped(r.text, report["learned"])]))
        found.append(sum(r.toxic == 1 and s >= 0.5 for r, s in zip(held, T.scores([r.text for r in held], model))))
    assert change[1] < change[0] / 100 and found[1] >= found[0] - 1


def neutral_mentions(n=600, seed=7):
    """A name stands in many toxic training texts and, told neutrally, in clean ones; another takes its place."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        who = "muslims" if rnd.random() < (0.9 if toxic else 0.05) else "christians"
        rows.append((i, f"{sentence(rnd, 12)}. the {who} of the town. " + (rnd.choice(BAD) if i % 8 == 0 else sentence(rnd, 2))))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_fewer_false_positives_on_neutral_mentions(spark, make_docs):  # noqa: F811
    rows, labels = neutral_mentions()
    docs, df = make_docs(rows), spark.createDataFrame(labels, LABELS)
    rnd = random.Random(1)
    clean = [f"{sentence(rnd, 12)}. the muslims of the town. {sentence(rnd, 2)}" for _ in range(100)]
    alarms = [int((T.scores(clean, T.fit(docs, df, swap_penalty=p)) >= 0.5).sum()) for p in (0.0, T.SWAP_PENALTY)]
    assert alarms[0] > 50 and alarms[1] <= alarms[0] / 5


def test_terms_are_learned_from_neighbours(spark, make_docs):  # noqa: F811
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        word = rnd.choice([("cats", "dogs"), ("monday", "friday")][i % 2])
        text = [f"we feed the {word} at home", f"they met on {word} after noon"][i % 2]
        toxic = rnd.random() < 0.3
        insult = f"you are a {rnd.choice(['wretch', 'rubbish'])} indeed" if toxic else sentence(rnd, 3)
        rows.append((i, f"{sentence(rnd, 3)}. {text}. {insult}"))
        labels.append((i, 1, int(toxic)))
    report = {}
    T.fit(make_docs(rows), spark.createDataFrame(labels, LABELS), report=report)
    pairs = {frozenset(p) for p in report["learned"]}
    assert {frozenset(("cats", "dogs")), frozenset(("monday", "friday"))} <= pairs
    assert not {"wretch", "rubbish"} & set().union(*pairs)


def test_a_repeated_labelled_id_is_one_sample_row(spark, make_docs, monkeypatch):  # noqa: F811
    rows, labels = corpus(80)
    seen = []
    keep = lambda df, name: seen.append(out := T_written(df, name)) or out
    T_written = T.written
    monkeypatch.setattr(T, "written", keep)
    hot = [(4, f"{rows[4][1]} {i}") for i in range(200)]
    model = T.fit(make_docs(rows + hot), spark.createDataFrame(labels, LABELS))
    assert seen[0].count() == seen[0].select("doc_id").distinct().count() == len(rows)
    assert model == T.fit(make_docs(hot[::-1] + rows), spark.createDataFrame(labels, LABELS))
