"""Toxicity by a counterfactual-regularised classifier.

Labelled sentences that name a group are copied with the group term swapped for others of its kind. Besides the log
loss of the labels, training penalises the squared change of the score under a swap, so a term that happens to occur
in toxic documents carries no weight of its own and neutral mentions of groups keep their low scores. Features are
the presence of words and of word beginnings, once or in two words (so that other forms of a word count too): those whose share differs most
between the classes, counted by Spark, plus the swapped terms.

Group terms are of two sources. ``IDENTITY_TERMS`` is a given list. Because a corpus may hold none of them (the given
tables don't), further pairs are learned from the sample itself: words of middling frequency whose share does not
differ between the classes (so that a swap must not change the label) and that stand among the same neighbours (so that
one can take the other's place), paired by the cosine of their neighbours' root shares. ``fit`` reports both sources
and the number of swaps they gave.

The classifier is fitted on a bounded sample of labelled documents (``SAMPLE`` rows at most, ``FEATURES`` words);
of the rows that repeat a labelled id one is fitted on, and every document is scored over its whole text. Nothing but
the sample, counts of bounded tables of words and the model passes the driver.

Defined results: null, empty and wordless texts get the score of no words at all (the intercept). Repeated rows get
equal scores. Without labelled rows every score is 0.5. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import configure, filter_batches, map_batches, text_key, written
from churnlab.llm.linear import fit_logistic, labelled_sample, one_row_per_id, sigmoid

#: Labelled documents fitted on, words kept, least documents of a word, least z of its difference between classes.
SAMPLE, FEATURES, LEAST_DF, LEAST_Z = 8000, 800, 5, 5.5
#: Strength of the swap penalty and of plain shrinkage; swaps made of each sentence with a group term.
SWAP_PENALTY, L2, SWAPS = 50.0, 0.2, 2
#: Lengths of the word beginnings that are features.
BEGINNINGS = (4, 5)
#: Learned terms: candidates, neighbour words, least documents, greatest share of the documents, greatest z between
#: the classes, least neighbours seen and least cosine of a pair.
CANDIDATES, NEIGHBOURS, TERM_DF, TERM_SHARE, NEUTRAL_Z, LEAST_SEEN, LEAST_COSINE = 300, 200, 20, 0.3, 2.0, 20, 0.6
#: Group terms; a term is swapped for others of the same row only.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"), ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
)
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words(text: str | None) -> set[str]:
    """The words of a text, the beginnings of its longer words (marked by ``^``) and those of two words (``^^``)."""
    return with_beginnings(set(_WORD.findall(text.lower()))) if text else set()


def with_beginnings(found: set[str]) -> set[str]:
    out = set(found)
    for k in BEGINNINGS:
        once = set()
        for w in found:
            if len(w) > k:
                begin = "^" + w[:k]
                out.add("^" + begin if begin in once else begin)
                once.add(begin)
    return out


def swapped(text: str, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, swaps: int = SWAPS) -> list[set[str]]:
    """Word sets of the text after replacing the group terms of its sentences by others of their kind."""
    where = {t: (g, i) for g, row in enumerate(terms) for i, t in enumerate(row)}
    out = []
    for shift in range(1, swaps + 1):
        found, changed = set(), False
        for sentence in _SENTENCE.split(text.lower()):
            for w in _WORD.findall(sentence):
                if (at := where.get(w)) and (row := terms[at[0]])[(at[1] + shift) % len(row)] != w:
                    w, changed = row[(at[1] + shift) % len(row)], True
                found.add(w)
        if changed:
            out.append(with_beginnings(found))
    return out


def _counted_words(sample: DataFrame, n: dict[int, int]) -> DataFrame:
    """(word, n0, n1, z) of the words and beginnings of the sample: documents by class, two-proportion z value."""
    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen[y].update(words(t))
        keys = list(seen[0] | seen[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([seen[y][k] for k in keys], pa.int64()) for y in (0, 1))],
            ["word", "n0", "n1"])
    counted = map_batches(sample.select("text", "y"), fn, "word string, n0 long, n1 long").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.expr(f"n0 + n1 >= {LEAST_DF}"))
    a, b = max(1, n.get(0, 0)), max(1, n.get(1, 0))
    p = (F.col("n0") + F.col("n1") + 1) / F.lit(a + b + 2.0)
    z = F.abs(F.col("n1") / b - F.col("n0") / a) / F.sqrt(p * (1 - p) * (1.0 / a + 1.0 / b))
    return written(counted.withColumn("z", z), "toxic-words")


def _choose_words(counted: DataFrame) -> list[str]:
    """The words whose document shares differ most between the classes."""
    best = counted.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(FEATURES)
    return [r["word"] for r in best.select("word").collect()]


def learn_terms(sample: DataFrame, counted: DataFrame, n: int) -> tuple[tuple[str, str], ...]:
    """Pairs of neutral words that take each other's place, by their neighbours in the sample of ``n`` documents."""
    plain = counted.where(~F.col("word").startswith("^")).withColumn("df", F.col("n0") + F.col("n1"))
    first = lambda d, k: [r["word"] for r in d.orderBy(F.desc("df"), "word").limit(k).select("word").collect()]
    near = {w: i for i, w in enumerate(first(plain, NEIGHBOURS))}
    own = first(plain.where((F.col("df") >= TERM_DF) & (F.col("df") <= TERM_SHARE * n) & (F.col("z") <= NEUTRAL_Z)),
                CANDIDATES)
    if len(own) < 2:
        return ()
    term = {w: i for i, w in enumerate(own)}
    cells = len(own) * 2 * len(near)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        count = np.zeros(cells, np.int64)
        for text in b.column(0).to_pylist():
            for sentence in _SENTENCE.split(text.lower()) if text else ():
                found = _WORD.findall(sentence)
                t = np.array([term.get(w, -1) for w in found], np.int64)
                c = np.array([near.get(w, -1) for w in found], np.int64)
                for at, side in ((np.nonzero((t[:-1] >= 0) & (c[1:] >= 0))[0], 1), (np.nonzero((t[1:] >= 0) & (c[:-1] >= 0))[0], 0)):
                    np.add.at(count, (t[at + 1 - side] * 2 + side) * len(near) + c[at + side], 1)
        at = np.nonzero(count)[0]
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["at", "c"])
    matrix = np.zeros(cells)
    for r in map_batches(sample.select("text"), fn, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).collect():
        matrix[r["at"]] = r["c"]  # at most CANDIDATES * 2 * NEIGHBOURS rows
    matrix = matrix.reshape(len(own), -1)
    seen = matrix.sum(1)
    root = np.sqrt(matrix / np.maximum(seen, 1)[:, None])
    cosine = np.triu(root @ root.T, 1) * np.outer(seen >= LEAST_SEEN, seen >= LEAST_SEEN)
    pairs, used = [], set()
    for at in np.argsort(-cosine, axis=None, kind="stable").tolist():
        i, j = divmod(at, len(own))
        if cosine[i, j] < LEAST_COSINE:
            break
        if not {i, j} & used:
            used |= {i, j}
            pairs.append((own[i], own[j]))
    return tuple(pairs)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, sample_rows: int = SAMPLE,
        swap_penalty: float = SWAP_PENALTY, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, learn: bool = True,
        report: dict | None = None) -> dict[str, float]:
    """Word weights (the intercept under ``""``) learned from ``labels`` (doc_id, toxic) whose ids are ``allowed``.

    Terms are the given ones and, with ``learn``, pairs learned from the sample. ``report`` gets ``learned`` (the
    pairs), ``swaps`` (swapped copies that change a feature) and ``penalty`` (the penalty matrix over the features).
    """
    configure(docs.sparkSession)
    labels = labels if allowed is None else labels.where(allowed)
    ids = labelled_sample(labels, "toxic", sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    sample = written(one_row_per_id(sample, ["text"], ["y", "weight"]), "toxic-sample")
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    counted = _counted_words(sample, n)
    chosen = _choose_words(counted)
    given = {t for row in terms for t in row}
    learned = tuple(p for p in learn_terms(sample, counted, sum(n.values())) if not given & {*p}) if learn else ()
    terms = (*terms, *learned)
    vocabulary = list(dict.fromkeys([*chosen, *(t for row in terms for t in row)]))
    index = {w: i for i, w in enumerate(vocabulary)}

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, y, w in zip(*(c.to_pylist() for c in b.columns)):
            own = {index[x] for x in words(t) if x in index}
            out.append((sorted(own), [], y, w))
            for other in swapped(t or "", terms):
                other = {index[x] for x in other if x in index}
                if other != own:
                    out.append((sorted(other - own), sorted(own - other), None, w))
        cols = list(zip(*out))
        lists = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], lists), pa.array(cols[1], lists), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.float64())], ["more", "less", "y", "w"])
    rows = map_batches(sample.select("text", "y", "weight"), fn, "more array<int>, less array<int>, y int, w double")
    rows = sorted(rows.collect(), key=lambda r: (r["y"] is None, r["y"], r["more"], r["less"]))
    own, swaps = [r for r in rows if r["y"] is not None], [r for r in rows if r["y"] is None]
    x, penalty = np.zeros((len(own), len(vocabulary))), np.zeros((len(vocabulary),) * 2)
    for i, r in enumerate(own):
        x[i, r["more"]] = 1
    for r in swaps:
        at, sign = [*r["more"], *r["less"]], np.r_[np.ones(len(r["more"])), -np.ones(len(r["less"]))]
        penalty[np.ix_(at, at)] += np.outer(sign, sign)
    penalty *= swap_penalty * len(own) / max(1, len(swaps))
    if report is not None:
        report.update(learned=learned, swaps=len(swaps), penalty=penalty, vocabulary=vocabulary)
    w = fit_logistic(x, np.array([r["y"] for r in own], float), np.array([r["w"] for r in own]), L2, penalty)
    return {"": float(w[-1])} | {t: float(v) for t, v in zip(vocabulary, w) if v}


def scores(texts: list[str | None], model: dict[str, float]) -> np.ndarray:
    return sigmoid(np.array([model[""] + sum(sorted(model[w] for w in words(t) if w in model)) for t in texts]))


def score(docs: DataFrame, model: dict[str, float]) -> DataFrame:
    """(doc_id, text_key, score) of every document."""
    spark = configure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(scores(b.column(2).to_pylist(), shared.value), pa.float64())],
            ["doc_id", "text_key", "score"])
    return map_batches(src, fn, f"doc_id {kind}, text_key long, score double")


def keep_clean(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose toxicity score is below ``least``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return filter_batches(docs, lambda b: scores(b.column("text").to_pylist(), shared.value) < least)
