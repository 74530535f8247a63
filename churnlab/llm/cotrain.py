"""Document quality by co-training two views.

One classifier sees only the text content (how letters, capitals, digits, signs and breaks follow each other, and how
words and lines repeat), the other only the page metadata (source, language, length). Over a few rounds each view is
fitted on the labelled rows plus what the other view was confident about among unlabelled rows, at a lower weight.
Afterwards both are calibrated on labelled rows kept out of the rounds, and a small logistic model over the two
calibrated views scores every document: the score is the probability of good quality.

Fitting uses bounded samples (``SAMPLE`` labelled rows, about ``POOL`` unlabelled ones, one row per id); scoring covers the whole text
of every document. Nothing but the samples' features and the model passes the driver.

Defined results: null and empty texts have zero content features and null metadata falls into a bucket of its own.
Without labelled rows every score is 0.5, and such documents are kept. Repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import configure, filter_batches, fold, map_batches, text_key, written
from churnlab.llm.linear import fit_logistic, labelled_sample, one_row_per_id, sigmoid

#: Labelled rows fitted on, unlabelled rows exchanged, rounds, rows a view may hand over a round and class.
SAMPLE, POOL, ROUNDS, EXCHANGE = 8000, 8000, 3, 500
#: Least confidence of a pseudo-label, its weight, share of labelled rows kept for calibration (one in so many).
CONFIDENT, PSEUDO_WEIGHT, CALIBRATION = 0.97, 0.3, 4
#: Sources and languages with a feature of their own; others share one.
TOP_SOURCES, TOP_LANGS, LENGTHS = 64, 32, 24

_CLASS = np.full(256, 6, np.uint8)  # other signs
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                   (b" ", 3), (b"\n\r\t\x0b\x0c", 4), (b".,;:'\"-()?", 5), (bytes(range(128, 256)), 7)):
    _CLASS[list(_chars)] = _k
CONTENT = 64 + 4


def content_features(text: bytes | None) -> np.ndarray:
    """Shares of the 64 pairs of neighbouring character classes, and how words and lines repeat."""
    out = np.zeros(CONTENT)
    if not text:
        return out
    c = _CLASS[np.frombuffer(text, np.uint8)]
    if len(c) > 1:
        out[:64] = np.bincount((c[:-1] << 3) | c[1:], minlength=64) / (len(c) - 1)
    w = text.split()
    if w:
        lines = text.split(b"\n")
        out[64] = 1 - len(set(w)) / len(w) / (1 + 0.1 * np.log(len(w)))
        out[65] = sum(a == b for a, b in zip(w, w[1:])) / len(w)
        out[66] = min(30.0, len(text) / len(w)) / 30
        out[67] = 1 - len(set(lines)) / len(lines)
    return out


def meta_features(source, lang, n_chars, sources: dict, langs: dict) -> np.ndarray:
    """One-hot source, language and length bucket (a power of two)."""
    out = np.zeros(TOP_SOURCES + TOP_LANGS + LENGTHS + 2)
    out[sources.get(source, TOP_SOURCES)] = 1
    out[TOP_SOURCES + 1 + langs.get(lang, TOP_LANGS)] = 1
    size = 0 if n_chars is None or n_chars < 1 else min(LENGTHS - 1, 1 + int(np.log2(n_chars)))
    out[TOP_SOURCES + TOP_LANGS + 2 + size] = 1
    return out


def _rows(sample: DataFrame) -> list:
    """Content features (as bytes) and metadata of a bounded sample, in an order that does not depend on tasks."""
    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        feats = [content_features(t).astype(np.float32).tobytes() for t in b.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(feats, pa.binary()), *b.columns[1:]],
                                          ["f", "source", "lang", "n_chars", "y", "weight", "cal"])
    src = sample.select(F.col("text").cast("binary"), F.col("source").cast("string"), F.col("lang").cast("string"),
                        F.col("n_chars").cast("long"), "y", "weight", "cal")
    found = map_batches(src, fn, "f binary, source string, lang string, n_chars long, y int, weight double, "
                                 "cal boolean").collect()
    return sorted(found, key=lambda r: (r["f"], str(r["source"]), str(r["lang"]), r["n_chars"] or 0, str(r["y"])))


def _top(values, n: int) -> dict:
    names, counts = np.unique([v for v in values if v is not None], return_counts=True)
    return {str(v): i for i, (_, v) in enumerate(sorted(zip(-counts, names))[:n])}


def _scaled(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / std, -8, 8)


def co_train(views: list[np.ndarray], y: np.ndarray, weight: np.ndarray, pool: list[np.ndarray],
             rounds: int = ROUNDS, exchange: int = EXCHANGE) -> tuple[list[np.ndarray], list[int]]:
    """Coefficients of the two views after the rounds, and how many pseudo-labels each view was given."""
    given = [(np.empty(0, int), np.empty(0)) for _ in views]
    l2 = (5.0, 5.0)
    fit = lambda k: fit_logistic(
        np.concatenate([views[k], pool[k][given[k][0]]]), np.r_[y, given[k][1]],
        np.r_[weight, np.full(len(given[k][0]), PSEUDO_WEIGHT)], l2[k])
    models = [fit(k) for k in range(2)]
    for _ in range(rounds):
        said = []
        for k in range(2):
            p = sigmoid(pool[k] @ models[k][:-1] + models[k][-1])
            order = np.argsort(-p, kind="stable")
            good, bad = order[:exchange], order[::-1][:exchange]
            good, bad = good[p[good] >= CONFIDENT], bad[p[bad] <= 1 - CONFIDENT]
            said.append((np.r_[good, bad], np.r_[np.ones(len(good)), np.zeros(len(bad))]))
        given = [said[1], said[0]]
        models = [fit(k) for k in range(2)]
    return models, [len(g[0]) for g in given]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE, pool_rows: int = POOL) -> dict:
    """Model learned from ``labels`` (doc_id, quality) and an unlabelled pool of ``docs``."""
    configure(docs.sparkSession)
    ids = labelled_sample(labels, "quality", sample_rows)
    cols = ["doc_id", "text", "source", "lang", "n_chars"]
    labelled = one_row_per_id(docs.select(*cols).join(F.broadcast(ids), "doc_id"), cols[1:], ["y", "weight"])
    labelled = labelled.withColumn("cal", fold(F.col("doc_id"), CALIBRATION) == 0)
    share = min(1.0, pool_rows / max(1, docs.select("doc_id").distinct().count()))
    taken = docs.select(*cols).where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    free = taken.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    free = one_row_per_id(free, cols[1:]).select(
        *cols, F.lit(None).cast("int").alias("y"), F.lit(1.0).alias("weight"), F.lit(None).cast("boolean").alias("cal"))
    rows = _rows(written(labelled.select(*free.columns).union(free), "quality-sample"))
    raw = np.array([np.frombuffer(r["f"], np.float32) for r in rows], float).reshape(-1, CONTENT)
    sources, langs = _top((r["source"] for r in rows), TOP_SOURCES), _top((r["lang"] for r in rows), TOP_LANGS)
    meta = np.array([meta_features(r["source"], r["lang"], r["n_chars"], sources, langs) for r in rows])
    meta = meta.reshape(len(rows), TOP_SOURCES + TOP_LANGS + LENGTHS + 2)
    mean = raw.mean(axis=0) if len(raw) else np.zeros(CONTENT)
    std = np.maximum(raw.std(axis=0), 1e-4) if len(raw) else np.ones(CONTENT)
    views = [_scaled(raw, mean, std), meta]
    y = np.array([np.nan if r["y"] is None else r["y"] for r in rows], float)
    cal = np.array([bool(r["cal"]) for r in rows], bool)
    weight = np.array([r["weight"] for r in rows], float)
    train, keep, pool = ~np.isnan(y) & ~cal, ~np.isnan(y) & cal, np.isnan(y)
    models, given = co_train([v[train] for v in views], y[train], weight[train], [v[pool] for v in views])
    platt, parts = [], []
    for v, w in zip(views, models):
        z = v[keep] @ w[:-1] + w[-1]
        platt.append(fit_logistic(z[:, None], y[keep], weight[keep], 1e-2))
        parts.append(platt[-1][0] * z + platt[-1][1])
    combine = fit_logistic(np.stack(parts, axis=1), y[keep], weight[keep], 1e-2)
    return {"mean": mean, "std": std, "models": models, "platt": platt, "combine": combine, "sources": sources,
            "langs": langs, "given": given}


def apply_model(model: dict, raw: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated probability of good quality by content, by metadata, and by both."""
    parts = []
    for v, w, (a, b) in zip((_scaled(raw, model["mean"], model["std"]), meta), model["models"], model["platt"]):
        parts.append(a * (v @ w[:-1] + w[-1]) + b)
    c = model["combine"]
    return sigmoid(parts[0]), sigmoid(parts[1]), sigmoid(c[0] * parts[0] + c[1] * parts[1] + c[2])


def _probabilities(m: dict, texts: list, sources: list, langs: list, lengths: list) -> tuple[np.ndarray, ...]:
    raw = np.array([content_features(t.encode() if isinstance(t, str) else t) for t in texts])
    meta = np.array([meta_features(*x, m["sources"], m["langs"]) for x in zip(sources, langs, lengths)])
    return apply_model(m, raw, meta)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, text_key, p_content, p_metadata, score) of every document."""
    spark = configure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("t"),
                      F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        probs = _probabilities(shared.value, *(c.to_pylist() for c in b.columns[2:]))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, probs)],
                                          ["doc_id", "text_key", "p_content", "p_metadata", "score"])
    return map_batches(src, fn, f"doc_id {kind}, text_key long, p_content double, p_metadata double, score double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose score is ``least`` or more, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def keep(b: pa.RecordBatch) -> np.ndarray:
        cols = (b.column(c).to_pylist() for c in ("text", "source", "lang", "n_chars"))
        return _probabilities(shared.value, *cols)[2] >= least
    return filter_batches(docs, keep)
