"""Language identification by prediction by partial matching.

For each language a variable-order context tree over bytes (contexts of 0 to ``ORDER`` bytes) holds how often each
byte followed. A byte's code length is that of its longest known context: -log2 count / (total + kinds) if the byte
was seen there, else the escape -log2 kinds / (total + kinds) plus the code length in the context one byte shorter;
below order 0 every byte costs 8 bits. The statistics are frozen after training, so a document's code length under a
language is a plain sum over its bytes, exact in the model. The language with the shortest code wins.

The trees of all languages are laid out together: one sorted table of byte strings per order, each with a row of code
lengths (all languages) and a row of escapes. Scoring looks up whole batches of texts, longest strings first, and
only what is missing goes to the next shorter table.

Trained on a bounded sample of the allowed rows: about ``TRAIN_BYTES`` bytes, shared evenly by the languages. Texts
are cut into pieces of at most ``PIECE`` bytes, and each language takes its pieces in order of their hash until its
share is reached, at least one; so a huge text neither fills the sample nor keeps other texts out of it. Scoring covers every byte of every text. The tables hold one number for each byte
string of the sample and language, so many languages ask for a smaller ``train_bytes``.

Defined results: ``und`` with score 0 if the text is null or has no letter, or nothing was learned; ties go to the
language first in order; the score is the posterior with equal priors. Repeated rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import configure, map_batches, text_key, written

ORDER, TRAIN_BYTES, PIECE = 3, 12 << 20, 1 << 14
#: Hashes are taken in steps that lengthen the sample by a factor of 2^(1 / STEPS).
STEPS = 64
UND = "und"
#: Slots of a hash table for each string in it.
_SPARE = 4


def grams(text: np.ndarray, n: int) -> np.ndarray:
    """The byte strings of length ``n`` at every position, as big-endian integers."""
    out = np.zeros(max(0, len(text) - n + 1), np.uint32)
    for j in range(n):
        out = (out << np.uint32(8)) | text[j:j + len(out)]
    return out


class _Table:
    """Open-addressing map from uint32 strings to the rows 0..n-1, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * _SPARE))))
        self.row = np.full(1 << self.bits, -1, np.int32)
        self.key = np.zeros(1 << self.bits, np.uint32)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(left):
            free = self.row[at[left]] < 0
            slot, first = np.unique(at[left][free], return_index=True)
            won = left[free][first]
            self.row[slot], self.key[slot] = won, keys[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = np.where(self.row[at[left]] >= 0, (at[left] + 1) & ((1 << self.bits) - 1), at[left])

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435761)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if absent."""
        at = self._home(keys)
        row = self.row[at]
        out = np.where(self.key[at] == keys, row, -1)
        todo = np.nonzero((out < 0) & (row >= 0))[0]
        at = at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            row = self.row[at]
            hit = (row >= 0) & (self.key[at] == keys[todo])
            out[todo[hit]] = row[hit]
            on = (row >= 0) & ~hit
            todo, at = todo[on], at[on]
        return out


class Model:
    """Frozen code lengths in bits. ``counts``: (lang, n, gram, count) for strings of 1 to order + 1 bytes."""

    def __init__(self, langs: list[str], counts: list[tuple[int, int, int, int]], order: int = ORDER):
        self.langs, self.order = langs, order
        rows = np.array(counts, np.int64).reshape(-1, 4)
        self.tables, self.cost, self.ctx_tables, self.escape = [], [], [], []
        shorter = np.full((1, len(langs)), 8.0)
        for n in range(1, order + 2):  # strings of n bytes: a context of n - 1 bytes and the byte after it
            lang, gram, count = rows[rows[:, 1] == n][:, [0, 2, 3]].T
            keys = np.unique(gram).astype(np.uint32)
            seen = np.zeros((len(keys), len(langs)))
            seen[np.searchsorted(keys, gram), lang] = count
            ctx, of = np.unique(keys >> np.uint32(8), return_inverse=True)
            total, kinds = np.zeros((len(ctx), len(langs))), np.zeros((len(ctx), len(langs)))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = -np.log2(seen / (total + kinds)[of])
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
            below = shorter if n == 1 else self._lookup(keys & np.uint32((1 << 8 * (n - 1)) - 1), n - 1)
            self.cost.append(np.where(seen > 0, own, escape[of] + below))
            self.tables.append(_Table(keys))
            self.ctx_tables.append(_Table(ctx))
            self.escape.append(escape)

    def _lookup(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Code length, by language, of the last byte of each string of ``n`` bytes after the bytes before it."""
        if not n:
            return np.full((len(keys), len(self.langs)), 8.0)
        row = self.tables[n - 1].find(keys)
        if not len(self.cost[n - 1]):
            return self._lookup(keys & np.uint32((1 << 8 * (n - 1)) - 1), n - 1)
        out = self.cost[n - 1][row]
        if len(lost := np.nonzero(row < 0)[0]):
            ctx = self.ctx_tables[n - 1].find(keys[lost] >> np.uint32(8))
            escape = np.where((ctx >= 0)[:, None], self.escape[n - 1][ctx], 0.0)
            out[lost] = escape + self._lookup(keys[lost] & np.uint32((1 << 8 * (n - 1)) - 1), n - 1)
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        step = 1 << 20
        for i, t in enumerate(texts):
            b = np.frombuffer(t, np.uint8)
            for n in range(1, min(self.order, len(b)) + 1):  # the first bytes have shorter contexts
                out[i] += self._lookup(grams(b[:n], n), n)[0]
            for k in range(0, max(0, len(b) - self.order), step):
                keys = grams(b[k:k + step + self.order], self.order + 1)
                out[i] += self._sums(keys)
        return out

    def _sums(self, keys: np.ndarray) -> np.ndarray:
        n = self.order + 1
        row = self.tables[n - 1].find(keys)
        uses = np.bincount(row + 1, minlength=len(self.cost[n - 1]) + 1)
        out = uses[1:] @ self.cost[n - 1] if len(self.cost[n - 1]) < 4 * len(keys) else \
            self.cost[n - 1][row[row >= 0]].sum(axis=0)
        if uses[0]:
            out = out + self._lookup(keys[row < 0], n).sum(axis=0)
        return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _count(sample: DataFrame, order: int) -> DataFrame:
    """(lang, n, gram, count) summed over the sample; each batch counts for itself first."""
    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], []]
        texts, langs = b.column(1).to_pylist(), b.column(0).to_pylist()
        for lang in sorted(set(langs)):
            own = [np.frombuffer(t, np.uint8) for t, x in zip(texts, langs) if x == lang and t]
            for n in range(1, order + 2):
                got, count = np.unique(np.concatenate([grams(t, n) for t in own] or [np.empty(0, np.uint32)]),
                                       return_counts=True)
                cols[0] += [lang] * len(got)
                cols[1].append(np.full(len(got), n))
                cols[2].append(got.astype(np.int64))
                cols[3].append(count)
        flat = [np.concatenate(c).astype(np.int64) for c in cols[1:]]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *map(pa.array, flat)],
                                          ["lang", "n", "gram", "count"])
    return map_batches(sample.select("lang", F.col("text").cast("binary")), fn,
                       "lang string, n long, gram long, count long").groupBy("lang", "n", "gram").agg(
        F.sum("count").alias("count"))


def _pieces(src: DataFrame) -> DataFrame:
    """(lang, text binary, step int): pieces of the texts, each with the step its hash falls into."""
    last = F.floor(F.greatest(F.octet_length("text") - 1, F.lit(0)) / PIECE).cast("int")
    cut = src.select("doc_id", "lang", F.col("text").cast("binary").alias("t"),
                     F.explode(F.sequence(F.lit(0), last)).alias("at"))
    cut = cut.select("doc_id", "lang", "at", F.substring("t", F.col("at") * PIECE + 1, F.lit(PIECE)).alias("text"))
    h = F.shiftrightunsigned(F.xxhash64("doc_id", "at", "text", F.lit(11)), 1).cast("double")
    return cut.select("lang", "text", F.floor(F.log2(h + 1) * STEPS).cast("int").alias("step"))


def _last_step(steps: list[tuple[int, int]], share: float) -> int:
    """The first step, in order, by which ``share`` bytes are taken; the last one if they never are."""
    total = 0
    for step, n in sorted(steps):
        total += n
        if total >= share:
            break
    return step


def fit(docs: DataFrame, allowed: Column | None = None, train_bytes: int = TRAIN_BYTES, order: int = ORDER) -> Model:
    """Model learned from text and non-null lang of the ``allowed`` rows of ``docs``."""
    configure(docs.sparkSession)
    src = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    src = src if allowed is None else src.where(allowed)
    parts = _pieces(src)
    size: dict[str, list[tuple[int, int]]] = {}
    for g, step, n in parts.groupBy("lang", "step").agg(F.sum(F.octet_length("text"))).collect():
        size.setdefault(g, []).append((step, n))
    if not size:
        return Model([], [], order)
    last = {g: _last_step(steps, train_bytes / len(size)) for g, steps in size.items()}
    upto = F.coalesce(*(F.when(F.col("lang") == g, F.lit(k)) for g, k in last.items()))
    counted = _count(written(parts.where(F.col("step") <= upto), "ppm-sample"), order)
    langs = sorted(size)
    at = {g: i for i, g in enumerate(langs)}
    table = counted.toPandas()
    rows = np.stack([table["lang"].map(at).to_numpy(np.int64), *(table[c].to_numpy(np.int64)
                                                                for c in ("n", "gram", "count"))], axis=1)
    return Model(langs, rows, order)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, lang_pred, score, bits_per_byte) of every document."""
    spark = configure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        texts = b.column(2).to_pylist()
        known = [i for i, t in enumerate(texts) if m.langs and has_letter(t)]
        lang, score, rate = [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in known]
        for i, t, bits in zip(known, raw, m.code_lengths(raw)):
            best = int(bits.argmin())
            lang[i], rate[i] = m.langs[best], bits[best] / len(t)
            score[i] = 1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score),
                                           pa.array(rate)],
                                          ["doc_id", "text_key", "lang_pred", "score", "bits_per_byte"])
    return map_batches(src, fn, f"doc_id {kind}, text_key long, lang_pred string, score double, "
                                "bits_per_byte double")
