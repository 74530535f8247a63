"""Collocations: phrases of two and three words that occur together more often than their parts suggest.

Words are counted first. The most frequent ones (``HEAD``, of at most ``HEAD_BYTES`` bytes) become ids by their rank
within their language and go to the tasks as a table of bounded size. Neighbouring ids are counted by direct address: an
id pair belongs to a tile of ``TILE`` x ``TILE`` cells, and a tile that gets many pairs of a batch is counted by one dense
``bincount`` into the task's array of that tile; the pairs of all other tiles are kept as sorted coordinates with counts
and merged. The frequent pairs are then ranked again in the same way, and (pair id, word id) tiles give the phrases of
three words. Pairs and phrases that hold a rarer or longer word, or (three words) a rarer pair, have no address: they are
counted by their coordinates or their text, so that nothing is left out at any size.

Tasks send only counts; Spark adds them by cell, so a frequent pair is never a hot group. What surely is not frequent
(two bit fields of fixed size: of frequent words, and of frequent pairs) is not sent.

Definitions: A-Z become lower case; pieces end at ``[.,;:!?]`` and line ends, words at spaces and tabs; counts hold per
language (null: ``und``), over all occurrences. Null and empty texts have no words. Repeated rows each count.
Without a phrase that is frequent enough there is no row. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import configure, written
from churnlab.operators.quantiles import before, in_ranges

LEAST, COVERED, SCALE, TOP = 10, 50, 1_000_000, 2000
#: Words with an id, their longest in bytes, and pairs with an id.
HEAD, HEAD_BYTES, PAIR_HEAD = 1 << 17, 64, 1 << 18
#: Side of a tile, pairs of a batch in a tile that make it dense, dense tiles and coordinates a task holds.
TILE, DENSE, TILES, HELD = 512, 4096, 24, 1_000_000
#: Words a task counts, and languages it keeps counters of, before it sends them.
REMEMBERED, LANGUAGES = 300_000, 16
#: Bytes of counts a task holds, over all its languages, before it sends them.
HELD_BYTES = 72 << 20
#: Words or pairs in a range that is numbered at once.
PER_RANGE = 20_000
#: Bits of the fields of frequent words and pairs (a prime).
FIELD = 16_777_213
_BITS = 17  # of a word id
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[^ \t.,;:!?\n-\r]+")
_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
_ENDS = {bytes([c]): -1 for c in b".,;:!?\n\x0b\x0c\r"}


def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, its texts of a batch of (lang, text) in one, a line end between them)."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
        if text:
            texts.setdefault("und" if lang is None else lang, []).append(text)
    for lang, some in texts.items():
        yield lang, b"\n".join(some).translate(_LOWER)


def _word_counts(docs: DataFrame) -> DataFrame:
    def send(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()),
                 pa.array(list(words.values()), pa.int64())], ["lang", "word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for b in batches:
            for lang, blob in _by_language(b):
                held.setdefault(lang, Counter()).update(_WORD.findall(blob))
            if sum(map(len, held.values())) > REMEMBERED:
                yield from send(held)
                held = {}
        yield from send(held)
    return docs.mapInArrow(run, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("f"))


def _ranked(rows: DataFrame, text: list[str], most: int, count: str = "f") -> DataFrame:
    """The ``most`` first rows by ``count`` (ties by ``text``), numbered by ``id`` from 0 within their language."""
    keys = [F.desc(count), *text]
    parts = in_ranges(rows, keys, PER_RANGE)
    base = before(["n"], parts.groupBy("part", "lang").agg(F.count(F.lit(1)).alias("n")), ["lang"]).select(
        F.col("part").alias("_p"), F.col("lang").alias("_l"), F.col("n_before").alias("_lang_before"))
    ahead = before(["n"], parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))).where(F.col("n_before") < most)
    near = parts.join(F.broadcast(ahead.select(F.col("part").alias("_q"), "n_before")), F.col("part") == F.col("_q")).join(
        base, (F.col("part") == F.col("_p")) & (F.col("lang") == F.col("_l")))
    at = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*keys))
    numbered = near.withColumns({"at": at("part") + F.col("n_before"), "id": at("part", "lang") - 1 + F.col("_lang_before")})
    return numbered.where(F.col("at") <= most).select(*rows.columns, F.col("id").cast("int").alias("id"))


def _field(numbers: DataFrame, bucket: Column) -> np.ndarray:
    """A bit field of ``FIELD`` bits in which the bit of each row's ``bucket`` is set; 2 MB at every size."""
    bit = F.expr("shiftleft(1L, cast(bucket % 64 as int))")
    rows = numbers.select(bucket.alias("bucket")).groupBy(F.expr("bucket div 64").alias("w")).agg(
        F.bit_or(bit).alias("bits")).collect()
    field = np.zeros(-(-FIELD // 64), np.int64)
    for r in rows:
        field[r["w"]] = r["bits"]
    return field


def _has(field: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = numbers % FIELD
    return (field[at >> 6] >> (at & 63)) & 1 == 1


class Tiles:
    """Counts of (row, column) cells of one language: dense arrays of busy tiles, sorted coordinates of the others."""

    def __init__(self):
        self.dense: dict[tuple[int, int], np.ndarray] = {}
        self.codes, self.counts, self.held = [], [], 0

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        if not len(x):
            return
        tile = (x // TILE << 32) | (y // TILE)
        kinds, inverse, sizes = np.unique(tile, return_inverse=True, return_counts=True)
        sparse = np.ones(len(kinds), bool)
        for k in np.nonzero(sizes >= DENSE)[0].tolist():
            key = (int(kinds[k]) >> 32, int(kinds[k]) & (1 << 32) - 1)
            if key not in self.dense and len(self.dense) == TILES:
                continue
            sparse[k] = False
            mine = inverse == k
            cells = np.bincount((x[mine] % TILE) * TILE + y[mine] % TILE, minlength=TILE * TILE)
            if key in self.dense:
                self.dense[key] += cells
            else:
                self.dense[key] = cells
        rest = sparse[inverse]
        codes, counts = np.unique((x[rest] << 32) | y[rest], return_counts=True)
        self.codes.append(codes)
        self.counts.append(counts)
        self.held += len(codes)
        if self.held > HELD:
            self._merge()

    def _merge(self) -> None:
        codes, inverse = np.unique(np.concatenate(self.codes), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(self.counts), len(codes)).astype(np.int64)
        self.codes, self.counts, self.held = [codes], [counts], len(codes)

    @property
    def bytes(self) -> int:
        return 8 * TILE * TILE * len(self.dense) + 16 * self.held

    def cells(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, columns, counts) of all cells that occur."""
        for (tx, ty), cells in self.dense.items():
            at = np.nonzero(cells)[0]
            yield tx * TILE + at // TILE, ty * TILE + at % TILE, cells[at]
        if self.codes:
            self._merge()
            yield self.codes[0] >> 32, self.codes[0] & (1 << 32) - 1, self.counts[0]


def _ids(blob: bytes, ids: dict[bytes, int], field: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Tokens of a text and their ids: -1 ends a piece or is a rare word, -2 a word without an id."""
    tokens = _TOKEN.findall(blob)
    out = np.array([ids.get(t, -2) for t in tokens], np.int64)
    for at in np.nonzero(out == -2)[0].tolist():
        n = zlib.crc32(tokens[at]) % FIELD
        if not int(field[n >> 6]) >> (n & 63) & 1:
            out[at] = -1
    return tokens, out


#: A phrase is a code (two or three word ids, or from ``_PAIRED`` on a pair id and a word id), else a text.
_PHRASE, _PAIRED, _LOW = "lang string, code long, text string, c long", 1 << 60, (1 << _BITS) - 1


def _rows(lang: str, count, codes=None, texts=None) -> Iterator[pa.RecordBatch]:
    """Batches of ``_PHRASE`` rows."""
    for a in range(0, len(count), 100_000):
        z = min(a + 100_000, len(count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (z - a)), pa.nulls(z - a, pa.int64()) if codes is None else pa.array(codes[a:z]),
             pa.nulls(z - a, pa.string()) if texts is None else pa.array(texts[a:z], pa.binary()).cast(pa.string()),
             pa.array(np.asarray(count[a:z], np.int64))], ["lang", "code", "text", "c"])


class PhraseCounter:
    """Counts the phrases of ``size`` words of one language in a task."""

    def __init__(self, lang: str, size: int, words: dict, field: np.ndarray, pairs: tuple | None, pair_field):
        self.lang, self.size, self.field, self.pair_field = lang, size, field, pair_field
        self.ids = {**words.get(lang, {}), **_ENDS}
        none = np.empty(0, np.int64)
        self.codes, self.pair_ids = (pairs or {}).get(lang, (none, none))
        self._empty()

    def _empty(self) -> None:
        self.tiles, self.coords, self.counts, self.held, self.texts = Tiles(), [], [], 0, Counter()

    def add(self, blob: bytes) -> None:
        tokens, s = _ids(blob, self.ids, self.field)
        k = self.size
        if len(s) < k:
            return
        cols = [s[i:len(s) - k + 1 + i] for i in range(k)]
        least = np.minimum.reduce(cols)
        some = ~np.logical_or.reduce([c == -1 for c in cols])
        ok = least >= 0
        if k == 3:  # both pairs must be frequent, as far as they have ids
            for a, b in ((0, 1), (1, 2)):
                known = (cols[a] >= 0) & (cols[b] >= 0)
                may = ~known | _has(self.pair_field, np.where(known, cols[a] << _BITS | cols[b], 0))
                some, ok = some & may, ok & may
        for at in np.nonzero(some & (least < 0))[0].tolist():
            self.texts[tuple(tokens[at:at + k])] += 1
        cols = [c[ok] for c in cols]
        if k == 2:
            return self.tiles.add(*cols)
        code = cols[0] << _BITS | cols[1]
        at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
        found = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        self.tiles.add(self.pair_ids[at[found]], cols[2][found])
        codes, counts = np.unique((code << _BITS | cols[2])[~found], return_counts=True)
        self.coords.append(codes)
        self.counts.append(counts)
        self.held += len(codes)

    @property
    def bytes(self) -> int:
        return self.tiles.bytes + 16 * self.held + 300 * len(self.texts)

    def send(self) -> Iterator[pa.RecordBatch]:
        for x, y, c in self.tiles.cells():
            yield from _rows(self.lang, c, (x << _BITS | y) + (_PAIRED if self.size == 3 else 0))
        if self.held:
            codes, inverse = np.unique(np.concatenate(self.coords), return_inverse=True)
            yield from _rows(self.lang, np.bincount(inverse, np.concatenate(self.counts)), codes)
        yield from _rows(self.lang, list(self.texts.values()), texts=[b" ".join(t) for t in self.texts])
        self._empty()


def _phrases(docs: DataFrame, make: Callable[[str], PhraseCounter], least: int) -> DataFrame:
    """(lang, code, text, a): the phrases that occur ``least`` times, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, PhraseCounter] = {}
        for b in batches:
            for lang, blob in _by_language(b):
                if lang not in held:
                    held[lang] = make(lang)
                held[lang].add(blob)
            if len(held) > LANGUAGES or sum(c.bytes for c in held.values()) > HELD_BYTES:
                for counter in held.values():
                    yield from counter.send()
                if len(held) > LANGUAGES:
                    held = {}
        for counter in held.values():
            yield from counter.send()
    return docs.mapInArrow(run, _PHRASE).groupBy("lang", "code", "text").agg(F.sum("c").alias("a")).where(
        F.col("a") >= least)


def _low(code: Column, place: int) -> Column:
    """The word id at a place of a code, counted from its end."""
    return F.shiftright(code, place * _BITS).bitwiseAND(F.lit(_LOW)).cast("int")


def _worded(rows: DataFrame, head: DataFrame, ids: list[str]) -> DataFrame:
    """Adds w1, w2, ...: from the text, or the word of the id (the table of ids has a bounded size)."""
    for n, i in enumerate(ids, 1):
        h = F.broadcast(head.select(F.col("lang").alias("_l"), F.col("id").alias("_i"), F.col("word").alias("_w")))
        rows = rows.join(h, (F.col("lang") == F.col("_l")) & (F.col(i) == F.col("_i")), "left").withColumn(
            f"w{n}", F.coalesce(F.split("text", " ")[n - 1], F.col("_w"))).drop("_l", "_i", "_w")
    return rows


def _counted(rows: DataFrame, counts: DataFrame, on: list[str], by: list[str], name: str) -> DataFrame:
    """Joins the count ``f`` of the words or pairs in ``on`` (called ``by`` in ``counts``) as ``name``."""
    other = counts.select(F.col("lang").alias("_l"), *[F.col(c).alias(f"_{c}") for c in by], F.col("f").alias(name))
    cond = F.col("lang") == F.col("_l")
    for a, b in zip(on, by):
        cond = cond & (F.col(a) == F.col(f"_{b}"))
    return rows.join(other, cond).drop("_l", *[f"_{c}" for c in by])


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, head: int = HEAD,
                 pair_head: int = PAIR_HEAD) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score, kept) of every phrase that occurs ``least`` times.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of the language; ``kept`` is
    false where a longer phrase covers ``covered`` percent of its occurrences. ``head`` and ``pair_head`` bound the tables
    of ids (at most 2^17 words) and change no result.
    """
    spark = configure(docs.sparkSession)
    docs = docs.select("lang", "text")
    words = written(_word_counts(docs), "collocation-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= least)
    first = written(_ranked(often.where(F.octet_length("word") <= HEAD_BYTES), ["lang", "word"], min(head, HEAD)),
                    "collocation-ids")
    ids: dict[str, dict[bytes, int]] = {}
    for r in first.collect():  # at most HEAD words of HEAD_BYTES bytes
        ids.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
    field = _field(often, F.crc32(F.col("word").cast("binary")) % FIELD)
    shared = spark.sparkContext.broadcast((ids, field))
    code = F.col("code")
    two = _phrases(docs, lambda lang: PhraseCounter(lang, 2, *shared.value, None, None), least).withColumns(
        {"x": _low(code, 1), "y": _low(code, 0)})
    two = written(_worded(two, first, ["x", "y"]).select("lang", "code", "w1", "w2", F.col("a").alias("f")),
                  "collocation-pairs")

    known = two.where(code.isNotNull())
    again = written(_ranked(known, ["lang", "w1", "w2"], pair_head), "collocation-pair-ids")
    pairs: dict[str, tuple] = {}
    for r in again.select("lang", "code", "id").collect():  # at most PAIR_HEAD pairs
        pairs.setdefault(r["lang"], ([], []))[0].append(r["code"])
        pairs[r["lang"]][1].append(r["id"])
    for lang, (c, i) in pairs.items():
        order = np.argsort(np.array(c, np.int64))
        pairs[lang] = (np.array(c, np.int64)[order], np.array(i, np.int64)[order])
    more = spark.sparkContext.broadcast((pairs, _field(known, code % FIELD)))
    three = _phrases(docs, lambda lang: PhraseCounter(lang, 3, *shared.value, *more.value), least)
    ranks = F.broadcast(again.select(F.col("lang").alias("_l"), F.col("id").alias("_i"), F.col("code").alias("_c")))
    paired = code >= _PAIRED
    three = three.withColumn("p", F.when(paired, F.shiftright(code - _PAIRED, _BITS).cast("int"))).join(
        ranks, (F.col("lang") == F.col("_l")) & (F.col("p") == F.col("_i")), "left")
    three = three.withColumn("code", F.when(paired, F.shiftleft("_c", _BITS).bitwiseOR(code.bitwiseAND(F.lit(_LOW)))).otherwise(
        code)).drop("_l", "_i", "_c")
    three = three.withColumns({"x": _low(code, 2), "y": _low(code, 1), "z": _low(code, 0)})
    three = written(_worded(three, first, ["x", "y", "z"]).select("lang", "w1", "w2", "w3", "a"), "collocation-triples")

    # Exact scores: counts below 10^14 keep every product within 38 digits.
    score = lambda l, r: F.expr(
        f"(cast(a as decimal(14,0)) * cast(a as decimal(14,0)) * cast({SCALE} as decimal(7,0)))"
        f" div (cast({l} as decimal(14,0)) * cast({r} as decimal(14,0)))")
    long = _counted(three, often, ["w1"], ["word"], "f1")
    long = _counted(long, often, ["w3"], ["word"], "f3")
    long = _counted(long, two, ["w1", "w2"], ["w1", "w2"], "f12")
    long = _counted(long, two, ["w2", "w3"], ["w1", "w2"], "f23")
    long = long.withColumns({"s1": score("f1", "f23"), "s2": score("f12", "f3")})
    at_first = F.col("s1") <= F.col("s2")
    long = long.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.lit(3).alias("words"), "a",
                       F.when(at_first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                       F.when(at_first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                       F.least("s1", "s2").alias("score"), F.lit(True).alias("kept"))
    inside = three.select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(
        F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("i")).groupBy("lang", "i.w1", "i.w2").agg(
        F.max("a").alias("cover")).select(F.col("lang").alias("_l"), F.col("w1").alias("_1"), F.col("w2").alias("_2"), "cover")
    short = two.join(inside, (F.col("lang") == F.col("_l")) & (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")),
                     "left")
    short = short.select("lang", "w1", "w2", F.col("f").alias("a"),
                         (100 * F.coalesce("cover", F.lit(0)) < covered * F.col("f")).alias("kept"))
    short = _counted(_counted(short, often, ["w1"], ["word"], "l"), often, ["w2"], ["word"], "r")
    short = short.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.lit(2).alias("words"), "a", "l", "r",
                         score("l", "r").alias("score"), "kept")
    return short.unionByName(long).join(totals, "lang").select(
        "lang", "phrase", "words", "a", "l", "r", "n", "score", "kept")


def best(phrases: DataFrame, top: int = TOP, salts: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first kept phrases, found by ``salts`` groups first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    some = phrases.where("kept").withColumn("salt", salt).withColumn("rank", place("lang", "salt")).where(
        F.col("rank") <= top)
    return some.withColumn("rank", place("lang")).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
