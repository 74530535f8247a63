"""Benchmark decontamination by spaced-seed hashing.

Texts become token hashes (lower-case runs of word characters). A fixed mask marks which positions of a short
window count; the others are ignored, so a hit survives substitutions there. The hashes of every masked window of
the benchmark are joined with those of every window of the documents, and each hit is verified along its diagonal:
an item overlaps a document if some aligned run of ``WINDOW`` tokens agrees in at least ``MATCHES`` of them. The four
masks are chosen so that every such run holds a hit whatever the places of the substitutions (tests/llm checks all of
them): the result is exact, not a heuristic.

The benchmark is the stated query set. It is taken in blocks of bounded size, each sent to the executors once; one
pass over the documents serves a block, and nothing is shuffled. Blocks hold different items, so their results add up.

Hits are taken in slices of bounded number, a text at a time where a text has many (a repeated word meets every place
of an item that repeats it), reduced to distinct diagonals and then verified. Once an item is found whole in a text,
hits that cannot give an earlier place are dropped unexpanded; so memory is bounded for any texts.

Defined results: items of fewer than ``WINDOW`` tokens must occur whole and unchanged (those under ``SPAN`` are found by
a mask of their own length); null texts and items without a token take no part. Scripts without spaces count a token a
character. Repeated benchmark rows count once; repeated documents each give their rows. Ties between
diagonals go to the earliest document position. Empty tables give an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from churnlab.llm.common import configure, filter_batches, map_batches, text_key, written

#: Six selected positions each; together they hit every 15-token run with at most 3 substitutions.
MASKS = ("1011111", "11100111", "1100010111", "101010010011")
WINDOW, MATCHES = 15, 12
SPAN = min(map(len, MASKS))
#: Benchmark text bytes in a block: about 1.2 million seeds, 25 MB on an executor.
BLOCK_BYTES = 2 << 20
_FILTER_BITS = 22
#: Texts are hashed in runs of about so many bytes, and their tokens in slices of so many.
_RUN_BYTES, _RUN_TOKENS = 1 << 20, 1 << 17
#: Hits expanded at once, and cells (diagonal x item token) compared at once.
HITS, CELLS = 1 << 19, 1 << 20
_FACTOR = 0xD6E8FEB86659FD93
_SIGN = re.compile(r"[^\w\x00-\x7f]")
#: Blocks of scripts written without spaces (Thai to Lao, Myanmar, Khmer, and CJK with kana).
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_IN_WORD = np.array([chr(b).isalnum() or b == 95 or b > 127 for b in range(256)])
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 for i in range(64)], np.uint64)


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, each text's first and number, and for each token its text's end.

    A token's hash is a polynomial in its UTF-8 bytes modulo 2^64, read off running sums over a whole run of texts.
    """
    raw = [_plain(t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    found, k = [], 0
    while k < len(raw):
        first, size = k, 0
        while k < len(raw) and (k == first or size + len(raw[k]) < _RUN_BYTES):
            size, k = size + len(raw[k]) + 1, k + 1
        found.append(_hash_run(raw[first:k]))
    flat = np.concatenate([h for h, _ in found]) if found else np.empty(0, np.uint64)
    lens = np.concatenate([n for _, n in found]) if found else np.empty(0, np.int64)
    ends = np.cumsum(lens)
    return flat, ends - lens, lens, np.repeat(ends, lens)


def _plain(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else _SIGN.sub(" ", _UNSPACED.sub(r" \1 ", text))


def _hash_run(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = _IN_WORD[data]
    edge = np.diff(np.r_[False, inside].view(np.int8))
    first, last = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    ends = np.cumsum([len(r) + 1 for r in raw])
    lens = np.diff(np.r_[0, np.searchsorted(first, ends)])
    out = np.empty(len(first), np.uint64)
    for k in range(0, len(first), _RUN_TOKENS):  # a slice at a time: a text may be of any length
        a, z = first[k:k + _RUN_TOKENS], last[k:k + _RUN_TOKENS]
        at, n = int(a[0]), int(z[-1] - a[0])
        sums = np.concatenate((np.zeros(1, np.uint64),
                               np.cumsum(data[at:at + n] * _powers(_FACTOR, n), dtype=np.uint64)))
        h = (sums[z - at] - sums[a - at]) * _powers(pow(_FACTOR, -1, 2**64), n)[a - at]
        h ^= h >> np.uint64(29)
        out[k:k + len(a)] = h * _ODD[50] + (z - a).astype(np.uint64) * _ODD[51]
    return out, lens


def seeds(tokens: np.ndarray, ends: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the masked window at every position, and whether the window stays within its text.

    ``tokens`` are those of several texts in a row; ``ends`` gives for each position the end of its own text.
    """
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    h = np.full(n, number, np.uint64)
    for j, at in enumerate(i for i, c in enumerate(mask) if c == "1"):
        h += tokens[at:at + n] * _ODD[j + 1]
    h ^= h >> np.uint64(31)
    h *= _ODD[40]
    return h, np.arange(n) + len(mask) <= ends[:n]


class Index:
    """Seeds of one block of items, grouped by hash, with item and position, and a bit filter before them."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        self.tokens, self.starts, self.lens, ends = token_hashes([t for _, t in items])
        item_at = np.repeat(np.arange(len(items)), self.lens)
        h, at, self.masks = [], [], []
        for k, mask in enumerate([*MASKS, *("1" * n for n in range(1, SPAN))]):
            x, ok = seeds(self.tokens, ends, mask, k)
            own = self.lens[item_at[:len(ok)]]
            ok &= own >= SPAN if k < len(MASKS) else own == len(mask)
            if ok.any():
                self.masks.append((k, mask))
                h.append(x[ok])
                at.append(np.nonzero(ok)[0])
        h, at = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((h, np.uint64), (at, np.int64)))
        order = np.argsort(h, kind="stable")
        at = at[order]
        self.hash, self.begin, self.size = np.unique(h[order], return_index=True, return_counts=True)
        self.item = item_at[at]
        self.pos = at - self.starts[self.item]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hash >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def _hits(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, hash group) of every masked window that an item has too, in the order of tokens."""
        at, group = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, mask in self.masks:
            h, ok = seeds(flat, ends, mask, k)
            ok &= self.filter[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
            own = np.nonzero(ok)[0]
            g = np.minimum(np.searchsorted(self.hash, h[own]), len(self.hash) - 1)
            same = self.hash[g] == h[own]
            at.append(own[same])
            group.append(g[same])
        at, group = np.concatenate(at), np.concatenate(group)
        order = np.argsort(at, kind="stable")
        return at[order], group[order]

    def _seeds_of(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each seed of each group: the group's place, and the seed."""
        size = self.size[group]
        ends = np.cumsum(size)
        place = np.repeat(np.arange(len(group)), size)
        return place, np.arange(len(place)) + np.repeat(self.begin[group] - ends + size, size)

    def overlaps(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first token in the text, in the item, tokens compared, tokens equal): the best of each pair."""
        flat, starts, lens, ends = token_hashes(texts)
        if not len(flat) or not len(self.hash):
            return []
        at, group = self._hits(flat, ends)
        text = np.searchsorted(starts + lens, at, "right")
        found: dict[tuple[int, int], tuple] = {}
        if self.size[group].sum() <= HITS:
            self._verify(flat, starts, lens, text, at, group, found)
        else:
            edges = np.r_[0, np.nonzero(np.diff(text))[0] + 1, len(text)]
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
                self._one_text(flat, starts, lens, int(text[a]), at[a:z], group[a:z], found)
        return [(t, i, -x[1], -x[1] - x[2], x[3], x[0]) for (t, i), x in sorted(found.items())]

    def _one_text(self, flat, starts, lens, text: int, at: np.ndarray, group: np.ndarray, found: dict) -> None:
        """Slices of the hits of one text; an item found whole at token f only needs diagonals up to f."""
        whole = np.full(len(self.ids), np.iinfo(np.int64).max // 2)
        while len(at):
            total = np.cumsum(self.size[group])
            n = max(1, int(np.searchsorted(total, HITS, "right")))
            known = self._verify(flat, starts, lens, np.full(n, text), at[:n], group[:n], found)
            at, group = at[n:], group[n:]
            done = [i for _, i in known if whole[i] > -found[text, i][1] and found[text, i][0] == found[text, i][3]]
            if done and len(at):
                whole[done] = [-found[text, i][1] for i in done]
                last = np.maximum.reduceat(whole[self.item] + self.pos, self.begin)  # of each group
                live = at - starts[text] <= last[group]
                at, group = at[live], group[live]

    def _verify(self, flat, starts, lens, text, at, group, found: dict) -> list[tuple[int, int]]:
        """Verifies the distinct diagonals of some hits, keeps the best of each (text, item) and returns those pairs."""
        place, seed = self._seeds_of(group)
        text, item = text[place], self.item[seed]
        shift = at[place] - starts[text] - self.pos[seed]
        order = np.lexsort((shift, item, text))
        text, item, shift = text[order], item[order], shift[order]
        new = np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])][:len(text)]
        fresh = new | np.r_[True, shift[1:] != shift[:-1]][:len(text)]
        text, item, shift, new = text[fresh], item[fresh], shift[fresh], new[fresh]
        edges = np.r_[np.nonzero(new)[0], len(text)].tolist()
        pairs = []
        for a, z in zip(edges[:-1], edges[1:]):
            key = int(text[a]), int(item[a])
            x = verify(flat[starts[key[0]]:starts[key[0]] + lens[key[0]]],
                       self.tokens[self.starts[key[1]]:self.starts[key[1]] + self.lens[key[1]]], shift[a:z])
            if x and x > found.get(key, (0,)):
                found[key] = x
                pairs.append(key)
        return pairs


def verify(a: np.ndarray, b: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
    """Best aligned run where ``a[j + shift]`` meets ``b[j]`` over ascending ``shifts``, None if too few agree.

    Returns (equal, -first in a, shift, run).
    """
    run = min(WINDOW, len(b))
    need, best = MATCHES if run == WINDOW else run, None
    low, high = np.maximum(0, -shifts), np.minimum(len(b), len(a) - shifts)
    fits = high - low >= run
    low, high, shifts = low[fits], high[fits], shifts[fits]
    k = 0
    while k < len(shifts):
        n = max(1, CELLS // len(b))
        s, lo, hi = shifts[k:k + n], low[k:k + n], high[k:k + n]
        k += n
        j = np.arange(int(lo.min()), int(hi.max()))
        at = s[:, None] + j
        equal = (a[np.clip(at, 0, len(a) - 1)] == b[j]) & (j >= lo[:, None]) & (j < hi[:, None])
        total = np.zeros((len(s), len(j) + 1), np.int32)
        np.cumsum(equal, axis=1, out=total[:, 1:])
        sums = total[:, run:] - total[:, :-run]
        first = j[:sums.shape[1]]
        sums = np.where((first >= lo[:, None]) & (first + run <= hi[:, None]), sums, -1)
        where = sums.argmax(axis=1)
        most = sums[np.arange(len(s)), where]
        start = s + first[where]
        i = np.lexsort((-s, start, -most))[0]
        x = (int(most[i]), -int(start[i]), int(s[i]), run)
        if x[0] >= need and (best is None or x > best):
            best = x
        if best and best[0] == run and k < len(shifts) and shifts[k] > -best[1]:
            break  # no later diagonal begins as early
    return best


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The index of each block of items, sent to the executors, one after the other."""
    spark = benchmark.sparkSession
    items = written(benchmark.select("item_id", "text").where("text is not null").distinct(), "decontam-items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield spark.sparkContext.broadcast(Index(sorted(((r[0], r[1]) for r in own), key=str)))


def overlaps(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each (document row, item) that overlap.

    Columns: doc_id, text_key, item_id, doc_token, item_token, run, equal (tokens; starts of the best run).
    """
    configure(docs.sparkSession)
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = [d.schema[c].dataType for d, c in ((src, "doc_id"), (benchmark, "item_id"))]
    item_type = to_arrow_type(kind[1])
    schema = (f"doc_id {kind[0].simpleString()}, text_key long, item_id {kind[1].simpleString()}, doc_token long, "
              "item_token long, run int, equal int")
    out = None
    for index in _blocks(benchmark, block_bytes):
        def fn(b: pa.RecordBatch, index=index) -> pa.RecordBatch:
            rows = index.value.overlaps(b.column(2).to_pylist())
            t = pa.array([r[0] for r in rows], pa.int64())
            ids = pa.array([index.value.ids[r[1]] for r in rows], item_type)
            more = [pa.array([r[k] for r in rows], pa.int64() if k < 4 else pa.int32()) for k in range(2, 6)]
            return pa.RecordBatch.from_arrays([b.column(0).take(t), b.column(1).take(t), ids, *more],
                                              ["doc_id", "text_key", "item_id", "doc_token", "item_token", "run",
                                               "equal"])
        part = map_batches(src, fn, schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents that overlap no benchmark item, all columns kept."""
    configure(docs.sparkSession)
    for index in _blocks(benchmark, block_bytes):
        def keep(b: pa.RecordBatch, index=index) -> list[bool]:
            hit = {r[0] for r in index.value.overlaps(b.column("text").to_pylist())}
            return [i not in hit for i in range(b.num_rows)]
        docs = filter_batches(docs, keep)
    return docs
