"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is encoded as sentencepiece does: spaces become the marker U+2581 and one marker goes in front; of all ways to
cut the result into pieces the one with the greatest sum of piece scores is taken; a character that no piece covers
costs the least score less 10 and is written as its UTF-8 bytes (byte fallback). Decoding joins pieces and bytes,
turns markers into spaces and drops the one in front, which gives back every text exactly; only a marker in the text
itself comes back as a space, and ``decodes`` is false for such a text.

No piece has a marker after another character, so texts split before each run of markers without changing the best
cut. A batch of texts is split into such units, the distinct units are encoded together (Viterbi steps over all units
at once, longest first), and the ids are put back in order. Long units take the same steps one by one.

The vocabulary is a sentencepiece model file; its path is a parameter. The file at hand was made by merges, so its
scores are merge ranks and no log scores. Nothing is trained: log scores follow from the order of the file's scores by
Zipf's law, the piece of rank r (from 1) having the probability 1 / (r H) with H the harmonic sum, so that the
probabilities add up to one. For the file of a unigram model take its own scores (``scores="file"``). Only the
vocabulary is sent to the executors.

Defined results: a null text has null ids, an empty one none. Ties go to the cut whose last piece starts earliest,
then likewise before it. Repeated rows get equal results; other columns stay.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from churnlab.llm.common import Numbers, configure
from churnlab.llm.double_array import DoubleArray

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What an unknown character costs below the least score; units over so many bytes are encoded one by one.
UNKNOWN_PENALTY, LONG_UNIT = 10.0, 200
#: Cells (unit x byte) of the tables of one Viterbi run.
CELLS = 1 << 20
#: Units an encoder remembers, and their bytes, before it starts anew; places of a long unit looked up at once.
REMEMBERED, REMEMBERED_BYTES, SLICE = 300_000, 32 << 20, 1 << 16
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces, scores, byte pieces and the trie of one sentencepiece model."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """``kinds``: "piece", "byte" (pieces like <0x0A>), or "other" (control and unknown, never in a cut)."""
        self.pieces = pieces
        own = [i for i, k in enumerate(kinds) if k == "piece"]
        self.byte_id = np.full(256, -1, np.int32)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[int(pieces[i][3:5], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        if any(MARK in pieces[i].lstrip(MARK) for i in own):
            raise ValueError("a piece has a space marker after another character")
        self.trie = DoubleArray([pieces[i].encode() for i in own])
        self.ids, self.scores = np.array(own, np.int32), np.array([scores[i] for i in own], np.float64)
        self.unknown = float(self.scores.min()) - UNKNOWN_PENALTY
        self.deepest = max(len(pieces[i].encode()) for i in own)
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "other" else
                    p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds)]


def zipf(scores: np.ndarray) -> np.ndarray:
    """Log probabilities by Zipf's law over the order of ``scores``, greatest first (ties: as they come)."""
    rank = np.empty(len(scores))
    rank[np.argsort(-scores, kind="stable")] = np.arange(1, len(scores) + 1)
    return -np.log(rank) - np.log((1 / np.arange(1, len(scores) + 1)).sum())


def load(path: str = MODEL, scores: str = "zipf") -> Vocabulary:
    """The vocabulary of a model file with log scores by ``zipf`` or those of the ``file``."""
    import sentencepiece
    if scores not in ("zipf", "file"):
        raise ValueError("scores are zipf or file")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(m.get_piece_size())
    kind = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "piece"
            for i in n]
    score = np.array([m.get_score(i) for i in n])
    if scores == "zipf":
        own = [i for i in n if kind[i] == "piece"]
        score[own] = zipf(score[own])
    return Vocabulary([m.id_to_piece(i) for i in n], score.tolist(), kind)


def _char_length(first: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that begins with each byte."""
    return 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)


def encode_units(voc: Vocabulary, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of all units, and where each unit's ids begin and how many they are.

    Units of about the same length go together, so many that the tables of a group keep to ``CELLS`` cells.
    """
    sizes, begin = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
    flat, made, k = [], 0, 0
    order = sorted(range(len(units)), key=lambda i: -len(units[i]))
    while k < len(order) and len(units[order[k]]) > LONG_UNIT:
        flat.append(ids := encode_long(voc, units[order[k]]))
        begin[order[k]], sizes[order[k]] = made, len(ids)
        made, k = made + len(ids), k + 1
    while k < len(order):
        group = order[k:k + max(1, CELLS // max(1, len(units[order[k]])))]
        ids, own = _viterbi(voc, [units[i] for i in group])
        begin[group], sizes[group] = made + np.cumsum(own) - own, own
        flat.append(ids)
        made, k = made + len(ids), k + len(group)
    return np.concatenate(flat) if flat else np.empty(0, np.int32), begin, sizes


def _viterbi(voc: Vocabulary, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of units in a row, longest unit first, and how many each has."""
    own = np.array([len(u) for u in units], np.int64)
    n, width = len(units), int(own.max(initial=0))
    text = np.zeros((n, width + 4), np.uint8)
    flat = np.frombuffer(b"".join(units), np.uint8)
    text[np.repeat(np.arange(n), own), np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own)] = flat
    best = np.full((n, width + 4), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((n, width + 4), np.int32), np.full((n, width + 4), -1, np.int32)
    starts = (text & 0xC0) != 0x80
    for s in range(width):
        live = np.nonzero(starts[:, s] & (s < own))[0]
        base = best[live, s]
        # an unknown character first: a piece as long as it replaces it only if it is no worse
        to = np.minimum(s + _char_length(text[live, s]), own[live])
        cost = base + voc.unknown
        win = cost > best[live, to]
        best[live[win], to[win]], back[live[win], to[win]], piece[live[win], to[win]] = cost[win], s, -1
        state, at = np.zeros(len(live), np.int64), live
        for depth in range(s, min(width, s + voc.deepest)):
            state = voc.trie.step(state, text[at, depth])
            on = (state >= 0) & (depth < own[at])
            if not on.any():
                break
            state, at, base = state[on], at[on], base[on]
            number = voc.trie.value[state]
            got = np.nonzero(number >= 0)[0]
            row, cost = at[got], base[got] + voc.scores[number[got]]
            same_start = (back[row, depth + 1] == s) & (piece[row, depth + 1] == -1)
            win = (cost > best[row, depth + 1]) | ((cost == best[row, depth + 1]) & same_start)
            row = row[win]
            best[row, depth + 1], back[row, depth + 1], piece[row, depth + 1] = cost[win], s, voc.ids[number[got][win]]
    return _trace(voc, text, own, back, piece)


def _trace(voc, text, own, back, piece) -> tuple[np.ndarray, np.ndarray]:
    """Walk all units back from their ends; unknown characters become byte pieces."""
    n = len(own)
    rows, ids, at_list = [], [], []
    live, at = np.arange(n), own.copy()
    live, at = live[own > 0], at[own > 0]
    while len(live):
        start, p = back[live, at].astype(np.int64), piece[live, at]
        known = p >= 0
        rows.append(live[known])
        ids.append(p[known])
        at_list.append(start[known])
        if not known.all():
            r, a, b = live[~known], start[~known], at[~known]
            size = b - a
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
            r = np.repeat(r, size)
            rows.append(r)
            ids.append(voc.byte_id[text[r, k]])
            at_list.append(k)
        live, at = live[start > 0], start[start > 0]
    if not rows:
        return np.empty(0, np.int32), np.zeros(n, np.int64)
    rows, ids, where = (np.concatenate(x) for x in (rows, ids, at_list))
    by = np.lexsort((where, rows))
    return ids[by].astype(np.int32), np.bincount(rows, minlength=n)


def _pieces_at(voc: Vocabulary, data: np.ndarray, first: np.ndarray):
    """All pieces that begin at the places ``first``: (how many each has, ends, piece numbers), by place and length."""
    place, end, number = [], [], []
    at, state, own = first, np.zeros(len(first), np.int64), np.arange(len(first))
    while len(at):
        state = voc.trie.step(state, data[at])
        on = (state >= 0)
        state, at, own = state[on], at[on] + 1, own[on]
        got = voc.trie.value[state] >= 0
        place.append(own[got])
        end.append(at[got])
        number.append(voc.trie.value[state[got]])
        inside = at < len(data)
        state, at, own = state[inside], at[inside], own[inside]
    place, end, number = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (place, end, number))
    order = np.lexsort((end, place))
    return np.bincount(place, minlength=len(first)), end[order], number[order]


def encode_long(voc: Vocabulary, unit: bytes) -> np.ndarray:
    """The same cut for one unit of any length, place by place; the pieces come from the trie in slices."""
    n, data = len(unit), np.frombuffer(unit, np.uint8)
    best, back, piece = (array(t, [v]) * (n + 1) for t, v in (("d", float("-inf")), ("i", 0), ("i", -1)))
    best[0], unknown = 0.0, voc.unknown
    for a in range(0, n, SLICE):
        first = a + np.nonzero((data[a:a + SLICE] & 0xC0) != 0x80)[0]
        many, end, number = _pieces_at(voc, data, first)
        end, cost_of, id_of = end.tolist(), voc.scores[number].tolist(), voc.ids[number].tolist()
        k = 0
        for s, to, more in zip(first.tolist(), np.minimum(n, first + _char_length(data[first])).tolist(), many.tolist()):
            here = best[s]
            if here + unknown > best[to]:
                best[to], back[to], piece[to] = here + unknown, s, -1
            for k in range(k, k + more):
                e, cost = end[k], here + cost_of[k]
                if cost > best[e] or cost == best[e] and back[e] == s and piece[e] == -1:
                    best[e], back[e], piece[e] = cost, s, id_of[k]
            k += more > 0
    out, at = array("i"), n
    while at:  # from the end; the ids are turned round once
        s = back[at]
        if piece[at] >= 0:
            out.append(piece[at])
        else:
            out.extend(voc.byte_id[data[s:at][::-1]].tolist())
        at = s
    return np.array(out, np.int32)[::-1]


def units_of(text: str) -> list[str]:
    """The units of a text, each without the marker it begins with."""
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [u[1:] for u in _UNIT.findall(MARK + text.replace(" ", MARK))]


class Encoder:
    """Encodes batches of texts and remembers the units met, up to ``REMEMBERED`` of them."""

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self._forget()

    def _forget(self) -> None:
        self.number, self.flat = Numbers(), np.empty(0, np.int32)
        self.begin, self.sizes, self.bytes = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if len(self.number) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self._forget()
        use, per_text, number = [], [], self.number
        for t in texts:
            found = units_of(t) if t else []
            per_text.append(len(found))
            use += [number[u] for u in found]
        fresh = [(MARK + u).encode("utf-8", "surrogatepass") for u in number.fresh]
        number.fresh = []
        self.bytes += sum(map(len, fresh))
        flat, begin, sizes = encode_units(self.voc, fresh)
        self.begin = np.concatenate((self.begin, begin + len(self.flat)))
        self.sizes, self.flat = np.concatenate((self.sizes, sizes)), np.concatenate((self.flat, flat))
        use = np.array(use, np.int64)
        size = self.sizes[use]
        at = np.arange(size.sum()) + np.repeat(self.begin[use] - np.cumsum(size) + size, size)
        of_text = np.repeat(np.arange(len(texts)), per_text)
        return self.flat[at], np.bincount(of_text, weights=size, minlength=len(texts)).astype(np.int64)


def encode(voc: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return Encoder(voc).encode(texts)


def decode(voc: Vocabulary, ids) -> str:
    """Text of a row of ids; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join([voc.raw[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``decodes`` (whether decoding gives back the text) added.

    A column of one of these names is replaced.
    """
    spark = configure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(path))
    rest = [c for c in docs.columns if c not in ("ids", "decodes")]
    src = docs.select(*rest)

    def run(batches):
        voc, encoder = shared.value, Encoder(shared.value)
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column("text").to_pylist()
            ids, sizes = encoder.encode(texts)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            back = [None if t is None else decode(voc, ids[a:z].tolist()) == t
                    for t, a, z in zip(texts, ends, ends[1:])]
            null = pa.array([t is None for t in texts])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=null)
            yield pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(back, pa.bool_())],
                                             [*b.schema.names, "ids", "decodes"])
    schema = StructType([*src.schema, StructField("ids", ArrayType(IntegerType())), StructField("decodes", BooleanType())])
    return src.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded`` text of its ``ids`` added; a column of this name is replaced."""
    spark = configure(encoded.sparkSession)
    shared = spark.sparkContext.broadcast(load(path))
    src = encoded.select(*(c for c in encoded.columns if c != "decoded"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                out = [None if x is None else decode(shared.value, x) for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())],
                                                 [*b.schema.names, "decoded"])
    return src.mapInArrow(run, StructType([*src.schema, StructField("decoded", StringType())]))


