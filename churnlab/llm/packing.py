"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Examples are cut into pieces that fit an empty sequence; pieces that fill one go out at once, the others wait in a
bounded pool of the task, counted by (tokens, loss tokens). An open sequence takes, again and again, the waiting piece
whose size vector (tokens, one segment, loss tokens, each by its limit) has the greatest dot product with the room that
is left, among those that fit. When none fits whole, the head of the longest piece fills the room and its rest waits on.
A sequence that closes below the token limit, because segments or loss tokens ran out or at the end of a task, is cut
into sequences whose lengths are powers of two, so that nothing is padded. No shuffle: a task packs the rows it
reads, whatever their source, and a lost task packs the same rows again in the same way.

A piece is one segment. Each token bears loss or not (``loss`` of ``pack_examples``, one byte a token, null: all do); in
documents all do. Defined results: a null example or text is empty; empty examples without any token have no
piece, documents always have their end id; repeated rows are packed each by itself, rows without an id as well. Other
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import Numbers, configure

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Pieces and bytes of the waiting pool of a task; above either, sequences are made until a quarter is left.
POOL, POOL_BYTES = 8192, 64 << 20
#: Chunks of text remembered with their ids, and their bytes, before a task starts anew.
REMEMBERED, REMEMBERED_BYTES = 600_000, 48 << 20
#: Pieces, and bytes of their ids, in an outgoing batch.
OUT, OUT_BYTES = 2000, 8 << 20


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass(frozen=True)
class Piece:
    """Tokens of an example from ``start`` on; ``lead[i]`` counts the loss tokens before token i here (None: i)."""

    key: object
    total: int
    start: int
    ids: np.ndarray
    lead: np.ndarray | None

    @property
    def tokens(self) -> int:
        return len(self.ids)

    @property
    def loss(self) -> int:
        return len(self.ids) if self.lead is None else int(self.lead[-1])

    def reach(self, tokens: int, loss: int) -> int:
        """Length of the longest head that has at most so many tokens and loss tokens."""
        most = min(len(self.ids), tokens)
        if self.lead is None:
            return min(most, loss)
        return min(most, int(np.searchsorted(self.lead, loss, "right")) - 1)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        lead = self.lead
        return (Piece(self.key, self.total, self.start, self.ids[:n], None if lead is None else lead[:n + 1]),
                Piece(self.key, self.total, self.start + n, self.ids[n:], None if lead is None else lead[n:] - lead[n]))

    def alone(self) -> Piece:
        """The piece without a hold on the rest of its example."""
        return Piece(self.key, self.total, self.start, self.ids.copy(), None if self.lead is None else self.lead.copy())


class Pool:
    """Waiting pieces by size class; ``best`` is the dot-product choice among those that fit."""

    def __init__(self, limits: Limits):
        self.limits, self.stacks, self.at = limits, [], {}
        self.size = np.zeros((0, 2), np.int64)
        self.number, self.bytes = 0, 0

    def put(self, p: Piece) -> None:
        kind = (p.tokens, p.loss)
        if kind not in self.at:
            self.at[kind] = len(self.stacks)
            self.stacks.append([])
            self.size = np.vstack([self.size, [kind]])
        self.stacks[self.at[kind]].append(p)
        self.number, self.bytes = self.number + 1, self.bytes + 4 * p.tokens

    def _take(self, at: int) -> Piece:
        p = self.stacks[at].pop()
        self.number, self.bytes = self.number - 1, self.bytes - 4 * p.tokens
        if not self.stacks[at]:  # the last class moves to the empty place
            kind, last = tuple(map(int, self.size[at])), len(self.stacks) - 1
            del self.at[kind]
            if at != last:
                self.stacks[at], self.size[at] = self.stacks[last], self.size[last]
                self.at[tuple(map(int, self.size[last]))] = at
            self.stacks.pop()
            self.size = self.size[:last]
        return p

    def best(self, tokens: int, segments: int, loss: int) -> Piece | None:
        """The fitting piece with the greatest dot product with the room left."""
        fits = (self.size[:, 0] <= tokens) & (self.size[:, 1] <= loss)
        if not fits.any():
            return None
        lim = self.limits
        dot = (self.size[:, 0] * (tokens / lim.tokens**2) + segments / lim.segments**2
               + self.size[:, 1] * (loss / lim.loss**2))
        return self._take(int(np.argmax(np.where(fits, dot, -1.0))))

    def head(self, tokens: int, loss: int) -> Piece | None:
        """The head of the longest piece that can be cut to fill the room; its rest waits on."""
        for at in np.argsort(-self.size[:, 0], kind="stable").tolist():
            p = self.stacks[at][-1]
            if n := p.reach(tokens, loss):
                a, b = self._take(at).cut(n)
                self.put(b)
                return a
        return None


class Packer:
    """Packs examples as they come; ``ready`` holds the pieces of closed sequences: (piece, sequence, offset)."""

    def __init__(self, limits: Limits, first: int = 0):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("every limit must be one at least")
        self.limits, self.pool, self.next, self.ready = limits, Pool(limits), first, []

    def add(self, key: object, ids: np.ndarray, loss: np.ndarray | None = None) -> None:
        lead = None if loss is None else np.r_[0, np.cumsum(loss != 0)]
        rest = Piece(key, len(ids), 0, ids, lead)
        while rest.tokens:
            piece, rest = rest.cut(rest.reach(self.limits.tokens, self.limits.loss))
            if piece.tokens == self.limits.tokens:
                self._close([piece])
            else:
                self.pool.put(piece.alone())
        if self.pool.number > POOL or self.pool.bytes > POOL_BYTES:
            while self.pool.number > POOL // 4 or self.pool.bytes > POOL_BYTES // 4:
                self._sequence()

    def finish(self) -> None:
        while self.pool.number:
            self._sequence()

    def _sequence(self) -> None:
        tokens, segments, loss, got = self.limits.tokens, self.limits.segments, self.limits.loss, []
        while tokens and segments and self.pool.number:
            p = self.pool.best(tokens, segments, loss) or self.pool.head(tokens, loss)
            if p is None:
                break
            got.append(p)
            tokens, segments, loss = tokens - p.tokens, segments - 1, loss - p.loss
        self._close(got)

    def _close(self, pieces: list[Piece]) -> None:
        """One sequence if full; otherwise one for each power of two in its length, greatest first."""
        left = sum(p.tokens for p in pieces)
        queue, most = pieces[::-1], left if left == self.limits.tokens else 0
        while left:
            room, offset = most or 1 << (left.bit_length() - 1), 0
            left -= room
            while room:
                p = queue.pop()
                if p.tokens > room:
                    p, rest = p.cut(room)
                    queue.append(rest)
                self.ready.append((p, self.next, offset))
                offset, room = offset + p.tokens, room - p.tokens
            self.next += 1


#: Letters that stay one letter in lower case (U+0130 does not), and the places between them and a sign that ends a
#: sentence: no token crosses these places, nor white space.
_LETTERS = "A-Za-zÀ-ÖØ-öø-\u012f\u0131-ɏ"
_CUT, _SIMPLE = re.compile(f"(?<=[{_LETTERS}])(?=[.,;:!?])"), re.compile(f"[{_LETTERS}]+")
#: A sentence sign after something else than these letters, digits and blanks.
_ODD = re.compile(f"[^{_LETTERS}0-9 ][.,;:!?]")


def chunks_of(text: str) -> list[str]:
    """Parts of a text that no token crosses; empty ones have no ids."""
    if text.isascii() and "<" not in text:
        text = text.lower()  # as the vocabulary does; a special token's text is left as it is
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if _ODD.search(text):
        text = _CUT.sub(" ", text)
    else:
        for sign in ".,;:!?":
            text = text.replace(sign + " ", f" {sign} ")
    return text.split(" ")


class Encoder:
    """Ids of whole texts, equal to the library's. Chunks that no token crosses are encoded once and remembered.

    When ``REMEMBERED`` is reached the chunks used most are kept. New chunks that are one word of plain letters need no
    more than lower case and the bytes' spelling before the library's merges; all others go through it whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        # How the vocabulary spells bytes: visible ones as themselves, the others in turn from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelled = dict(zip((b for b in range(256) if b not in set(seen)), range(256, 512)))
        self.number, self.bytes, self.uses = Numbers(), 0, np.empty(0, np.int64)
        self.flat, self.begin, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the chunks used most: half of the number, and of the bytes, that may be remembered."""
        known, bytes_ = list(self.number), 0
        self.number = Numbers()
        keep = []
        for i in np.argsort(-self.uses, kind="stable")[:REMEMBERED // 2].tolist():
            if (bytes_ := bytes_ + len(known[i])) > REMEMBERED_BYTES // 2:
                break
            keep.append(i)
            self.number[known[i]]
        self.number.fresh = []
        self.bytes = sum(map(len, self.number))
        ids, self.size = self._gather(np.array(keep, np.int64)), self.size[keep]
        self.flat, self.begin, self.uses = ids, np.cumsum(self.size) - self.size, np.zeros(len(keep), np.int64)

    def _gather(self, use: np.ndarray) -> np.ndarray:
        sizes = self.size[use]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[use] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _fresh(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each chunk's begin, how many) of some new chunks."""
        begin, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        plain = _SIMPLE.fullmatch
        simple = [i for i, c in enumerate(chunks) if plain(c)]
        cut, spelled = self.tokenizer.model.tokenize, self.spelled
        got = [cut(w if w.isascii() else w.encode().decode("latin-1").translate(spelled))
               for w in [chunks[i].lower() for i in simple]]
        ids = [t.id for x in got for t in x]
        size[simple] = [len(x) for x in got]
        rest = np.nonzero(size == 0)[0].tolist()
        more = [e.ids for e in self.tokenizer.encode_batch([chunks[i] for i in rest], add_special_tokens=False)]
        ids += [i for x in more for i in x]
        size[rest] = [len(x) for x in more]
        order = np.array(simple + rest, np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return np.array(ids, np.uint32), begin, size

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.number) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self._forget()
        number, use, count = self.number, [], []
        for t in texts:
            found = chunks_of(t) if t else []
            count.append(len(found))
            use.extend(map(number.__getitem__, found))
        if number.fresh:
            ids, begin, size = self._fresh(number.fresh)
            self.bytes += sum(map(len, number.fresh))
            number.fresh = []
            self.begin = np.concatenate((self.begin, len(self.flat) + begin))
            self.size, self.flat = np.concatenate((self.size, size)), np.concatenate((self.flat, ids))
            self.uses = np.concatenate((self.uses, np.zeros(len(size), np.int64)))
        use = np.array(use, np.int64)
        self.uses += np.bincount(use, minlength=len(self.uses))
        ids = self._gather(use)
        ends = np.concatenate(([0], np.cumsum(self.size[use])))[np.cumsum(count, dtype=np.int64)]
        return np.split(ids, ends[:-1]) if count else []


def _batches(packer: Packer, kind: pa.DataType, last: bool) -> Iterator[pa.RecordBatch]:
    """Outgoing batches of the closed sequences, full ones only unless ``last``."""
    while packer.ready and (last or len(packer.ready) >= OUT or
                            4 * sum(p.tokens for p, _, _ in packer.ready) >= OUT_BYTES):
        some, size = [], 0
        for x in packer.ready[:OUT]:
            some.append(x)
            if (size := size + 4 * x[0].tokens) >= OUT_BYTES:
                break
        packer.ready = packer.ready[len(some):]
        pieces = [p for p, _, _ in some]
        longs = lambda x: pa.array(x, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.key for p in pieces], kind), longs([p.start for p in pieces]),
             longs([p.tokens for p in pieces]), longs([p.loss for p in pieces]),
             pa.array([p.ids.astype("<u4").tobytes() for p in pieces], pa.binary()),
             longs([p.total for p in pieces]), longs([s for _, s, _ in some]), longs([o for _, _, o in some])],
            ["key", "start", "length", "loss_tokens", "ids", "total", "sequence_id", "offset"])


_OUT = ", start long, length long, loss_tokens long, ids binary, total long, sequence_id long, offset long"


def _pack(rows: DataFrame, examples, limits: Limits) -> DataFrame:
    """Packs what ``examples(batch)`` yields, (row number, ids, loss); the batch's first column is the key."""
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, key_type = Packer(limits, TaskContext.get().partitionId() << 40), None
        for b in batches:
            key_type, keys = b.schema.field(0).type, b.column(0).to_pylist()
            for row, ids, loss in examples(b):
                packer.add(keys[row], ids, loss)
            yield from _batches(packer, key_type, False)
        if key_type is not None:
            packer.finish()
            yield from _batches(packer, key_type, True)
    return rows.mapInArrow(run, f"key {kind}{_OUT}")


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Packs (example_id, ids, loss): ``ids`` an array of ints, ``loss`` a list of 0 and 1 as long, or null.

    Returns a row a piece: key, start, length, loss_tokens, ids (little-endian unsigned 32-bit), total (tokens of the
    example), sequence_id and offset in the sequence. A ``loss`` list of another length counts as null.
    """
    configure(examples.sparkSession)

    def read(b: pa.RecordBatch):
        for row, (ids, loss) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
            ids = np.array(ids or [], np.uint32)
            yield row, ids, None if loss is None or len(loss) != len(ids) else np.array(loss, np.int64)
    return _pack(examples.select("example_id", F.expr("filter(ids, x -> x is not null)").cast("array<long>").alias("ids"),
                                 F.expr("transform(loss, x -> coalesce(x, 1))").cast("array<long>").alias("loss")),
                 read, limits)


_ENCODERS: dict[int, Encoder] = {}


def pack_documents(docs: DataFrame, limits: Limits = Limits(), path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Tokenises whole texts with the vocabulary at ``path`` (read by the driver), appends ``end_id`` and packs them.

    Columns as of ``pack_examples``, with doc_id as key.
    """
    spark = configure(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    mark = zlib.crc32(shared.value.encode())

    def read(b: pa.RecordBatch):
        if mark not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[mark] = Encoder(shared.value)
        for row, ids in enumerate(_ENCODERS[mark].encode(b.column(1).to_pylist())):
            yield row, np.r_[ids, np.uint32(end_id)].astype(np.uint32), None
    return _pack(docs.select("doc_id", "text"), read, limits)
