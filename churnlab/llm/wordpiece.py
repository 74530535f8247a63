"""Word-piece token counts by a linear longest-match automaton.

Greedy word-piece cutting takes the longest piece that fits, again and again: the first piece of a word from one set,
the others from the set of continuations. The trie of both sets gets failure links: where a state has no child for
the next byte, its longest pieces are popped and the walk goes on in the state that the rest of the bytes leads to.
Both are worked out beforehand, and for counting only the number of popped pieces is kept, so a word is read once and
no piece is ever built. All distinct words of a batch walk at the same time.

The vocabulary comes from a sentencepiece model file, whose path is a parameter: pieces with a space marker in front
begin words, those without continue them.

Words are runs of word characters and single other signs that are not white space. A word that cannot be cut is one
unknown token. Defined results: null and empty texts have 0 words and tokens; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import Numbers, configure, text_key
from churnlab.llm.double_array import DoubleArray
from churnlab.llm.unigram import MARK, MODEL

_WORD = re.compile(r"\w+|[^\w\s]")
_CONTINUES = b"\x00"  # leads from the root to the trie of continuations; never a byte of a word
#: Words over so many bytes walk one by one, so that they do not widen the table of the others.
LONG_WORD = 256
#: Words a counter remembers before it starts anew.
REMEMBERED = 300_000


def vocabulary(path: str = MODEL) -> tuple[list[str], list[str]]:
    """(pieces that begin words, pieces that continue them) of a sentencepiece model, without control and bytes."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [m.id_to_piece(i) for i in range(m.get_piece_size())
             if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    first = [p[1:] for p in plain if p.startswith(MARK) and p.strip(MARK)]
    return first, [p for p in plain if MARK not in p]


class Automaton:
    """The trie, and for each state its failure link (-1: none) and the pieces popped on the way there."""

    def __init__(self, first: list[str], rest: list[str]):
        keys = [p.encode() for p in first] + [_CONTINUES + p.encode() for p in rest]
        self.trie = trie = DoubleArray(keys + [_CONTINUES])
        self.inner = trie.child(0, 0)  # where continuations begin
        n = len(trie.base)
        self.fail, self.popped = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        kids: dict[int, list[tuple[int, int]]] = {}
        for to in np.nonzero(trie.check >= 0)[0].tolist():
            parent = int(trie.check[to])
            kids.setdefault(parent, []).append((to - int(trie.base[parent]) - 1, to))
        queue = deque([0, self.inner])
        while queue:
            parent = queue.popleft()
            for byte, state in kids.get(parent, ()):
                if state == self.inner:
                    continue
                if trie.value[state] >= 0:
                    self.fail[state], self.popped[state] = self.inner, 1
                else:
                    at, count = int(self.fail[parent]), int(self.popped[parent])
                    while at >= 0 and trie.child(at, byte) < 0:
                        count += int(self.popped[at])
                        at = int(self.fail[at])
                    if at >= 0:
                        self.fail[state], self.popped[state] = trie.child(at, byte), count
                queue.append(state)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, 0 if it cannot be cut."""
        out = np.zeros(len(words), np.int64)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        out[short] = self._walk([words[i] for i in short])
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._walk_one(w)
        return out

    def _walk(self, words: list[bytes]) -> np.ndarray:
        lens = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        begin = np.cumsum(lens) - lens
        done = np.zeros(len(words), np.int64)
        word, state, at = np.arange(len(words)), np.zeros(len(words), np.int64), begin.copy()
        end, count = begin + lens, np.zeros(len(words), np.int64)
        while len(word):
            inside = at < end
            to = np.where(inside, self.trie.step(state, flat[np.minimum(at, len(flat) - 1)]), -1)
            on = to >= 0
            count = np.where(on, count, count + self.popped[state])
            nxt = np.where(on, to, self.fail[state])
            at = at + on
            ended = (at >= end) & (nxt == self.inner)
            done[word[ended]] = count[ended]
            left = ~ended & (nxt >= 0)  # without a failure link the word cannot be cut
            word, state, at, end, count = word[left], nxt[left], at[left], end[left], count[left]
        return done

    def _walk_one(self, word: bytes) -> int:
        state, count = 0, 0
        for byte in word:
            while (to := self.trie.child(state, byte)) < 0:
                count += int(self.popped[state])
                if (state := int(self.fail[state])) < 0:
                    return 0
            state = to
        while state != self.inner:
            count += int(self.popped[state])
            if (state := int(self.fail[state])) < 0:
                return 0
        return count


class Counter:
    """Counts batches of texts and remembers the words met, up to ``REMEMBERED`` of them."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.number, self.sizes = automaton, Numbers(), np.empty(0, np.int64)

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, tokens, unknown words) of each text."""
        if len(self.number) > REMEMBERED:
            self.number, self.sizes = Numbers(), np.empty(0, np.int64)
        use, per_text, number = [], [], self.number
        for t in texts:
            found = _WORD.findall(t) if t else []
            per_text.append(len(found))
            use += [number[w] for w in found]
        fresh = [w.encode("utf-8", "surrogatepass") for w in number.fresh]
        number.fresh = []
        self.sizes = np.concatenate((self.sizes, self.automaton.lengths(fresh)))
        size = self.sizes[np.array(use, np.int64)]
        of_text = np.repeat(np.arange(len(texts)), per_text)
        total = lambda x: np.bincount(of_text, weights=x, minlength=len(texts)).astype(np.int64)
        return np.array(per_text, np.int64), total(np.maximum(size, 1)), total(size == 0)


def token_counts(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text_key, n_words, n_tokens, n_unknown) of every document."""
    spark = configure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(Automaton(*vocabulary(path)))
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = Counter(shared.value)
        for b in batches:
            if b.num_rows:
                counts = counter.count(b.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, counts)],
                                                 ["doc_id", "text_key", "n_words", "n_tokens", "n_unknown"])
    return src.mapInArrow(run, f"doc_id {kind}, text_key long, n_words long, n_tokens long, n_unknown long")
