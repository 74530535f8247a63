import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import make_docs, sentence  # noqa: F401
from tokenizers import Tokenizer

from churnlab.llm import packing as P

TOKENIZER = Tokenizer.from_file(P.VOCABULARY)


def library_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def check_pieces(rows, limits, wanted):
    """Every id in exactly one piece, limits held, offsets gapless; returns padded tokens and sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        by_doc[r["key"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    got = {}
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        at, ids = 0, []
        for r in pieces:
            assert r["start"] == at
            at += r["length"]
            ids += np.frombuffer(r["ids"], "<u4").tolist()
        assert {r["total"] for r in pieces} == {len(ids)}
        got[key] = ids
    assert got == wanted
    padded = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(r["loss_tokens"] for r in pieces) <= limits.loss
        padded += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padded, len(by_seq)


def test_documents_of_every_length_are_whole_and_unpadded(spark, make_docs):
    rnd = random.Random(1)
    texts = [sentence(rnd, rnd.choice([1, 3, 40, 400, 3000])) for _ in range(150)] + [None, "", " \n", "<|endoftext|> a'S B"]
    texts += ["x" * 30_000, "é ́ ǅ It's 3\x1c4 你好\U0001f600"]
    df = make_docs(list(enumerate(texts))).repartition(3)
    rows = P.pack_documents(df).collect()
    wanted = {i: library_ids(t) for i, t in enumerate(texts)}
    padded, sequences = check_pieces(rows, P.Limits(), wanted)
    total = sum(map(len, wanted.values()))
    assert padded == 0 and sequences <= total // 2048 + 3 * 11
    again = P.pack_documents(df).collect()  # a task that is run again packs the same
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_repeated_rows_and_rows_without_an_id(spark, make_docs):
    df = make_docs([(1, "one two"), (1, "one two"), (None, "three"), (2, None)])
    rows = P.pack_documents(df).collect()
    length = {}
    for r in rows:
        length[str(r["key"])] = length.get(str(r["key"]), 0) + r["length"]
    assert length == {"1": 6, "2": 1, "None": 2} and sum(r["start"] == 0 for r in rows) == 4
    assert P.pack_documents(make_docs([])).collect() == []


def test_instruction_data_under_all_three_limits(spark):
    rnd = random.Random(5)
    rows, wanted = [], {}
    for i in range(400):
        prompt, answer = rnd.randint(0, 120), rnd.choice([0, 5, 60, 250])
        ids = [rnd.randrange(1000) for _ in range(prompt + answer)]
        rows.append((i, ids, [0] * prompt + [1] * answer))
        if ids:
            wanted[i] = ids
    rows += [(900, [1, 2], None), (901, [3, 4], [1]), (902, None, None), (903, [5], [None])]
    wanted |= {900: [1, 2], 901: [3, 4], 903: [5]}
    df = spark.createDataFrame(rows, "example_id long, ids array<int>, loss array<int>").coalesce(1)
    limits = P.Limits(tokens=512, segments=6, loss=200)
    got = P.pack_examples(df, limits).collect()
    check_pieces(got, limits, wanted)
    loss = sum(r["loss_tokens"] for r in got)
    assert loss == sum(sum(x or 0 for x in m) for _, i, m in rows[:400]) + 2 + 2 + 1
    sizes = [P.Limits(tokens=512, segments=6), P.Limits(tokens=512, loss=200)]
    for lim in sizes:
        check_pieces(P.pack_examples(df, lim).collect(), lim, wanted)


def test_dot_product_choice():
    pool = P.Pool(P.Limits(tokens=100, segments=8, loss=50))
    piece = lambda n, loss: P.Piece(n, n, 0, np.zeros(n, np.uint32), np.r_[0, np.cumsum(np.arange(n) < loss)])
    for n, loss in ((60, 0), (40, 30), (10, 10)):
        pool.put(piece(n, loss))
    assert pool.best(100, 8, 50).key == 40  # .4 + .6 beats .6 and .1 + .2
    assert pool.best(100, 7, 10).key == 60
    assert pool.best(5, 7, 50) is None and pool.number == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60), st.integers(1, 32), st.integers(1, 5),
       st.integers(1, 32))
def test_packer_holds_any_limits(sizes, tokens, segments, loss):
    limits = P.Limits(tokens, segments, loss)
    packer, wanted = P.Packer(limits), {}
    for i, (plain, bearing) in enumerate(sizes):
        ids = np.arange(plain + bearing, dtype=np.uint32)
        packer.add(i, ids, np.r_[np.zeros(plain, int), np.ones(bearing, int)] if i % 3 else None)
        if len(ids):
            wanted[i] = ids.tolist()
    packer.finish()
    rows = [{"key": p.key, "start": p.start, "length": p.tokens, "loss_tokens": p.loss, "total": p.total,
             "ids": p.ids.astype("<u4").tobytes(), "sequence_id": s, "offset": o} for p, s, o in packer.ready]
    check_pieces(rows, limits, wanted)


def test_chunks_give_the_ids_of_the_library():
    rnd = random.Random(3)
    odd = ["'S", "'ll", "ΣΑΣ", "á", "́", "<|endoftext|>", "<|start", "oftext|>", " ", "\x0b", "\x1c",
           " ", "ﬁ", "12", "!!", "\U0001f600", "x" * 50, "İ", "ẞ"]
    encoder = P.Encoder(open(P.VOCABULARY, encoding="utf-8").read())
    texts = ["".join(rnd.choice(odd + [" ", "\n", "\t", "\r\n", "word", "The"]) for _ in range(30)) for _ in range(400)]
    letters = [chr(c) for c in range(0x250) if P._SIMPLE.fullmatch(chr(c))]
    assert len(letters) > 400
    texts += [x for c in letters for x in (c, f"a{c}b", f"{c}{c.upper()}.")]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids, repr(text)
    assert [len(x) for x in encoder.encode([None, "", " "])] == [0, 0, 0]


def test_bad_limits():
    with pytest.raises(ValueError):
        P.Packer(P.Limits(segments=0))


def test_query_digest(spark, make_docs, tmp_path):
    from churnlab.llm.catalog import QUERIES
    texts = ["Alpha beta", None, "gamma " * 3000]
    make_docs(list(enumerate(texts)), extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op11_packing"](spark, str(tmp_path)).collect():
        ids = library_ids(texts[r["doc_id"]])
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids)
