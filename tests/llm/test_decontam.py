import itertools
import random
import resource
import time

import pytest
from llm_helpers import WORDS, make_docs, sentence  # noqa: F401

from churnlab.llm import decontam as D


def tokens(text):
    return D.re.findall(r"\w+", (text or "").lower())


def brute(docs, items):
    """Every pair with an aligned run that agrees often enough, and its best count."""
    out = set()
    for (i, a), (k, b) in itertools.product(enumerate(docs), items):
        x, y = tokens(a), tokens(b)
        run = min(D.WINDOW, len(y))
        if not y:
            continue
        best = 0
        for shift in range(-len(y), len(x) + 1):
            low, high = max(0, -shift), min(len(y), len(x) - shift)
            equal = [x[j + shift] == y[j] for j in range(low, high)]
            best = max([best, *(sum(equal[s:s + run]) for s in range(len(equal) - run + 1))])
        if best >= (D.MATCHES if run == D.WINDOW else run):
            out.add((i, k, best))
    return out


def test_masks_hit_every_run_with_three_substitutions():
    places = [[{s + i for i, c in enumerate(m) if c == "1"} for s in range(D.WINDOW - len(m) + 1)] for m in D.MASKS]
    spots = [p for ps in places for p in ps]
    for bad in itertools.combinations(range(D.WINDOW), D.WINDOW - D.MATCHES):
        assert any(not p & set(bad) for p in spots)
    assert all(any(len(m) <= n for m in D.MASKS) for n in range(D.SPAN, D.WINDOW))


def fixture(seed):
    rnd = random.Random(seed)
    items = [(k, sentence(rnd, rnd.choice([1, 2, 3, 6, 7, 10, 14, 15, 16, 40]))) for k in range(20)]
    docs = []
    for i in range(60):
        w = sentence(rnd, rnd.choice([0, 5, 30, 200])).split()
        for _ in range(rnd.randrange(3)):
            _, item = rnd.choice(items)
            part = [x if rnd.random() > rnd.choice([0, 0.1, 0.25]) else rnd.choice(WORDS) for x in item.split()]
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part[rnd.choice([0, 0, 3]):]
        docs.append(" ".join(x.upper() if rnd.random() < 0.2 else x + rnd.choice(["", ",", "!!", "***"]) for x in w))
    return docs + [None, "", "...", docs[3], docs[3]], items + [(90, None), (91, ""), (92, items[5][1]), items[5]]


@pytest.mark.parametrize("seed,block", [(1, D.BLOCK_BYTES), (2, 300), (3, D.BLOCK_BYTES)])
def test_pairs_by_brute_force(spark, make_docs, seed, block):
    docs, items = fixture(seed)
    df = make_docs(list(enumerate(docs)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.overlaps(df, bench, block)
    want = brute(docs, dict(items).items())
    assert sorted((r.doc_id, r.item_id, r.equal) for r in got.collect()) == sorted(want)
    kept = D.decontaminate(df, bench, block)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(docs))) - {i for i, _, _ in want})
    assert kept.schema == df.schema


@pytest.mark.parametrize("hits,cells", [(1, 50), (40, 1 << 20), (1 << 19, 64)])
def test_slices_change_nothing(hits, cells, monkeypatch):
    """Texts and items of repeated tokens, whole and nearly whole, at any slice size: what plain loops find."""
    rnd = random.Random(8)
    items = [(0, "a " * 40), (1, "a b " * 12), (2, "a a a a b " * 6), (3, "c " * 15 + sentence(rnd, 5)), (4, "a"),
             (5, "b a b"), (6, "a " * 13 + "b"), (7, sentence(rnd, 30))]
    docs = ["a " * 120, "x " + "a b " * 40 + "y", "a a a b a " * 20, sentence(rnd, 20) + " c" * 16, "b a", None, "c c " * 9,
            items[7][1] + " a" * 50, ("a " * 9 + "z ") * 8]
    whole = D.Index(items).overlaps(docs)
    assert {(t, k, x) for t, k, *_, x in whole} == brute(docs, items)
    monkeypatch.setattr(D, "HITS", hits)
    monkeypatch.setattr(D, "CELLS", cells)
    assert D.Index(items).overlaps(docs) == whole


def test_a_megabyte_of_one_word_in_bounded_time_and_memory():
    index = D.Index([(0, "a " * 200), (1, "a b " * 100), (2, "c c c c d " * 40)])
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    found = index.overlaps(["a " * 500_000, "a b " * 250_000, "c " * 60_000])  # the last is never found whole
    assert [(t, i, x) for t, i, *_, x in found] == [(0, 0, 15), (1, 1, 15), (2, 2, 12)]
    assert time.time() - began < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20


def test_scripts_without_spaces(spark, make_docs):
    item = "今天天气很好我们一起去公园散步吧朋友"
    bench = spark.createDataFrame([(1, item), (2, "短句子")], "item_id long, text string")
    docs = make_docs([(1, "前言" + item + "后记"), (2, "他说短句子。"), (3, "今天下雨"), (4, item[:5])])
    got = D.overlaps(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.equal) for r in got) == [(1, 1, 15), (2, 2, 3)]


def test_positions_point_at_the_run(spark, make_docs):
    rnd = random.Random(5)
    item = sentence(rnd, 30)
    doc = sentence(rnd, 50) + " " + item + " " + sentence(rnd, 9)
    r = D.overlaps(make_docs([(1, doc)]), spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    a, b = tokens(doc)[r.doc_token:r.doc_token + r.run], tokens(item)[r.item_token:r.item_token + r.run]
    assert a == b and r.equal == r.run == 15


def test_hashes_do_not_depend_on_place():
    texts = ["Été — “quoted” x_1\x00y", None, "", "a" * 3_000_000 + " tail", "tail quoted été", "x " * 200_000]
    flat, starts, lens, _ = D.token_hashes(texts)
    assert [len(tokens(t)) for t in texts] == lens.tolist()
    seen = {}
    for t, s, n in zip(texts, starts, lens):
        for w, h in zip(tokens(t), flat[s:s + n].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    assert D.overlaps(make_docs([]), one).count() == 0
    assert D.overlaps(make_docs([(1, "a b")]), none).count() == 0
    assert D.decontaminate(make_docs([(1, "a b")]), none).count() == 1
