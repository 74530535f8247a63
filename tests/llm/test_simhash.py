import random

import numpy as np
import pytest
import xxhash
from llm_helpers import WORDS, make_docs  # noqa: F401

from churnlab.llm import simhash as S


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """doc index -> smallest id reachable."""
    fps = [brute_fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                part[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return [(d, f, min((x for x in groups[find(i)] if x is not None), default=None))
            for i, ((d, _), f) in enumerate(zip(rows, fps))]


def near_copies(seed=1):
    """Texts, copies with a word changed, exact copies, blank and null texts, repeated rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(25):
        base = [rnd.choice(WORDS) for _ in range(rnd.choice([1, 3, 4, 60, 200]))]
        rows.append((10 * i + 9, " ".join(base)))
        for k in range(rnd.randrange(4)):
            copy = list(base)
            copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            rows.append((10 * i + k, " ".join(copy).upper() if k % 2 else "\t" + "\n".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \x0b\t"), (1003, rows[0][1]), rows[5], rows[5], (None, rows[3][1]),
             (None, "only here and nowhere else at all")]
    return rows


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_by_bits():
    for _, t in near_copies():
        assert S.fingerprint(S.words_of(None if t is None else t.encode())) == signed(brute_fingerprint(t))
    long = ("lorem Ipsum dolor " * 30000).strip()
    assert S.fingerprint(S.words_of(long.encode())) == signed(brute_fingerprint(long))
    assert S.words_of("Ä B c".encode()) == ["Ä b c".encode()]  # only ASCII spaces and letters


@pytest.mark.parametrize("segments,tile", [(1, 4096), (1, 3), (2, 5), (4, 4)])
def test_components_by_all_pairs(spark, make_docs, segments, tile):
    rows = near_copies()
    got = S.near_duplicates(make_docs(rows), segments=segments, tile_rows=tile).collect()
    want = [(d, signed(f), c) for d, f, c in brute_components(rows)]
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=str) == sorted(want, key=str)


def test_keep_one(make_docs):
    rows = near_copies()
    kept = S.keep_one(make_docs(rows))
    comps = brute_components(rows)
    want = {d for d, _, c in comps if d is not None and d == c}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert got.count(None) == sum(d is None and c is None for d, _, c in comps)
    assert kept.columns == make_docs(rows).columns


def test_keep_one_of_each_group_when_an_id_has_two_texts(make_docs):
    rnd = random.Random(9)
    one, two = (" ".join(rnd.choice(WORDS) for _ in range(200)) for _ in range(2))
    rows = [(1, one), (1, two), (1, two), (5, one + " tail"), (6, two + " tail"), (7, one), (8, two)]
    roots = {c for _, _, c in brute_components([(i, t) for i, (_, t) in enumerate(rows)])}
    assert len(roots) == 2  # two unrelated groups, both with 1 as their smallest id
    assert sorted((r.doc_id, r.text) for r in S.keep_one(make_docs(rows)).collect()) == sorted([(1, one), (1, two)])
    near = [(1, one), (1, one + " tail"), (2, one)]  # an id on two texts of one group still stays once
    assert [r.doc_id for r in S.keep_one(make_docs(near)).collect()] == [1]


def test_dense_group_gives_a_forest():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, dtype=np.uint64)
    a = np.unique(base ^ (np.uint64(1) << rnd.integers(0, 64, 300, dtype=np.uint64)))
    u, v = S.tile_links(a, a, 4, True)
    assert len(u) == len(a) - 1 and (np.bitwise_count(u ^ v) <= 4).all()
    b = np.unique(a ^ np.uint64(3))
    u, v = S.tile_links(a, b, 4, False)
    assert len(u) <= len(a) + len(b) - 1
    assert len(S.tile_links(a[:1], a[:1], 4, True)[0]) == 0


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in S.connected(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_empty(make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0 and S.keep_one(make_docs([])).count() == 0


def test_segment_rule_grows():
    assert [S.segments_for(n) for n in (0, 100, 10**5, 10**7, 10**10)] == [1, 1, 2, 4, 8]
