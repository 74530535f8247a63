import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_helpers import rows_of

from churnlab.llm import collocation as C
from churnlab.llm.catalog import ORACLE

LOW = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10, covered=50, top=2000):
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    kept = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        if len(g) == 2 and any(100 * f[lang, h] >= covered * a for (other, h) in f
                               if other == lang and len(h) == 3 and f[other, h] >= least and g in (h[:2], h[1:])):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        kept.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    for lang, some in kept.items():
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(some)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed=1, docs=250):
    rnd = random.Random(seed)
    common = ["of", "The", "in", "a", "New", "york", "times", "Éa", "été", "~!x", "x|y"]
    long = ["w" * 80, "v" * 70 + "é"]
    rare = [f"r{i}" for i in range(400)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rnd.randrange(60)):
            words += rnd.choice([[rnd.choice(common)], ["New", "York", "Times"], ["in", "the", rnd.choice(common)],
                                 [rnd.choice(rare)], [long[0], long[1]], [rnd.choice(common), long[0], "of"]])
        text = "".join(w + rnd.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n", "\x0b"]) for w in words)
        rows.append((rnd.choice(["en", "en", "fr", None, ""]), text))
    return rows + [(None, None), ("en", ""), ("xx", "  .. "), ("en", rows[0][1]), ("en", rows[0][1])]


def found(spark, rows, top=2000, **kw):
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "lang string, text string, score int, phrase string").repartition(3)
    return rows_of(C.best(C.collocations(df, **kw), top))


@pytest.mark.parametrize("kw", [{}, {"head": 5, "pair_head": 3}, {"head": 0, "pair_head": 0}])
def test_by_brute_force_with_any_tables_of_ids(spark, kw):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 60 and any(len(r[2].split()) == 3 for r in want)
    assert found(spark, rows, **kw) == want


def test_few_rows_at_the_top_and_other_limits(spark):
    rows = corpus(2, 120)
    assert found(spark, rows, 7, least=4, covered=80) == brute(rows, 4, 80, 7)


def test_dense_tiles_and_full_tasks(spark, monkeypatch):
    """Busy tiles counted densely, coordinates merged and sent early: the same counts."""
    rnd = np.random.default_rng(3)
    t, x, y = C.Tiles(), rnd.zipf(1.3, 60_000) % 3000, rnd.zipf(1.3, 60_000) % 3000
    for a in range(0, 60_000, 20_000):
        t.add(x[a:a + 20_000], y[a:a + 20_000])
    assert t.dense
    got = Counter()
    for r, c, n in t.cells():
        got.update({(int(i), int(j)): int(k) for i, j, k in zip(r, c, n)})
    assert got == Counter(zip(x.tolist(), y.tolist()))


def test_one_very_long_text(spark):
    rows = [("en", "alpha beta gamma delta, " * 60_000 + "z" * 300_000)]
    assert found(spark, rows) == brute(rows)


def test_no_frequent_phrase_and_empty_table(spark):
    assert found(spark, [("en", "a b c")] * 9) == [] and found(spark, []) == []
    assert found(spark, [("en", "a b c")] * 10) == brute([("en", "a b c")] * 10) != []


def test_sql_twin_agrees(spark, tmp_path):
    rows = corpus(5, 150)
    spark.createDataFrame(rows, "lang string, text string").write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert sorted(con.sql(ORACLE["op13_collocations"]).fetchall(), key=str) == brute(rows)
