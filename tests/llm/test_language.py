import math
import random
from collections import Counter

from llm_helpers import make_docs, sentence  # noqa: F401

from churnlab.llm import ppm as P
from churnlab.llm.catalog import op10_ppm_language


def brute_bits(train: list[bytes], text: bytes, order: int) -> float:
    """Code length straight from the definition."""
    count = Counter(t[i - n:i + 1] for t in train for n in range(order + 1) for i in range(n, len(t)))

    def bits(context: bytes, byte: bytes) -> float:
        follow = {k: v for k, v in count.items() if len(k) == len(context) + 1 and k[:-1] == context}
        total, kinds = sum(follow.values()), len(follow)
        shorter = lambda: bits(context[1:], byte) if context else 8.0
        if not total:
            return shorter()
        if context + byte in follow:
            return -math.log2(follow[context + byte] / (total + kinds))
        return -math.log2(kinds / (total + kinds)) + shorter()
    return sum(bits(text[max(0, i - order):i], text[i:i + 1]) for i in range(len(text)))


def test_code_lengths_by_definition(spark):
    rnd = random.Random(1)
    texts = {"xx": ["abracadabra abba", "aé"], "yy": ["banana bandana", ""]}
    rows = [(i, t, g) for g, ts in texts.items() for i, t in enumerate(ts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for order in (0, 1, 3):
        model = P.fit(docs, order=order)
        tries = ["", "a", "ban", "abracadabra", "zé\n", "".join(rnd.choices("abn zq", k=60))]
        got = model.code_lengths([t.encode() for t in tries])
        assert model.langs == ["xx", "yy"]
        for t, row in zip(tries, got):
            for g, x in zip(model.langs, row):
                assert abs(x - brute_bits([s.encode() for s in texts[g]], t.encode(), order)) < 1e-6


def test_odd_rows(spark, make_docs):  # noqa: F811
    docs = make_docs([(1, "the cat sat on the mat"), (2, None), (3, ""), (4, "123 ² ½ _ ... !?"), (5, "é"), (6, "日本"),
                      (7, "the cat"), (7, "the cat"), (None, "on the mat"), (8, "der hund und die katze"),
                      (9, "the cat " * 40_000)])
    docs = docs.withColumn("lang", P.F.expr("if(doc_id = 8, 'de', if(doc_id = 5, null, lang))"))
    out = P.predict(docs, P.fit(docs)).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert len(out) == 11 and all(0 <= r.score <= 1 for r in out)
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[1][0] == got[9][0] == got[7][0] == "en" and got[8][0] == "de" and got[6][0] in ("de", "en")


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "aa", "b"), (2, "aa", "a")], "doc_id long, text string, lang string")
    r = P.predict(docs, P.fit(docs)).first()
    assert (r.lang_pred, r.score) == ("a", 0.5)


def test_empty_tables(spark, make_docs):  # noqa: F811
    model = P.fit(make_docs([]))
    assert P.predict(make_docs([]), model).count() == 0
    assert P.predict(make_docs([(1, "word")]), model).first().lang_pred == "und"


def test_learns_only_from_allowed_rows(spark, make_docs):  # noqa: F811
    docs = make_docs([(i, "abc " * (i + 1)) for i in range(30)])
    odd = docs.withColumn("lang", P.F.expr("if(doc_id < 10, 'zz', lang)"))
    assert P.fit(odd, P.F.col("doc_id") >= 10).langs == ["en"]


def test_held_out_accuracy_on_given_tables(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    out = op10_ppm_language(spark, d).join(docs, "doc_id").where("held_out").collect()
    assert len(out) > 200 and sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98


def test_a_huge_text_fills_no_more_than_its_share(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, sentence(rnd, 40), "bb") for i in range(1000)] + [(1000 + i, sentence(rnd, 5), "aa") for i in range(20)]
    rows.append((2000, sentence(rnd, 300_000), "aa"))
    seen, write, share = [], P.written, 80_000
    monkeypatch.setattr(P, "written", lambda df, name: seen.append(out := write(df, name)) or out)
    model = P.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_bytes=2 * share)
    size = {r.lang: r.n for r in seen[0].groupBy("lang").agg(P.F.sum(P.F.octet_length("text")).alias("n")).collect()}
    assert size["aa"] >= share and size["aa"] <= share + 2 * P.PIECE and len(rows[-1][1]) > 10 * share
    assert share <= size["bb"] <= share + 2 * P.PIECE
    assert model.langs == ["aa", "bb"]
