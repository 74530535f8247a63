import itertools

from test_decontam import brute as overlapping
from test_simhash import brute_components

import corpus_pipeline
from churnlab.llm import cotrain, toxicity, unigram

D = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    """Each stage's kept rows by plain loops over the rows its predecessor kept; the models are the operators' own."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels = spark.read.parquet(f"{D}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    model = cotrain.fit(docs, labels)
    good = [i for i, r in rows.items()
            if cotrain._probabilities(model, [r.text], [r.source], [r.lang], [r.n_chars])[2][0] >= 0.5]
    kept = docs.where(docs.doc_id.isin(good))
    words = toxicity.fit(kept, labels)
    clean = [i for i in good if toxicity.scores([rows[i].text], words)[0] < 0.5]
    comps = brute_components([(i, rows[i].text) for i in clean])
    single = [i for i, _, c in comps if i == c]
    leaks = {i for i, _, _ in overlapping([rows[i].text for i in single], items)}
    left = [i for k, i in enumerate(single) if k not in leaks]
    assert len(rows) > len(good) > len(clean) > len(single) > len(left) > 0
    out = corpus_pipeline.run(spark, D).collect()
    assert sorted(r.doc_id for r in out) == sorted(left)
    voc = unigram.load()
    for r in itertools.islice(out, 40):
        assert r.decodes and unigram.decode(voc, r.ids) == r.text == rows[r.doc_id].text


def test_stages_keep_the_columns_and_take_odd_tables(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
                                 (2, "word " * 60_000, None, None, -5)], docs.schema)
    for given in (docs.limit(0), odd):
        now = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, D)
            if name != "sentencepiece":
                assert out.columns == docs.columns
            out.collect()
            now = out if name != "sentencepiece" else now
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination",
                                                      "sentencepiece"]
