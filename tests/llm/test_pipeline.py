"""The pipeline on a small fixture, stage by stage."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as P
    from fabula.llm import ngram_jaccard, temperature, toxicity
    from fabula.llm.scratch import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test"))
    kept = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert {r.doc_id for r in out[1].collect()} == kept
    alone = {r.doc_id for r in ngram_jaccard.jaccard_components(out[1]).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in out[2].collect()} == alone and len(alone) < len(kept)
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (out[2], out[3]))
    assert set(after) <= set(before) and all(len(after[k]) <= len(before[k]) for k in after)
    assert {r.doc_id for r in out[4].select("doc_id").collect()} == set(after)
    want = Counter(r.doc_id for r in temperature.mixed(out[3]).collect())
    assert Counter(r.doc_id for r in out[4].collect()) == want
    assert all(d.columns == docs.columns for d in out[1:5])
    assert out[5].count() == out[4].count() == P.run(spark, SF).count()
    assert out[5].where(F.length("ids_sha256") != 64).count() == 0


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing columns; and an empty table."""
    from corpus import SCHEMA, rows

    import corpus_pipeline as P
    from fabula.llm.scratch import written

    long = " ".join(f"word{k * 7919 % 100_003}" for k in range(60_000))
    data = rows() + [(900, long, "en", "s1", len(long), 1, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    for table in (docs, docs.limit(0)):
        out = table
        for name, stage in P.STAGES[:-1]:
            out = written(stage(spark, out, SF), "odd")
            assert out.columns == docs.columns, name
        last = P.STAGES[-1][1](spark, out, SF)
        assert last.count() == out.count()
    assert docs.limit(0).count() == 0
    kept = {r.doc_id for r in written(P.STAGES[1][1](spark, docs, SF), "odd").collect()}
    assert 900 in kept and None in kept
