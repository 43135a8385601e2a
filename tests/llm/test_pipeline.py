"""The corpus pipeline, stage by stage, against brute force on the smallest tables and on odd rows."""

import corpus_pipeline
import odd
import pytest
from conftest import SF

from churnspark.llm import mixing, toxicity
from churnspark.llm.tables import table


def after(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, SF)
    assert [c for c in out.columns if c != "copies"] == [c for c in docs.columns if c != "copies"]
    return out


def texts(df):
    return sorted(odd.pairs(df), key=str)


@pytest.fixture(params=["table", "odd"])
def docs(request, spark):
    return table(spark, SF, "documents") if request.param == "table" else odd.documents(spark)


def test_toxic_documents_go(spark, docs):
    labels = table(spark, SF, "labels")
    model = toxicity.learn(docs, labels.filter(toxicity.fold() != 1))
    want = toxicity.scored(docs, model, keep=["doc_id", "text"]) if "score" not in docs.columns else toxicity.scored(docs.drop("score", "hits"), model)
    assert texts(after(spark, docs, "toxicity")) == texts(want.filter("score < 0.7"))


def test_one_of_each_group_stays(spark, docs):
    pairs = odd.pairs(docs)
    groups = odd.joined(pairs)
    least = {v[0] for (d, t), v in groups.items() if odd.shingles(t)}
    got = odd.pairs(after(spark, docs, "n-gram Jaccard join"))
    assert sorted(odd.order(d) for d, t in got if odd.shingles(t)) == sorted(least)
    assert set(got) <= set(pairs)
    assert sum(not odd.shingles(t) for _, t in got) == sum(not odd.shingles(t) for _, t in pairs)


def test_repeats_are_cut(spark, docs):
    pairs = odd.pairs(docs)
    want = []
    for (d, t), (_, n, gone, digest) in zip(pairs, odd.repeats(pairs)):
        if not gone:
            want.append((d, odd.sha((t or "").encode())))
        elif gone < n:
            want.append((d, digest))
    got = [(d, odd.sha((t or "").encode())) for d, t in odd.pairs(after(spark, docs, "substring dedup"))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_contaminated_documents_go(spark, docs):
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    pairs = odd.pairs(docs)
    want = [p for p, h in zip(pairs, odd.hits(pairs, items)) if not h[5]]
    assert texts(after(spark, docs, "benchmark decontamination")) == sorted(want, key=str)


def test_the_mix_takes_what_the_plan_says(spark, docs):
    size = {p: len(odd.blank_words(p[1])) for p in odd.pairs(docs)}
    out = after(spark, docs, "mixing sources to target weights").select("doc_id", "text", "copies").collect()
    assert sum(r["copies"] * size[r["doc_id"], r["text"]] for r in out) == sum(r["taken"] for r in mixing.digest(docs).collect())


def test_whole_pipeline(spark):
    docs = table(spark, SF, "documents")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "copies"]
    step = docs
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF)
        step = spark.createDataFrame(step.collect(), step.schema)
    assert sorted(map(str, out.collect())) == sorted(map(str, step.collect()))
    assert 0 < out.count() < docs.count()


def test_empty_table_through_all_stages(spark):
    step = odd.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF)
    assert step.count() == 0
