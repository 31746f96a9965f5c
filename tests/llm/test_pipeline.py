import random
from collections import Counter

import pytest

import corpus_pipeline
from meterflow.llm import jaccard, toxicity
from meterflow.llm.store import step
from tests.llm.data import empty, odd, prose

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(step(stage(spark, found[-1], SMALL), name))
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_each_stage_decides(spark, tables):
    docs, clean, single, free, private, packed = tables
    assert all(t.columns == docs.columns for t in tables[1:5])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(~toxicity.held_out())
    bad = {r["doc_id"] for r in toxicity.score(docs, toxicity.train(docs, labels)).where("score >= 0.5").collect()}
    assert bad and ids(clean) == ids(docs) - bad
    groups = {r["doc_id"]: r["component_id"] for r in jaccard.link_documents(clean).collect()}
    assert ids(single) == {i for i, g in groups.items() if i == g} and len(ids(single)) < len(ids(clean))
    assert ids(free) < ids(single) and ids(private) == ids(free) == ids(packed)


def test_the_benchmark_is_gone_and_personal_data_too(spark, tables):
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    free, private = tables[3], tables[4]
    texts = {r["doc_id"]: r["text"] for r in free.collect()}
    assert not any(item in text for text in texts.values() for item in items)
    new = {r["doc_id"]: r for r in private.collect()}
    changed = [i for i in texts if texts[i] != new[i]["text"]]
    assert changed and all("example.com" not in new[i]["text"] for i in new)
    assert all(new[i]["n_chars"] == len(new[i]["text"]) for i in new)


def test_run_gives_the_last_table(spark, tables):
    got = corpus_pipeline.run(spark, SMALL)
    assert {(r["doc_id"], r["piece"], r["length"]) for r in got.collect()} == {(r["doc_id"], r["piece"], r["length"]) for r in tables[5].collect()}


def test_near_copies_go_by_row(spark):
    """Missing and repeated ids, further columns, an empty table: one row of each group stays, and no other text goes."""
    rng = random.Random(9)
    a, b, c = (prose(rng, 50) for _ in range(3))
    rows = [(4, a), (2, a + " end"), (None, a), (None, b), (None, b), (6, b), (6, c), (8, c), (9, c), (9, c), (None, None), (1, ""), (1, "  "), (None, "few words here"), (None, "few words here")]
    docs = spark.createDataFrame([(i, t, "x", 1, "r") for i, t in rows], "doc_id long, text string, row string, component_id int, _row string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SMALL)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter([(2, a + " end"), (6, b), (6, c), (None, None), (1, ""), (1, "  "), (None, "few words here")])
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), SMALL).count() == 0


def test_stages_take_odd_tables(spark):
    """Every stage on null ids, repeated rows, empty texts and clashing names, and on an empty table."""
    for docs in (odd(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = step(stage(spark, docs, SMALL), name)
            if name != "packing":
                assert docs.columns == odd(spark).columns
        docs.count()
