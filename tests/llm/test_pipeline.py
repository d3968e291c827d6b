"""The registered queries of this subpackage, and the pipeline stage by stage."""

import pytest
from compare import differences, second_engine
from conftest import SMALL
from test_documents import edited_long_lines

import __spark_entry__
import corpus_pipeline
from gustline.llm import decontaminate, fertility, fuzzy_lines, mixing, simhash_docs
from gustline.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_match_their_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), second_engine(SMALL), ORACLES[name]) == []


def test_the_pipeline_does_what_its_operators_say(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "source mixing"]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        if name != "source mixing":
            assert after.schema.names == docs.schema.names
            after = after.cache()
        kept[name] = (docs, after)
        docs = after
    ids = {name: tuple({r.doc_id for r in frame.select("doc_id").collect()} for frame in both) for name, both in kept.items()}

    before, after = ids["quality rules"]
    assert after == {r.doc_id for r in fertility.quality(kept["quality rules"][0]).where("kept").collect()} < before

    before, after = kept["line dedup"]
    removed = {(r.doc_id, r.line) for r in fuzzy_lines.line_groups(before).collect()}
    texts = {r.doc_id: r.text for r in after.collect()}
    for r in before.collect():
        left = "\n".join(x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in removed)
        assert texts.get(r.doc_id, "") in (left, "") and (r.doc_id in texts or not any(c.isalnum() for c in left))
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = ids["simhash near-dedup"]
    assert after == {r.component_id for r in simhash_docs.near_duplicates(kept["simhash near-dedup"][0]).collect()} <= before

    before, after = ids["benchmark decontamination"]
    assert after == {r.doc_id for r in decontaminate.contamination(kept["benchmark decontamination"][0], items).where("not contaminated").collect()}
    assert after <= before

    before, mixed = kept["source mixing"]
    taken = {r.doc_id: r.taken for r in mixing.mixed_sizes(before).collect()}
    sizes = {r.doc_id: len(r.text.encode().split()) for r in before.collect()}
    counted = {r.doc_id: r["count"] * sizes[r.doc_id] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in taken.items() if n}
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(r.mix_order for r in whole.collect()) == sorted(r.mix_order for r in mixed.collect())


def test_line_dedup_drops_long_lines_that_are_edited(spark):
    """The stage links similar lines that share no block among their least words, and long ones whose words are many but near."""
    pairs = edited_long_lines()
    ends = ["granite river", "copper lantern", "violet harbour", "silent meadow"]
    rows = [(k, f"{text}\n{ends[k]}", 1) for k, text in enumerate(sum(pairs, ()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SMALL).collect()}
    assert [left[k].count("\n") for k in range(4)] == [1, 0, 1, 0]
