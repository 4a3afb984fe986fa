"""The pipeline: its stages one after another, and the registered queries."""

from __future__ import annotations

import __spark_entry__ as registry
import corpus_pipeline
from bankpulse.llm.mixing import mix
from bankpulse.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.conftest import SCHEMA
from tests.llm.test_ngram_join import brute
from tests.llm.test_quality import measures
from tests.llm.test_tokens import check_packing


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages(spark, small_docs):
    docs, seen = small_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL).cache()
        seen[name] = (docs, after)
        if name != "packing":
            assert after.dtypes == small_docs.dtypes
        docs = after
    before, after = seen["quality_rules"]
    failed = {r.doc_id for r in before.collect() if measures(r.text)[-1]}
    kept = {r.doc_id for r in after.collect()}
    assert not kept & failed and len(kept) >= 0.8 * (before.count() - len(failed))
    before, after = seen["ngram_join"]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute([(r.doc_id, r.text) for r in before.collect()])})
    before, after = seen["pii"]
    assert sorted(r.doc_id for r in before.collect()) == sorted(r.doc_id for r in after.collect())
    assert not any("@mail" in r.text for r in after.collect())
    before, after = seen["mixing"]
    assert after.count() == sum(r.copies for r in mix(before).collect())
    before, after = seen["packing"]
    check_packing(before)
    assert after.groupBy("doc_id").sum("length").count() == before.select("doc_id").distinct().count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), SCHEMA if name != "packing" else None) if (
                name != "packing") else stage(spark, docs, SMALL)
        assert docs.count() >= 0
