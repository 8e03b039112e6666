"""The pipeline's stages take effect on their own input."""

import corpus_pipeline
from idlewatch.llm import decontamination, mixing, similar_sets, toxicity
from idlewatch.llm.common import stored, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, before, sf_dir), name)
        assert docs.columns == before.columns
        kept[name] = before, docs
    before, after = kept["toxicity"]
    bad = {r.doc_id for r in toxicity.scored(before, table(spark, sf_dir, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == bad
    before, after = kept["near_duplicates"]
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in similar_sets.near_components(before).collect()})
    before, after = kept["decontamination"]
    bad = {r.doc_id for r in decontamination.contaminated(before, table(spark, sf_dir, "benchmark")).collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == bad
    before, after = kept["mixture"]
    want = {r.doc_id: r.copies for r in mixing.mixed_copies(before).collect() if r.copies}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == want
    assert corpus_pipeline.write_tokens(spark, docs, sf_dir).count() == docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()
