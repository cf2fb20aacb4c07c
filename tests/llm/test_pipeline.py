"""The pipeline keeps what its stages say."""

import corpus_pipeline as P
from fieldmill.llm import decontamination, near_duplicates, repeats
from fieldmill.llm.tables import table


def test_stages(spark, docs, sf_dir, tmp_path):
    assert [name for name, _ in P.STAGES] == [
        "toxicity", "near_duplicates", "repeated_passages", "decontamination", "mixing"
    ]
    seen, left = {}, docs
    for name, stage in P.STAGES:
        stage(spark, left, sf_dir).write.parquet(str(tmp_path / name))
        left = seen[name] = spark.read.parquet(str(tmp_path / name))
        if name != "mixing":
            assert left.columns == docs.columns
    ids = {name: {r.doc_id for r in d.select("doc_id").collect()} for name, d in seen.items()}
    assert ids["mixing"] == ids["decontamination"] < ids["repeated_passages"] == ids["near_duplicates"]
    assert ids["near_duplicates"] < ids["toxicity"] < {r.doc_id for r in docs.collect()}
    assert near_duplicates.near_duplicates(seen["near_duplicates"]).where("not kept").isEmpty()
    assert repeats.repeated_spans(seen["repeated_passages"]).isEmpty()
    benchmark = table(spark, sf_dir, "benchmark")
    assert decontamination.contaminated(seen["decontamination"], benchmark).isEmpty()
    again = {(r.doc_id, r.text, r.place) for r in P.run(spark, sf_dir).collect()}
    assert again == {(r.doc_id, r.text, r.place) for r in seen["mixing"].collect()}


def test_stages_of_odd_rows(spark, odd, sf_dir):
    for _, stage in P.STAGES:
        assert stage(spark, odd, sf_dir).count() <= odd.count()
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
