import re

import corpus_pipeline

from candleworks.llm import langid, packing, pii, quality
from test_simhash import distance, plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    """Each stage on its own input, row by row in plain Python with the stage's model."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "language", "near_duplicates", "personal_data", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}

    model = quality.fit(docs, labels)
    want = {
        i for i, r in rows.items()
        if not quality.base_fails(*quality.base_counts(r.text)) and quality.llr_scores([r.text], model.ratios)[0] >= model.threshold
    }
    good = stages["quality"](spark, docs, SF)
    assert good.schema == docs.schema and {r.doc_id for r in good.collect()} == want and 100 < len(want) < 200
    judged = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    assert judged == want

    named = stages["language"](spark, good, SF)
    model = langid.fit(good)
    assert named.columns == docs.columns
    assert {r.doc_id for r in named.collect()} == {i for i in want if not model.predict([rows[i].text]).rejected[0]}

    unique = stages["near_duplicates"](spark, named, SF)
    left = {r.doc_id: r for r in unique.collect()}
    assert unique.columns == docs.columns
    prints = {r.doc_id: plain_fingerprint(r.text) for r in named.collect()}
    groups = plain_components(list(prints), lambda a, b: distance(prints[a], prints[b]) <= 2)
    assert set(left) == set(groups.values()) and len(left) < len(prints)

    private = stages["personal_data"](spark, unique, SF)
    one = pii.Pseudonymiser()
    assert {r.doc_id: r.text for r in private.collect()} == {i: one.rewrite(r.text)[0] for i, r in left.items()}
    assert not [r for r in private.collect() if re.search(r"@mail\d", r.text) and r.text == rows[r.doc_id].text]

    pieces = stages["packing"](spark, private, SF)
    assert pieces.columns == packing._COLUMNS
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(left)


def test_run_gives_the_last_stage(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.columns == packing._COLUMNS and pieces.count() > 50
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_awkward_documents(spark, documents, awkward):
    for docs in (documents(awkward + ["plain words here " * 40]), documents([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            out.collect()
