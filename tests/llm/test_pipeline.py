"""The pipeline stage by stage, its queries, and the guard around the package."""

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    import corpus_pipeline
    from tidewatch.staging import stage

    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["documents"] = docs
    for name, step in corpus_pipeline.STAGES:
        docs = out[name] = stage(step(spark, docs, SF_DIR), name)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_follow_their_operators(spark, steps):
    from tidewatch.llm import decontamination, minhash_dedup, quality

    docs, good, single, clean, redacted, mixed = steps.values()
    assert [df.columns for df in (good, single, clean, redacted)] == [docs.columns] * 4
    net = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert ids(good) == ids(quality.score(docs, net).where("predicted = 1"))
    assert ids(single) == ids(minhash_dedup.near_duplicates(good).where("kept"))
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert ids(clean) == ids(single) - ids(decontamination.contaminated(single, items))
    texts = [r.text for r in items.collect()]
    assert not any(t in r.text for r in clean.collect() for t in texts)
    assert ids(redacted) == ids(clean) == ids(mixed) and 0 < clean.count() == mixed.count()
    before = {r.doc_id: r.text for r in clean.collect()}
    from test_text import base_spans

    for r in redacted.collect():
        assert not base_spans(r.text) and (base_spans(before[r.doc_id]) or r.text == before[r.doc_id])
    assert all(0 <= r.taken <= 2 * r.size for r in mixed.collect())


def test_run_equals_its_stages(spark, steps):
    import corpus_pipeline

    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(found.collect()) == sorted(steps["mixture"].collect())


def test_odd_rows_pass_all_stages(spark, tmp_path):
    import corpus_pipeline
    from cases import odd_rows

    rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None) for r in odd_rows()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, data, kind in (
        ("documents", rows, schema), ("labels", [(4, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int"),
        ("benchmark", [(1, "nothing like it"), (2, None)], "item_id bigint, text string"),
    ):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {1, 2, 3, 4, 5, 6, 8, 10, 13, None} <= {r.doc_id for r in found}
    assert not {7, 9} & {r.doc_id for r in found}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_keep_their_values(spark):
    """Columns named as helper columns of the stages pass through all of them unchanged."""
    import corpus_pipeline
    from tidewatch.staging import stage

    names = [
        "score", "predicted", "text to score", "row", "_doc_id", "_mark", "mark", "gone id", "kept", "component_id", "rid", "id",
        "found", "cleaned", "label", "quality", "print0", "component", "a b.c",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 100 + i)
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, SF_DIR), name)
    assert docs.columns[-len(names) :] == names
    rows = docs.collect()
    assert rows and all(r[name] == r.doc_id * 100 + i for r in rows for i, name in enumerate(names))
    mixed = corpus_pipeline.mixed(spark, docs, SF_DIR)
    assert mixed.count() == len(rows)


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(__spark_entry__.oracle_sql()) <= names
