import corpus_pipeline
from cases import awkward
from test_exact import brute as copies
from test_jaccard import brute as near
from test_pii import brute as private

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_on_what_its_predecessor_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
        if name != "packing":
            assert docs.columns == columns
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in kept[:4]]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    all_ids = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    gone = all_ids - {i for i, _ in rows[0]}
    assert not any(labels.get(i) == 1 for i in gone)
    assert {i for i, *_ in rows[1]} == {i for i, _, _, keep, _ in copies(rows[0]) if keep}
    assert {i for i, _ in rows[2]} == {i for i, (_, c) in near(rows[1]).items() if i == c}
    before = dict(rows[2])
    for i, text in rows[3]:
        assert not private(text)
        if not private(before[i]) and "token" not in before[i].lower():
            assert text == before[i]
    assert {r.doc_id for r in kept[4].collect()} == {i for i, _ in rows[3]}


def test_stages_take_awkward_rows(spark, tmp_path):
    docs = awkward(spark).drop("n").withColumnRenamed("words", "n_chars").withColumn("n_chars", corpus_pipeline.F.lit(1).cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.count() == 0
