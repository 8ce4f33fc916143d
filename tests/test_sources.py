"""Files in and out, stage cache, chunk ingestion, registry."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources import registry, scratch, stages, tables
from terrier.streaming.chunks import append_new_chunks

ABC = T.StructType([T.StructField(c, T.IntegerType()) for c in "abc"])


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"1",2,3\n')
    got = tables.read_csv_typed(spark, str(path), ABC).collect()
    assert [tuple(r) for r in got] == [(1, 2, 3), (4, 5, None), (1, 2, 3)]


def test_csv_folder_to_parquet(spark, tmp_path):
    (tmp_path / "taux_interet.csv").write_text("taux,date,other\n1.5,2014-01-01,x\n,2014-02-01,y\n")
    (tmp_path / "unknown.csv").write_text("k,v\n1,a\n")
    (tmp_path / "transactions_sample.csv").write_text("k\n1\n")
    (tmp_path / "notes.txt").write_text("no table")
    csv = tables.load_csv_tables(spark, str(tmp_path))
    assert set(csv) == {"taux_interet_df", "unknown_df"}
    assert csv["taux_interet_df"].columns == ["date", "taux"]
    converted = tables.csv_to_parquet(spark, str(tmp_path))
    assert set(converted) == set(tables.load_tables(spark, str(tmp_path))) == set(csv)
    rows = converted["taux_interet_df"].orderBy("date").collect()
    assert [tuple(r) for r in rows] == [("2014-01-01", 1.5), ("2014-02-01", None)]


def chunk(folder, name, *lines):
    (folder / f"transactions_chunk_{name}.csv").write_text("a,b,c\n" + "\n".join(lines) + "\n")


def test_ingest_chunks(spark, tmp_path):
    chunk(tmp_path, "0_2", "1,2,3", "4,5,6")
    chunk(tmp_path, "2_4", "7,8", "1,1,1,1")
    (tmp_path / "other.csv").write_text("a,b,c\n9,9,9\n")
    got = tables.ingest_chunks(spark, str(tmp_path), str(tmp_path / "out"), ABC)
    assert sorted(r["a"] for r in got.collect()) == [1, 4, 7]


def test_streamed_chunks_arrive_once(spark, tmp_path):
    chunk(tmp_path, "0_2", "1,2,3", "1,1,1,1")
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    append_new_chunks(spark, str(tmp_path), out, marks, ABC)
    chunk(tmp_path, "2_4", "4,5")
    append_new_chunks(spark, str(tmp_path), out, marks, ABC)
    append_new_chunks(spark, str(tmp_path), out, marks, ABC)
    assert sorted(r["a"] for r in spark.read.parquet(out).collect()) == [1, 4]


def test_csv_append(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_csv(spark.range(3), path)
    tables.write_csv(spark.range(2), path, mode="append")
    assert spark.read.csv(path, header=True).count() == 5


def test_materialize(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert stages.materialize(spark, path, lambda: spark.range(3)).count() == 3
    assert stages.materialize(spark, path, lambda: spark.range(9)).count() == 3
    empty = str(tmp_path / "empty")
    stages.materialize(spark, empty, lambda: spark.range(0))
    assert stages.materialize(spark, empty, lambda: spark.range(4)).count() == 0
    assert stages.materialize(spark, empty, lambda: spark.range(4), require_rows=True).count() == 4
    with pytest.raises(FileNotFoundError, match="run_clean first"):
        stages.require_stage(spark, str(tmp_path / "none"), "run_clean first")


def test_row_gate(spark):
    assert stages.expect_row_count(spark.range(5), 4, 6).count() == 5
    for low, high in ((5, 9), (1, 5)):
        with pytest.raises(ValueError, match="outside"):
            stages.expect_row_count(spark.range(5), low, high)


def test_latest_model(spark, tmp_path):
    root = str(tmp_path)
    assert registry.load_latest_model(spark, root, "gbt") is None
    for ts, value in (("20240102-000000", 2), ("20240101-000000", 1)):
        stage = SQLTransformer(statement=f"SELECT *, {value} AS v FROM __THIS__")
        registry.save_model(Pipeline(stages=[stage]).fit(spark.range(1)), root, "gbt", ts)
    model = registry.load_latest_model(spark, root, "gbt")
    assert model.transform(spark.range(1)).first()["v"] == 2


def test_runs_accumulate(spark, tmp_path):
    for i in range(2):
        registry.log_run(spark, str(tmp_path), "gbt", "train", 10, {"depth": 8}, {"rmse": i}, f"2024010{i}-000000")
    runs = registry.read_runs(spark, str(tmp_path)).collect()
    assert [r["metrics"]["rmse"] for r in runs] == [1.0, 0.0]
    assert runs[0]["params"] == {"depth": "8"}


def test_settle_uses_the_named_folder(spark):
    root = scratch.scratch_root(spark)
    settled = scratch.settle(spark.range(5).withColumn("x", F.col("id") * 2), "five")
    assert settled.inputFiles()[0].startswith(f"file://{root}/terrier/{spark.sparkContext.applicationId}/five-")
    assert settled.count() == 5


def test_scratch_is_cleared_by_its_owner_only(spark, monkeypatch):
    other = scratch.settle(spark.range(2), "other")
    monkeypatch.setattr(scratch, "scratch_home", lambda s: f"{scratch.scratch_root(s)}/terrier/mine")
    mine = scratch.scratch_path(spark, "x")
    spark.range(3).write.parquet(mine)
    scratch.clear_scratch(spark)
    assert not scratch.remove_folder.__globals__["path_exists"](spark, mine)
    assert other.count() == 2


def test_quoted_csv_is_read_as_pandas_writes_it(spark, tmp_path):
    pd = pytest.importorskip("pandas")
    text = T.StructType.fromDDL("a string, b int, c string")
    frame = pd.DataFrame({"a": ['RUE "X", 5', "two\nlines", "plain"], "b": [1, 2, 3], "c": ["z", "\\", ""]})
    frame.to_csv(tmp_path / "x.csv", index=False)
    rows = tables.read_csv_typed(spark, str(tmp_path / "x.csv"), text, multi_line=True).orderBy("b").collect()
    assert [(r["a"], r["b"]) for r in rows] == [('RUE "X", 5', 1), ("two\nlines", 2), ("plain", 3)]
    tables.write_csv(spark.createDataFrame(frame[["a", "b"]]), str(tmp_path / "out"))
    back = pd.concat([pd.read_csv(p) for p in (tmp_path / "out").glob("*.csv")]).sort_values("b")
    assert back["a"].tolist() == frame["a"].tolist()


def test_chunks_are_read_by_name_and_bad_lines_kept_aside(spark, tmp_path):
    chunk(tmp_path, "0_2", "1,2,3", "4,5,6,7")
    (tmp_path / "transactions_chunk_2_4.csv").write_text("c,x,a\n30,odd,10\n")
    got = tables.ingest_chunks(spark, str(tmp_path), str(tmp_path / "out"), ABC)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 3), (10, None, 30)]
    skipped = spark.read.text(str(tmp_path / "out_skipped")).collect()
    assert len(skipped) == 1 and '"surplus":"7"' in skipped[0][0]


def test_a_model_without_its_mark_is_not_the_latest(spark, tmp_path):
    root = str(tmp_path)
    model = Pipeline(stages=[SQLTransformer(statement="SELECT *, 1 AS v FROM __THIS__")]).fit(spark.range(1))
    registry.save_model(model, root, "gbt", "20240101-000000")
    model.write().save(registry.model_path(root, "gbt", "20240102-000000"))
    (tmp_path / "models/gbt/20240103-000000").mkdir()
    assert registry.load_latest_model(spark, root, "gbt").transform(spark.range(1)).first()["v"] == 1


def test_streamed_output_counts_as_a_stage(spark, tmp_path):
    chunk(tmp_path, "0_2", '"1",2,3')
    append_new_chunks(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "marks"), ABC)
    assert stages.require_stage(spark, str(tmp_path / "out"), "ingest first").count() == 1
