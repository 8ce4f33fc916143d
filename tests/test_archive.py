"""Archives of arrays come back as they were written, over several partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.plans import pipeline
from terrier.schemas import TRANSACTIONS_RAW
from terrier.sources import archive


def joined(texts):
    return np.frombuffer("\x00".join(texts).encode(), np.uint8)


def sales(n):
    texts = {f.name: [f"{f.name} é{i}" if i % 7 else "" for i in range(n)] for f in TRANSACTIONS_RAW}
    wide = {"prix": np.arange(n) * 1.5, "surface_habitable": np.where(np.arange(n) % 5, np.arange(n) * 0.5, np.nan)}
    whole = {"departement": (np.arange(n) % 97).astype(np.int16), "id_ville": np.arange(n, dtype=np.int16), "n_pieces": np.arange(n, dtype=">i4")}
    return {f.name: wide.get(f.name, whole.get(f.name, texts[f.name])) for f in TRANSACTIONS_RAW}


def written(path, columns, packed):
    save = np.savez_compressed if packed else np.savez
    save(path, **{n: joined(c) if isinstance(c, list) else c for n, c in columns.items()})
    return str(path)


@pytest.mark.parametrize("packed", [True, False])
def test_all_columns_come_back(spark, tmp_path, monkeypatch, packed):
    monkeypatch.setattr(archive, "READ_BYTES", 37)
    monkeypatch.setattr(archive, "BATCH_ROWS", 11)
    columns = sales(203)
    df = archive.read_archive(spark, written(tmp_path / "t.npz", columns, packed), rows=25)
    assert df.columns == TRANSACTIONS_RAW.names
    assert df.rdd.getNumPartitions() == 9
    got = df.toPandas().sort_values("prix")
    for name, want in columns.items():
        if isinstance(want, list):
            assert got[name].tolist() == want
        else:
            assert np.array_equal(got[name].to_numpy(float), want.astype(float), equal_nan=True)


def test_one_row_and_no_rows(spark, tmp_path):
    one = archive.read_archive(spark, written(tmp_path / "a.npz", {"a": np.array([5]), "b": ["x"]}, True))
    assert [tuple(r) for r in one.collect()] == [(5, "x")]
    none = archive.read_archive(spark, written(tmp_path / "b.npz", {"a": np.array([], float)}, True))
    assert none.columns == ["a"] and none.count() == 0


def test_a_text_of_several_blocks(spark, tmp_path):
    texts = ["short", "x" * (archive.READ_BYTES + 10), "", "end"]
    df = archive.read_archive(spark, written(tmp_path / "t.npz", {"t": texts, "k": np.arange(4)}, False), rows=3)
    assert [r.t for r in df.orderBy("k").collect()] == texts


def test_lengths_and_kinds_are_checked(spark, tmp_path):
    uneven = written(tmp_path / "u.npz", {"a": np.arange(3), "b": ["x", "y"]}, True)
    with pytest.raises(Exception, match="differ in length"):
        archive.read_archive(spark, uneven).collect()
    with pytest.raises(Exception, match="dimensions"):
        archive.read_archive(spark, written(tmp_path / "d.npz", {"a": np.zeros((2, 2))}, True)).collect()


def test_run_extract_reads_the_archive(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    (tmp_path / "data/raw_dataset").mkdir(parents=True)
    written(tmp_path / "data/raw_dataset/transactions.npz", sales(50), True)
    raw = pipeline.run_extract(spark, layout)
    assert raw.schema == TRANSACTIONS_RAW and raw.count() == 50
    assert raw.filter(F.col("surface_habitable").isNull()).count() == 10
