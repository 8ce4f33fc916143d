"""Functions over Arrow batches get slices of bounded size, whatever Spark puts into a batch."""

import pyarrow as pa

from cases import empty, frame
from terrier.llm import common


def test_long_texts_come_in_slices(spark):
    def rows(batches):
        for columns in batches:
            texts = columns["text"].to_pylist()
            yield columns["doc_id"].to_pylist(), [sum(map(len, texts))] * len(texts), [len(texts)] * len(texts)

    docs = frame(spark, [(i, "ab " * 33_000) for i in range(120)], parts=1).select("doc_id", "text")
    found = common.map_rows(docs, rows, "doc_id long, letters long, n long").collect()
    assert sorted(r.doc_id for r in found) == list(range(120))
    assert max(r.letters for r in found) <= common.BATCH_BYTES and min(r.n for r in found) > 1
    assert common.map_rows(empty(spark).select("doc_id", "text"), rows, "doc_id long, letters long, n long").count() == 0


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"x": list(range(1000)), "t": ["y" * (i % 7) for i in range(1000)]})
    for most in (1, 100, 1 << 22):
        cut = list(common.slices([batch, batch.slice(0, 0)], most))
        assert pa.Table.from_batches(cut) == pa.Table.from_batches([batch])
    assert len(list(common.slices([batch.slice(0, 0)]))) == 1
