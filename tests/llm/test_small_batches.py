"""The pipeline's stages ask Spark for Arrow batches of bounded size and leave a limit of the session's own."""

import corpus_pipeline
import pyarrow as pa

from cases import frame
from terrier.llm import common

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_stages_get_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    docs = frame(spark, [(i, f"{i} " + "ab " * 33_000) for i in range(120)], parts=1).select("doc_id", "text")
    before = spark.conf.get(LIMIT, None)
    try:
        for stage in (corpus_pipeline.good_documents, corpus_pipeline.packed):
            spark.conf.unset(LIMIT)
            stage(spark, docs, "")
            found = docs.mapInArrow(sizes, "rows long, bytes long").collect()
            assert sum(r.rows for r in found) == 120 and len(found) > 1
            assert max(r.bytes for r in found) <= common.BATCH_BYTES + 2 * 100_000
        spark.conf.set(LIMIT, 1 << 25)
        common.small_batches(spark)
        assert spark.conf.get(LIMIT) == str(1 << 25)
    finally:
        spark.conf.unset(LIMIT) if before is None else spark.conf.set(LIMIT, before)
