"""Near-duplicates of long texts: what a task holds at once is bounded, with the same classes."""

import glob
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shoplens.llm import near_dedup

KEYS = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize", "parquet.block.size"]
MOST = 5 << 20


def test_batches_and_row_groups_stay_small(spark, monkeypatch):
    r = random.Random(5)
    texts = []
    for i in range(700):
        words = [f"w{r.randrange(10**9)}" for _ in range(1000)]
        texts += [words, [f"x{i}", *words[1:]]]
    assert sum(8 * (len(t) - near_dedup.SHINGLE + 1) for t in texts) > 2 * MOST
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    wide = spark.range(0, 4000, 1, 1).select(F.repeat(F.col("id").cast("string"), 2000).alias("t"))
    groups, batches, settings = [], [], set()
    plain = near_dedup.stored

    def sizes(parts):
        for batch in parts:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    def seen(df, *args, **named):
        out = plain(df, *args, **named)
        for path in out.inputFiles():
            for file in glob.glob(path.removeprefix("file://").removeprefix("file:")):
                meta = pq.ParquetFile(file).metadata
                groups.extend(meta.row_group(k).total_byte_size for k in range(meta.num_row_groups))
        settings.add(spark.conf.get(KEYS[1], None))
        if not batches:
            batches.extend(x["n"] for x in wide.mapInArrow(sizes, "n long").collect())
        return out

    monkeypatch.setattr(near_dedup, "stored", seen)
    spark.conf.set(KEYS[1], "256")  # a session that has less keeps it
    try:
        before = [spark.conf.get(k, None) for k in KEYS]
        got = {x["doc_id"]: x["class_id"] for x in near_dedup.classes(d).collect()}
        assert [spark.conf.get(k, None) for k in KEYS] == before
    finally:
        spark.conf.unset(KEYS[1])
    assert got == {i: i - i % 2 for i in range(len(texts))}
    assert settings == {"256"} and MOST // 2 < max(groups) <= MOST and max(batches) <= MOST
