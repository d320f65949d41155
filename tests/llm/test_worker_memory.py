"""What a Python worker and the JVM beside it hold of a job at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from termloom import session
from termloom.llm import huffman, wordids
from termloom.llm.queries import tokenizer_file

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batch_sizes(spark, rows=5000):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(batch)]})

    found = spark.range(rows, numPartitions=1).mapInArrow(sizes, "n bigint")
    return [r["n"] for r in session.stage(found, "test-batches").collect()]


@pytest.mark.parametrize("before", [None, "10000", "300"])
def test_staged_jobs_send_small_batches_and_leave_the_setting(spark, before):
    if before is not None:
        spark.conf.set(KEY, before)
    try:
        sizes = batch_sizes(spark)
        assert sum(sizes) == 5000
        assert max(sizes) == (300 if before == "300" else session.ARROW_ROWS)
        assert spark.conf.get(KEY, None) == before
    finally:
        spark.conf.unset(KEY)


def test_a_failed_job_leaves_the_setting(spark):
    with pytest.raises(RuntimeError), session.small_batches(spark):
        raise RuntimeError
    assert spark.conf.get(KEY, None) is None


@pytest.mark.parametrize("units", [40_000, 300_000])
def test_a_table_has_no_more_than_four_slots_a_unit(units):
    table = wordids.UnitTable("<u2")
    keys = np.arange(1, units + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, units, 4000):
        some = keys[at : at + 4000]
        table.add(some, np.ones(len(some), dtype=np.int64), np.arange(at, at + len(some)).astype("<u2"))
    assert 2 * units <= len(table.keys) <= 4 * units
    assert (table.ids[table.at[table.find(keys)]] == np.arange(units).astype("<u2")).all()


def test_ids_of_more_rows_than_a_batch_are_read_back(spark):
    rows = [(i, f"text {i % 7} of {i}") for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = session.new_path(spark, "test-ids")
    huffman.write_ids(docs, tokenizer_file(), path)
    found = huffman.read_ids(spark, path).orderBy("doc_id").collect()
    encoder = wordids.Encoder(tokenizer_file())
    step = np.dtype(encoder.wide)
    want = [[*np.frombuffer(raw, step).tolist(), huffman.END] for raw in encoder.encode([t for _, t in rows])]
    assert [r["doc_id"] for r in found] == list(range(2500))
    assert [r["ids"] for r in found] == want
    assert [r["start"] for r in found] == [0, *np.cumsum([len(w) for w in want])[:-1].tolist()]
