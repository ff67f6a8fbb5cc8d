import pyarrow as pa
import pytest

from pitchline.llm import blocks
from pitchline.llm.common import arrow_batches

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_python_gets_few_rows_at_once(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    before = spark.conf.get(KEY, None)
    with arrow_batches(spark, 16):
        got = [r["n"] for r in spark.range(100, numPartitions=1).mapInArrow(sizes, "n long").collect()]
    assert max(got) <= 16 and sum(got) == 100
    assert spark.conf.get(KEY, None) == before


def test_a_smaller_setting_of_the_session_holds(spark):
    spark.conf.set(KEY, "5")
    try:
        with pytest.raises(ValueError), arrow_batches(spark, 16):
            assert spark.conf.get(KEY) == "5"
            raise ValueError
        assert spark.conf.get(KEY) == "5"
    finally:
        spark.conf.unset(KEY)


def test_texts_are_packed_from_small_batches(spark, monkeypatch):
    seen, write = [], blocks.materialize
    monkeypatch.setattr(blocks, "materialize", lambda df, tag: seen.append(spark.conf.get(KEY, None)) or write(df, tag))
    docs = spark.range(1000, numPartitions=1).selectExpr("id AS doc_id", "if(id % 7 = 0, NULL, repeat('ab ', CAST(id AS INT))) AS text")
    rows = [blocks.Block(r.asDict()) for r in blocks.to_blocks(docs, 100_000).collect()]
    assert seen == [str(blocks.TEXTS)]
    got = {d: t for b in rows for d, t in zip(b.ids, b.texts())}
    assert got == {i: b"" if i % 7 == 0 else b"ab " * i for i in range(1000)}
    assert len(rows) > 5 and sum(len(b.ids) for b in rows) == 1000
