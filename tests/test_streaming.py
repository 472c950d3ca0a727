"""Metadata stream: file source, availableNow, restart from the checkpoint."""

import pytest

from arborflow.operators.metadata import TABLE_FIELDS
from arborflow.plans import derive
from arborflow.sources.records import RECORD_SCHEMA, stream_records
from arborflow.streaming.metadata import read_metadata, table_writer, with_trigger


def test_triggers_exclude_each_other():
    with pytest.raises(ValueError):
        with_trigger(None, processing_time="10 seconds", available_now=True)


def test_metadata_stream_and_restart(spark, sf, tmp_path):
    source, table, checkpoint = (str(tmp_path / name) for name in ("in", "table", "checkpoint"))
    records = derive.metadata_records(spark, sf)
    early = records.where("offset < 500")

    def drain():
        stream = stream_records(spark, "parquet", source)
        query = table_writer(stream, checkpoint, table, buckets=8, available_now=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    early.write.mode("append").parquet(source)
    assert drain() == early.count()
    before = read_metadata(spark, table).collect()
    assert drain() == 0
    assert read_metadata(spark, table).columns == TABLE_FIELDS
    assert sorted(read_metadata(spark, table).collect()) == sorted(before)
    records.where("offset >= 500").write.mode("append").parquet(source)
    drain()
    final = {r.file_id: r.event_id for r in read_metadata(spark, table).collect()}
    newest = {}
    for r in records.where("value NOT LIKE '{broken%' AND value LIKE '%FILE_METADATA_UPSERT%'").orderBy("offset").collect():
        newest[r.key] = f"x{r.offset}"
    assert final == newest and len(final) > 0
    assert RECORD_SCHEMA.startswith("key string")
