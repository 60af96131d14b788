"""The archive of versions: batches, compaction, readers of older versions, interrupted writes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickharbor.sources import committed as K

DAY = 86_400_000_000
SCHEMA = "exchange string, symbol string, data_type string, exchange_sequence_id string, timestamp_collector long, timestamp_exchange long, data string"


@pytest.fixture(scope="module")
def events(spark):
    rows = [("okx", "btc" if i % 5 else "eth", "trade", str(i), 19_000 * DAY + (i % 2) * DAY + i, 5, "{}") for i in range(120)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(4)


def _part(events, n, of=4):
    return events.where(F.col("exchange_sequence_id").cast("int") % of == n)


def _ids(df):
    return sorted(int(row[0]) for row in df.select("exchange_sequence_id").collect())


def _files(root):
    return [path for path in Path(root).rglob("*.parquet") if "data" in path.parts]


def test_a_repeated_or_interrupted_batch_is_there_once(spark, events, tmp_path):
    root = str(tmp_path / "a")
    assert K.read_committed(spark, root).count() == 0 and K.current_version(spark, root).batch == -1
    K.commit_batch(_part(events, 0), root, 0)
    K.commit_batch(_part(events, 0), root, 0)
    assert len(_ids(K.read_committed(spark, root))) == 30
    # Files of a batch whose version was never written are not seen, and not in the way of the repeated batch.
    K._write_part(K.archive_rows(events, None), root, "batch-1", 100)
    (tmp_path / "a/versions/version=2").mkdir()
    assert len(_ids(K.read_committed(spark, root))) == 30
    K.commit_batch(_part(events, 1), root, 1)
    assert len(_ids(K.read_committed(spark, root))) == 60
    K.commit_batch(events.limit(0), root, 2)
    with pytest.raises(ValueError):
        K.commit_batch(events, root, 1)
    assert K.current_version(spark, root).batch == 2 and len(_ids(K.read_committed(spark, root))) == 60


def test_readers_see_files_before_or_after_a_compaction(spark, events, tmp_path):
    root = str(tmp_path / "b")
    for n in range(4):
        K.commit_batch(_part(events, n), root, n, server="srv")
    before, reading = K.current_version(spark, root), K.read_committed(spark, root)
    assert len(before.folders) == 4 and len(_files(root)) == 8
    after = K.compact_committed(spark, root, most_parts=1)
    # A table made before goes on with the old files, one made now takes the new ones; each holds every row once.
    assert _ids(reading) == _ids(K.read_committed(spark, root)) == list(range(120))
    assert {part for part, _, _ in after.folders} == {f"joined-{after.number}"}
    assert _ids(K.read_committed(spark, root, version=before.number)) == list(range(120))
    assert not set(reading.inputFiles()) & set(K.read_committed(spark, root).inputFiles())
    assert len(K.vacuum(spark, root, keep=1)) == 4 and K.vacuum(spark, root, keep=1) == []
    # One file for each symbol and date.
    assert len(_files(root)) == 4 and _ids(K.read_committed(spark, root)) == list(range(120))
    assert K.compact_committed(spark, root, most_parts=1) == after
    with pytest.raises(ValueError):
        K.read_committed(spark, root, version=before.number)
    K.commit_batch(_part(events, 0), root, 4, server="srv")
    assert len(_ids(K.read_committed(spark, root))) == 150


def test_an_unfinished_batch_survives_a_vacuum_and_dates_prune(spark, events, tmp_path):
    root = str(tmp_path / "c")
    K.commit_batch(events, root, 0)
    K._write_part(K.archive_rows(events, None), root, "batch-1", 100)
    assert K.vacuum(spark, root) == [] and (tmp_path / "c/data/part=batch-1").exists()
    one = K.read_committed(spark, root, dates=["2022-01-08"])
    assert len(one.inputFiles()) == 2 and len(_ids(one)) == 60
    assert K.read_committed(spark, root, dates=["1999-01-01"]).count() == 0
    plan = K.read_committed(spark, root).where("symbol = 'eth'").select("data")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    K.commit_batch(events.withColumn("symbol", F.lit("sol")), root, 1, max_records=25)
    assert all(len(list(folder.glob("*.parquet"))) == 3 for folder in (tmp_path / "c").rglob("symbol=sol/data_type=trade/server=none"))
