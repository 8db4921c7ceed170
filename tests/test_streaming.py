import json
import os
import time

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from millrace.streaming.sinks import to_console, to_parquet, to_versioned
from millrace.streaming.sources import json_folder
from millrace.versioned.table import VersionedTable

DEVICE = "device STRING, status STRING"


@pytest.fixture
def put(path):
    def write(name, *records):
        os.makedirs(f"{path}/in", exist_ok=True)
        with open(f"{path}/in/.{name}", "w") as file:
            file.writelines(json.dumps({"device": d, "status": s}) + "\n" for d, s in records)
        os.rename(f"{path}/in/.{name}", f"{path}/in/{name}")

    return write


def _three_files(put):
    put("a.json", ("d1", "on"), ("d2", "off"))
    put("b.json", ("d1", "off"))
    put("c.json", ("d3", "on"))


def test_one_file_per_batch_and_commit(spark, put, path):
    _three_files(put)
    stream = json_folder(spark, f"{path}/in", DEVICE, max_files=1)
    query = to_versioned(stream, f"{path}/table", f"{path}/checkpoint", finish=True)
    assert not query.isActive
    table = VersionedTable(spark, f"{path}/table")
    assert [r.operation for r in table.history().orderBy("version").collect()] == ["create"] + ["append"] * 3
    assert table.read().count() == 4


def test_resuming_takes_new_files_only(spark, put, path, rows):
    _three_files(put)
    for extra in (None, ("d.json", ("d4", "on"))):
        if extra:
            put(*extra)
        to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint", finish=True)
    assert VersionedTable(spark, f"{path}/table").read().count() == 5


def test_a_batch_repeated_after_a_crash_is_written_once(spark, put, path):
    _three_files(put)
    to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint", finish=True)
    # Without its completion mark the batch counts as unfinished and runs again.
    for name in ("0", ".0.crc"):
        os.rename(f"{path}/checkpoint/commits/{name}", f"{path}/moved-{name}")
    to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint", finish=True)
    assert VersionedTable(spark, f"{path}/table").read().count() == 4


def test_a_new_checkpoint_is_a_new_query(spark, put, path):
    _three_files(put)
    for _ in range(2):
        to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint", finish=True)
    assert VersionedTable(spark, f"{path}/table").read().count() == 4
    os.rename(f"{path}/checkpoint", f"{path}/checkpoint-before")
    to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint", finish=True)
    assert VersionedTable(spark, f"{path}/table").read().count() == 8


def test_counts_need_complete_mode(spark, put, path, rows):
    _three_files(put)
    counts = json_folder(spark, f"{path}/in", DEVICE, max_files=1).groupBy("status").count()
    with pytest.raises(AnalysisException):
        to_versioned(counts, f"{path}/refused", f"{path}/checkpoint-a", finish=True)
    to_versioned(counts, f"{path}/counts", f"{path}/checkpoint-b", finish=True, output_mode="complete")
    assert rows(VersionedTable(spark, f"{path}/counts").read()) == [("off", 2), ("on", 2)]


def test_running_query_is_read_and_stopped(spark, put, path):
    put("a.json", ("d1", "on"))
    query = to_versioned(json_folder(spark, f"{path}/in", DEVICE), f"{path}/table", f"{path}/checkpoint")
    try:
        query.processAllAvailable()
        assert VersionedTable(spark, f"{path}/table").read().count() == 1
        put("b.json", ("d2", "on"))
        end = time.time() + 60
        while VersionedTable(spark, f"{path}/table").read().count() < 2 and time.time() < end:
            time.sleep(0.2)
        assert VersionedTable(spark, f"{path}/table").read().count() == 2
    finally:
        query.stop()
    assert not query.isActive


def test_console_sink_starts_and_stops(spark, put, path):
    put("a.json", ("d1", "on"))
    query = to_console(json_folder(spark, f"{path}/in", DEVICE))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def _followed(spark, table, path, **options):
    to_parquet(table.read_stream(**options), f"{path}/out", f"{path}/checkpoint", finish=True)
    return [r.device for r in spark.read.parquet(f"{path}/out").orderBy("device").collect()]


def _table(spark, path):
    return VersionedTable.create(spark.createDataFrame([("a", "on")], DEVICE), f"{path}/table")


def _one(spark, device):
    return spark.createDataFrame([(device, "on")], DEVICE)


def test_following_appends(spark, path):
    table = _table(spark, path)
    assert _followed(spark, table, path, since=0) == ["a"]
    table.append(_one(spark, "b"))
    table.append(_one(spark, "c"))
    assert _followed(spark, table, path, since=0) == ["a", "b", "c"]


def test_starting_at_a_later_version_takes_its_content(spark, path):
    table = _table(spark, path)
    table.update("device = 'a'", {"device": "'a2'"})
    table.append(_one(spark, "b"))
    assert _followed(spark, table, path) == ["a2", "b"]


def test_rewritten_rows_stop_the_stream_or_come_again(spark, path):
    table = _table(spark, path)
    _followed(spark, table, path, since=0)
    table.append(_one(spark, "b"))
    table.update("device = 'a'", {"device": "'a2'"})
    with pytest.raises(StreamingQueryException, match="rewritten"):
        _followed(spark, table, path, since=0)
    assert _followed(spark, table, path, since=0, ignore_changes=True) == ["a", "a2", "b"]


def test_uncommitted_data_is_not_followed(spark, path, monkeypatch):
    table = _table(spark, path)
    table._stage("append", _one(spark, "ghost"))
    assert _followed(spark, table, path, since=0) == ["a"]
