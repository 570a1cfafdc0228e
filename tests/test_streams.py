"""Streams: late copies, late rows, restarts, windows that close."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rastro.operators import clean as cl
from rastro.schemas import EVENTS
from rastro.streaming import events as st

HOUR = 3_600_000


def rows(hours, kind="view", user=1):
    return [(h * HOUR + 1, user, kind, float(h + 1), None) for h in hours]


@pytest.fixture
def arriving(spark, tmp_path):
    """Adds a file to the landing folder and runs the stream over what has arrived."""

    class Arriving:
        def __init__(self):
            self.landing, self.out = str(tmp_path / "landing"), str(tmp_path / "out")
            self.checkpoint = str(tmp_path / "checkpoint")

        def deliver(self, events):
            spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(self.landing)

        def run(self, of, files=None):
            return st.write_available(of(st.stream_events(spark, self.landing, files)), self.out, self.checkpoint)

        def batch(self):
            return cl.clean_events(spark.read.schema(EVENTS).parquet(self.landing))

    return Arriving()


def kept(spark, arriving):
    return sorted(map(tuple, spark.read.parquet(arriving.out).select(*EVENTS.fieldNames()).collect()), key=str)


def test_a_late_copy_is_no_second_row(spark, arriving):
    clean = lambda s: st.clean_stream(s, "3 hours")
    arriving.deliver(rows([0, 1, 2]) + rows([1]) + rows([2], "other") + [(5, None, "view", 1.0, None)])
    arriving.run(clean)
    arriving.deliver(rows([2, 3]))
    arriving.run(clean)
    assert kept(spark, arriving) == sorted(map(tuple, arriving.batch().collect()), key=str)
    assert len(kept(spark, arriving)) == 4


def test_a_run_goes_on_from_its_checkpoint(spark, arriving):
    clean = lambda s: st.clean_stream(s, "3 hours")
    arriving.deliver(rows(range(4)))
    assert arriving.run(clean).rows_in == 4
    assert arriving.run(clean).rows_in == 0
    arriving.deliver(rows([3, 4, 5]))
    assert arriving.run(clean).rows_in == 3
    assert kept(spark, arriving) == sorted(map(tuple, arriving.batch().collect()), key=str)


def test_a_batch_that_was_not_committed_is_read_again(spark, arriving):
    """The commit of the last batch is lost, as if the driver had died before it."""
    import os

    clean = lambda s: st.clean_stream(s, "3 hours")
    arriving.deliver(rows(range(4)))
    arriving.run(clean)
    arriving.deliver(rows([3, 4, 5]))
    arriving.run(clean)
    commits = f"{arriving.checkpoint}/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(f"{commits}/{last}")
    crc = f"{commits}/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    arriving.run(clean)
    assert kept(spark, arriving) == sorted(map(tuple, arriving.batch().collect()), key=str)


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, arriving):
    clean = lambda s: st.clean_stream(s, "1 hour")
    arriving.deliver(rows([10]))
    assert arriving.run(clean).late == 0
    arriving.deliver(rows([2, 3]) + rows([10]) + rows([11]))
    assert arriving.run(clean).late == 2
    assert [r[3] for r in kept(spark, arriving)] == [11, 12]


def test_windows_are_written_once_when_closed(spark, arriving):
    counts = lambda s: st.hourly_counts(st.clean_stream(s, "1 hour"))
    arriving.deliver(rows([0, 1]) + rows([1], "transaction") + rows([1], user=2))
    first = arriving.run(counts)
    whole = {tuple(r) for r in st.all_counts(spark, first).collect()}
    at = lambda h: datetime(1970, 1, 1) + timedelta(hours=h)
    expected = {(at(0), at(1), "view", 1), (at(1), at(2), "view", 2), (at(1), at(2), "transaction", 1)}
    assert whole == expected
    arriving.deliver(rows([5]))
    second = arriving.run(counts)
    closed = {tuple(r) for r in spark.read.parquet(arriving.out).collect()}
    assert closed == expected
    assert {tuple(r) for r in st.all_counts(spark, second).collect()} == expected | {(at(5), at(6), "view", 1)}
    arriving.deliver(rows([0], user=9))
    third = arriving.run(counts)
    assert third.late == 1
    assert {tuple(r) for r in st.all_counts(spark, third).collect()} == expected | {(at(5), at(6), "view", 1)}


def test_counts_in_small_batches_equal_the_batch(spark, arriving):
    for start in range(0, 40, 5):
        arriving.deliver(rows(range(start, start + 5)) + rows(range(max(0, start - 3), start + 2), "addtocart"))
    done = arriving.run(lambda s: st.hourly_counts(st.clean_stream(s, "12 hours")), files=1)
    assert done.late == 0
    expected = (
        arriving.batch()
        .groupBy(F.window(F.timestamp_millis("timestamp"), "1 hour").alias("w"), "event")
        .count()
        .select("w.start", "w.end", "event", "count")
    )
    assert sorted(map(tuple, st.all_counts(spark, done).collect())) == sorted(map(tuple, expected.collect()))


def test_rows_without_a_timestamp_and_empty_deliveries(spark, arriving):
    arriving.deliver([])
    arriving.deliver([(None, 1, "view", 1.0, None), *rows([1])])
    done = arriving.run(lambda s: st.clean_stream(s, "1 hour"))
    assert len(kept(spark, arriving)) == 1 and done.late == 0
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
