from datetime import datetime

import pytest

from rastro.operators import aggregate as ag
from rastro.operators import clean as cl
from rastro.operators import transform as tr
from rastro.schemas import EVENTS
from rastro.sources import files, sinks

COMMA = """timestamp,visitorid,event,itemid,transactionid
1433221332117,1,view,10,
1433221332117,1,view,10,
1433221333000,1,addtocart,10,
1433221334000,1,transaction,10,7
1433221335000,2,view,,
1433221336000,,view,11,
1433221337000,2,signup,11,
1433221338000,2,view,11,
"""


@pytest.fixture
def comma_file(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(COMMA)
    return str(path)


def test_cleaning_keeps_the_right_rows(spark, comma_file, as_rows):
    raw = files.read_events(spark, comma_file)
    assert raw.count() == 8
    clean = cl.clean_events(raw)
    assert as_rows(clean) == [
        (1433221332117, 1, "view", 10, None),
        (1433221333000, 1, "addtocart", 10, None),
        (1433221334000, 1, "transaction", 10, 7.0),
        (1433221338000, 2, "view", 11, None),
    ]
    assert clean.schema["itemid"].dataType.simpleString() == "bigint"


def test_reports(spark, comma_file, as_rows):
    raw = files.read_events(spark, comma_file)
    assert as_rows(cl.cleaning_report(raw)) == [(8, 4, 4, 50.0)]
    assert as_rows(cl.quality_report(raw)) == [(8, 7, 4, 0.875, False)]


def test_reports_of_an_empty_log(spark, as_rows):
    empty = spark.createDataFrame([], EVENTS)
    assert as_rows(cl.cleaning_report(empty)) == [(0, 0, 0, 0.0)]
    assert as_rows(cl.quality_report(empty))[0][4] is False


def test_user_features(spark, comma_file, as_rows):
    events = tr.transform_events(cl.clean_events(files.read_events(spark, comma_file)))
    columns = ["visitorid", *ag.FEATURE_COLUMNS]
    assert as_rows(ag.user_features(events), *columns) == [
        (1, 3, 1, 9, 1, 1, 1),
        (2, 1, 1, 1, 1, 0, 0),
    ]


def test_default_weight(spark, as_rows):
    df = spark.createDataFrame([("view",), ("other",), (None,)], "event string")
    assert as_rows(tr.add_weight(df), "peso_implicito") == [(1,), (1,), (1,)]


@pytest.mark.parametrize("copies, alert", [(10, True), (4, False)])
def test_alert_for_lost_precision(spark, tmp_path, as_rows, copies, alert):
    lines = ["timestamp;visitorid;event;itemid;transactionid"]
    distinct = 200 - copies
    lines += [f"1,43322E+12;{i};view;{i};" for i in range(distinct)]
    lines += [f"1,43322E+12;{i};view;{i};" for i in range(copies)]
    path = tmp_path / "sheet.csv"
    path.write_text("\n".join(lines) + "\n")
    assert files.detect_separator(spark, str(path)) == ";"
    raw = files.read_events(spark, str(path))
    assert raw.select("timestamp").distinct().collect()[0][0] == 1433220000000
    report = cl.quality_report(raw).first()
    assert (report.filas, report.ts_unicos, report.eliminadas) == (200, 1, copies)
    assert report.alerta is alert


def test_times(spark, as_rows):
    # A Tuesday, a Sunday, a Monday and an instant before the epoch.
    df = spark.createDataFrame(
        [(1433220000000,), (1433030400000,), (1433116800000,), (-1,)], "timestamp bigint"
    )
    got = tr.add_hour_weekday(tr.add_datetime(df)).collect()
    assert [r.fecha for r in got[:2]] == [datetime(2015, 6, 2, 4, 40), datetime(2015, 5, 31)]
    assert [r.hora_del_dia for r in got] == [4, 0, 0, 23]
    assert [r.dia_semana for r in got] == [2, 7, 1, 3]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1433220000000,)], "timestamp bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Lima")
        row = tr.add_hour_weekday(tr.add_datetime(df)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.fecha, row.hora_del_dia, row.dia_semana) == (datetime(2015, 6, 2, 4, 40), 4, 2)


def test_mixed_files_and_fallback(spark, tmp_path, comma_file):
    sheet = tmp_path / "other.csv"
    sheet.write_text("timestamp;visitorid;event;itemid;transactionid\n1,43322E+12;9;view;3;\n")
    both = files.read_events(spark, comma_file, str(sheet))
    assert both.count() == 9
    missing = str(tmp_path / "missing.csv")
    assert files.resolve_path(spark, missing, str(sheet)) == str(sheet)
    with pytest.raises(FileNotFoundError):
        files.resolve_path(spark, missing, missing + "2")


def test_category_tree_takes_a_root_first(spark, as_rows):
    df = spark.createDataFrame([(1, 5), (1, 3), (2, None), (2, 9)], "categoryid long, parentid long")
    assert as_rows(cl.clean_category_tree(df)) == [(1, 3), (2, None)]


def test_weekday_folders_are_pruned(spark, tmp_path, comma_file):
    events = tr.transform_events(cl.clean_events(files.read_events(spark, comma_file)))
    path = sinks.write_events(events, str(tmp_path / "out"))
    back = spark.read.parquet(path).filter("dia_semana = 2")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia_semana" in plan
    assert back.count() == 4


def test_filters_reach_the_scan(spark, tmp_path, comma_file):
    path = sinks.write_table(files.read_events(spark, comma_file), str(tmp_path / "raw"))
    plan = cl.clean_events(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "In(event, [addtocart,transaction,view])" in plan
    assert "IsNotNull(itemid)" in plan and "IsNotNull(visitorid)" in plan
