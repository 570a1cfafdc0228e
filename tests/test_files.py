"""CSV folders with files of several kinds."""

import pytest

from rastro.schemas import CATEGORY_TREE, EVENTS
from rastro.sources import files

COMMA = """timestamp,visitorid,event,itemid,transactionid
1433221332117,1,view,10,
1433221334000,1,transaction,10,7
"""
SEMICOLON = """visitorid;timestamp;event;extra;itemid;transactionid
2;1,43322E+12;view;x;11;
"""
REORDERED = """\ufeff"visitorid",itemid,event,transactionid,timestamp
3,12,addtocart,,1433221339000
3,oops,view,,1433221340000
"""


@pytest.fixture
def folder(tmp_path):
    for name, text in (("a.csv", COMMA), ("b.csv", SEMICOLON), ("c.csv", REORDERED), ("d.csv", "")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


WANT = [
    (1, 1433221332117, "view", 10.0, None),
    (1, 1433221334000, "transaction", 10.0, 7.0),
    (2, 1433220000000, "view", 11.0, None),
    (3, 1433221339000, "addtocart", 12.0, None),
    (3, 1433221340000, "view", None, None),
]
COLUMNS = ("visitorid", "timestamp", "event", "itemid", "transactionid")


def test_every_file_has_its_own_separator_and_order(spark, folder):
    table = files.read_events(spark, folder)
    assert table.schema == EVENTS
    got = sorted(tuple(r[c] for c in COLUMNS) for r in table.collect())
    assert got == WANT


def test_malformed_rows_are_counted(spark, folder):
    assert tuple(files.count_malformed(spark, folder).first()) == (5, 1)


def test_missing_columns_and_empty_sources_are_errors(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="categoryid"):
        files._read_csv(spark, (folder,), CATEGORY_TREE)
    with pytest.raises(ValueError, match="both kinds"):
        files.detect_separator(spark, folder)
    assert files.detect_separator(spark, f"{folder}/b.csv") == ";"
    with pytest.raises(ValueError, match="no lines"):
        files.read_events(spark, f"{folder}/d.csv")


def test_first_lines_of_files_of_many_parts(spark, tmp_path):
    """A split that begins inside a file gives no line."""
    path = tmp_path / "long.csv"
    path.write_text("a;b;c\n" + "1,2,3\n" * 50_000)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    lines = files.first_lines(session, str(path)).collect()
    assert [r.linea for r in lines] == ["a;b;c"]


def test_what_is_read_of_a_file_does_not_grow_with_it(spark, tmp_path):
    """Bytes that this process reads from files for the header of a small and of a large one."""
    jvm = spark._jvm

    def bytes_read(name, rows):
        path = tmp_path / name
        path.write_text("a;b;c\n" + "1,2,3 and some more text\n" * rows)
        scheme = jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
        before = scheme.getLong("bytesRead") or 0
        assert [r.linea for r in files.first_lines(spark, str(path)).collect()] == ["a;b;c"]
        return scheme.getLong("bytesRead") - before

    small, large = bytes_read("small.csv", 1_000), bytes_read("large.csv", 1_000_000)
    assert small > 0
    assert large < 200_000 < (tmp_path / "large.csv").stat().st_size // 100


def test_compressed_files_and_odd_names(spark, tmp_path):
    import gzip

    (tmp_path / "a b%20c.csv").write_text("x;y\n1;2\n")
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"x;y\n3;4\n"))
    lines = files.first_lines(spark, str(tmp_path)).collect()
    assert sorted(r.linea for r in lines) == ["x;y", "x;y"]
    assert spark.read.text([r.archivo for r in lines]).count() == 4


def test_a_folder_of_large_and_small_files(spark, tmp_path):
    for k in range(12):
        (tmp_path / f"{k}.csv").write_text(f"a,b{k}\n" + "1,2\n" * (10 ** (k % 6)))
    lines = {r.linea for r in files.first_lines(spark, str(tmp_path)).collect()}
    assert lines == {f"a,b{k}" for k in range(12)}
