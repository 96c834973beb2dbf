import datetime as dt

from firnspark.sources import storage
from firnspark.sources.storage import read_table, replace_partitions


def contents(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("day", "region", "v").collect())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "day string, region string, v long")


def test_replace_keeps_others_and_clears_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    keys, folders = ["day", "region"], ["day"]
    assert read_table(spark, path) is None
    first = frame(spark, ("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3), ("d3", "a", 4))
    replace_partitions(first, path, first.select(*keys), keys, folders)
    assert len(contents(spark, path)) == 4
    # d1/a gets a new row, d2/a and d1/c are requested but give none, d3 is untouched.
    request = frame(spark, ("d1", "a", 0), ("d2", "a", 0), ("d1", "c", 0)).select(*keys)
    replace_partitions(frame(spark, ("d1", "a", 10)), path, request, keys, folders)
    assert contents(spark, path) == [("d1", "a", 10), ("d1", "b", 2), ("d3", "a", 4)]
    assert not (tmp_path / "t" / "day=d2").exists()
    # Running the same replacement again changes nothing.
    replace_partitions(frame(spark, ("d1", "a", 10)), path, request, keys, folders)
    assert contents(spark, path) == [("d1", "a", 10), ("d1", "b", 2), ("d3", "a", 4)]


def test_rows_outside_the_request_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["day", "region"]
    first = frame(spark, ("d1", "a", 1))
    replace_partitions(first, path, first.select(*keys), keys, ["day"])
    replace_partitions(frame(spark, ("d2", "b", 2)), path, first.select(*keys), keys, ["day"])
    assert contents(spark, path) == [("d2", "b", 2)]


def test_names_of_object_stores():
    """The names Spark uses are understood; nothing is opened."""
    from pyarrow import fs

    from firnspark.sources.storage import open_store

    store, path = open_store("s3a://bucket/folder/x?region=eu-central-1")
    assert isinstance(store, fs.S3FileSystem) and path == "bucket/folder/x"
    assert open_store("file:///tmp/x")[1] == "/tmp/x"


def test_no_row_of_a_folder_replaced_as_a_whole_is_read(spark, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "table"), "center string, day date, value int"
    first = spark.createDataFrame([("a", dt.date(2023, 1, n), n) for n in (1, 2, 3)], columns)
    keys = ["center", "day"]
    storage.replace_partitions(first, path, first, keys, keys)

    def read(*_):
        raise AssertionError("rows are compared with the request")

    monkeypatch.setattr(storage, "lookup_join", read)
    new = spark.createDataFrame([("a", dt.date(2023, 1, 2), 20)], columns)
    requested = spark.createDataFrame([("a", dt.date(2023, 1, n)) for n in (1, 2)], "center string, day date")
    storage.replace_partitions(new, path, requested, keys, keys)
    assert sorted(row.value for row in spark.read.parquet(path).collect()) == [3, 20]
    # A folder that only the new rows name keeps its own.
    more = spark.createDataFrame([("a", dt.date(2023, 1, 3), 30)], columns)
    storage.replace_partitions(more, path, requested, keys, keys)
    assert sorted(row.value for row in spark.read.parquet(path).collect()) == [3, 30]
