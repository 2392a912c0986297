import gzip
from types import SimpleNamespace

import pytest

from tarmac.checks.fixtures import flights_raw
from tarmac.session import fresh_folder, materialize, shared_folder, spread
from tarmac.sources.files import read_csv, scan_lines, stream_lines, to_lines, write_csv
from tarmac.sources.headers import headers, read_csv_by_name


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "t.csv").write_text('A,B,C\n1,,"x,y"\n2,b,z\n')
    return str(tmp_path)


def test_csv_is_all_text_and_empty_is_null(spark, csv):
    df = read_csv(spark, csv)
    assert df.dtypes == [("A", "string"), ("B", "string"), ("C", "string")]
    assert sorted(map(tuple, df.collect())) == [("1", None, "x,y"), ("2", "b", "z")]


def test_csv_schema_is_checked_against_the_header(spark, csv):
    assert read_csv(spark, csv, read_csv(spark, csv).schema).count() == 2
    wrong = read_csv(spark, csv, spark.createDataFrame([], "B string, A string, C string").schema)
    with pytest.raises(Exception, match="CSV header"):
        wrong.collect()


def test_csv_reads_only_the_columns_asked_for(spark, csv, plan):
    assert "ReadSchema: struct<B:string>" in plan(read_csv(spark, csv).select("B"))


def test_lines_skip_one_header_per_file(spark, tmp_path):
    for name, body in (("a", "1,2\n3,4\n"), ("b", "5,6\n"), ("c", "")):
        (tmp_path / f"{name}.csv").write_text("X,Y\n" + body)
    assert sorted(r[0] for r in scan_lines(spark, str(tmp_path)).collect()) == ["1,2", "3,4", "5,6"]


def test_lines_skip_the_first_line_whatever_it_says(spark, tmp_path):
    """Headers that differ between files go; a later line that equals a header stays; quotes stay as they are."""
    (tmp_path / "a.csv").write_text('X,Y\n1,"a, ""b"""\nX,Y\n')
    (tmp_path / "b.csv").write_text("x,y\n3,4\\\n")
    expected = sorted(['1,"a, ""b"""', "X,Y", "3,4\\"])
    assert sorted(r[0] for r in scan_lines(spark, str(tmp_path)).collect()) == expected
    query = stream_lines(spark, str(tmp_path), 1).writeStream.format("memory").queryName("streamed_lines")
    query.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r[0] for r in spark.table("streamed_lines").collect()) == expected


def test_reordered_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,A\n2,1\n")
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path)).collect()


def test_csv_with_a_very_wide_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2" + "," * 21_000 + "\n3,4\n")
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path)).collect()) == [("1", "2"), ("3", "4")]


def test_lines_of_an_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert scan_lines(spark, str(tmp_path)).count() == 0


def test_written_csv_gives_its_lines_back(spark, sf, tmp_path):
    raw = flights_raw(spark, sf)
    write_csv(raw, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"))
    assert sorted(to_lines(back).collect()) == sorted(scan_lines(spark, str(tmp_path / "out")).collect())
    assert back.where("PLANE_AGE = ''").count() == 0 and back.count() == raw.count()


def test_shared_folder_follows_the_session(spark):
    folder = shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder == shared_folder(spark) == named.rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert fresh_folder(spark, "x").startswith(folder)


class _Session:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf = SimpleNamespace(get=lambda key, default: default)
        self.folder = None
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: self.folder, setCheckpointDir=self._set
        )

    def _set(self, folder):
        self.folder = folder


def test_only_a_local_session_may_go_without_a_shared_folder():
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077"))


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS s")
    stored = materialize(df, "test")
    assert stored.schema.simpleString() == df.schema.simpleString() and sorted(stored.collect()) == sorted(df.collect())


def test_spread_leaves_a_well_split_input_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 2 * cores)
    assert spread(many) is many
    assert spread(spark.range(0, 1000, 1, 1)).rdd.getNumPartitions() == cores


@pytest.fixture
def mixed(tmp_path):
    """Files with their columns in different orders, extra and repeated ones, odd names and forms."""
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text('x,y,z\n1,2,3\n4,"5,5",\n')
    (folder / "b [1]%20.csv").write_text("z,x,y\n30,10,20\n")
    (folder / "c.csv").write_text('y,x,w,y\n200,100,w,no\n')
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text('\ufeff"x",y,z\n7,8,9\n')
    (folder / "f.csv.gz").write_bytes(gzip.compress(b"z,x,y\n31,11,21\n"))
    (folder / "g.csv").write_text("x,y,z")
    return str(folder)


def test_census_of_headers(spark, mixed):
    found = {r["file"].rsplit("/", 1)[1]: r["header"] for r in headers(spark, mixed).collect()}
    assert found == {
        "a.csv": ["x", "y", "z"], "b [1]%20.csv": ["z", "x", "y"], "c.csv": ["y", "x", "w", "y"],
        "e.csv": ["x", "y", "z"], "f.csv.gz": ["z", "x", "y"], "g.csv": ["x", "y", "z"],
    }


def test_columns_are_taken_by_name(spark, mixed):
    found = read_csv_by_name(spark, mixed, ["x", "y"])
    expected = [("1", "2"), ("4", "5,5"), ("10", "20"), ("100", "200"), ("7", "8"), ("11", "21")]
    assert found.columns == ["x", "y"] and sorted(map(tuple, found.collect())) == sorted(expected)
    everything = read_csv_by_name(spark, mixed)
    assert everything.columns == ["x", "y", "z", "w"]
    rows = {r["x"]: (r["y"], r["z"], r["w"]) for r in everything.collect()}
    assert rows["100"] == ("200", None, "w") and rows["4"] == ("5,5", None, None) and rows["10"] == ("20", "30", None)


def test_a_missing_column_is_named(spark, mixed, tmp_path):
    with pytest.raises(ValueError, match=r"c\.csv has no column z"):
        read_csv_by_name(spark, mixed, ["x", "z"])
    (tmp_path / "none").mkdir()
    assert read_csv_by_name(spark, str(tmp_path / "none"), ["x"]).count() == 0


def test_one_scan_for_each_header(spark, tmp_path, plan):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text("x,y\n1,2\n" if i % 2 else "y,x\n2,1\n")
    found = read_csv_by_name(spark, str(tmp_path), ["x", "y"])
    assert plan(found).count("FileScan") == 2 and found.distinct().collect() == [("1", "2")]
