import csv
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.sources.csv import CSV_LOAD, count_csv_rows, read_csv, write_csv
from layerkit.sources.records import OpenQuoteError, csv_records

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("at", T.TimestampNTZType())])


def load(spark, tmp_path, text, **kw):
    (tmp_path / "f.csv").write_text(text)
    return [tuple(r) for r in read_csv(spark, str(tmp_path / "f.csv"), SCHEMA, **kw).collect()]


def test_nulls_quotes_and_positions(spark, tmp_path):
    text = 'ID,Other,AT\n1,,2003-07-01\n2,"",\n3, x ,\n,"a, ""b""",\n'
    rows = load(spark, tmp_path, text)
    assert [r[:2] for r in rows] == [(1, None), (2, ""), (3, " x "), (None, 'a, "b"')]
    assert rows[0][2].year == 2003 and rows[1][2] is None


@pytest.mark.parametrize("line", ["x,a,", "1,a", "1,a,,extra", "1,a,notadate"])
def test_bad_cell_fails_the_load(spark, tmp_path, line):
    with pytest.raises(Exception, match="(?i)malformed"):
        load(spark, tmp_path, f"id,name,at\n{line}\n")


def test_line_break_in_cell(spark, tmp_path):
    assert load(spark, tmp_path, 'id,name,at\n1,"a\nb",\n', multi_line=True) == [(1, "a\nb", None)]


def test_round_trip(spark, tmp_path):
    rows = [(1, None, None), (2, "", None), (3, ' q "x", y\\ ', None), (None, "n/a", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    write_csv(df, str(tmp_path / "out"))
    got = read_csv(spark, str(tmp_path / "out"), SCHEMA).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_row_counter_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"x\ny"\nz\n')
    (tmp_path / "b.csv").write_text("h\n")
    got = {r.file: r.n for r in count_csv_rows(spark, str(tmp_path), multi_line=True).collect()}
    assert got == {"a.csv": 2, "b.csv": 0}


def one_task(spark, path, schema):
    return spark.read.options(**CSV_LOAD).option("multiLine", "true").schema(schema).csv(path)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_files_equal_the_reader_of_one_task(spark, tmp_path, small_ranges, end):
    schema = T.StructType([T.StructField("a b", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("c", T.StringType())])
    rng = random.Random(len(end))
    for name in ("x y", "z"):
        cells = lambda: rng.choice(["", '""', "plain", '"' + "".join(rng.choice(['""', end, "é,", "w"]) for _ in range(rng.randint(0, 30))) + '"'])
        lines = ['"head' + end + 'er",n,c'] + [f"{cells()},{i},{cells()}" for i in range(120)]
        lines.insert(50, "")
        # a record longer than several ranges
        lines.insert(60, '"' + ("long" + end) * 200 + '",7,')
        (tmp_path / f"{name}.csv").write_bytes(end.join(lines + [""] * (name == "z")).encode())
    bag = lambda rows: Counter((a and a.replace("\r\n", "\n"), n, c and c.replace("\r\n", "\n")) for a, n, c in rows)
    got = [tuple(r) for r in read_csv(spark, str(tmp_path), schema, multi_line=True).collect()]
    want = one_task(spark, str(tmp_path), schema).collect()
    assert bag(got) == bag(want) and len(got) == 242
    # that reader turns \r\n in cells into \n; here cells stay as they are
    cells = [r for f in tmp_path.glob("*.csv") for r in list(csv.reader(io.StringIO(f.read_bytes().decode(), newline="")))[1:] if r]
    assert Counter((a or "", str(n), c or "") for a, n, c in got) == Counter(map(tuple, cells))
    counts = {r.file: r.n for r in count_csv_rows(spark, str(tmp_path), multi_line=True).collect()}
    assert counts == {"x y.csv": 121, "z.csv": 121}
    # one file is read by many tasks
    tasks = csv_records(spark, str(tmp_path / "z.csv")).where("NOT header").select(F.spark_partition_id()).distinct().count()
    assert tasks > 10


def test_open_quote_and_bad_cells_fail(spark, tmp_path):
    with pytest.raises(OpenQuoteError):
        load(spark, tmp_path, 'id,name,at\n1,"a\nb,\n', multi_line=True)
    with pytest.raises(Exception, match="(?i)malformed"):
        load(spark, tmp_path, 'id,name,at\nx,"a\nb",\n', multi_line=True)
    assert load(spark, tmp_path, "", multi_line=True) == [] and load(spark, tmp_path, "id,name,at\n", multi_line=True) == []
