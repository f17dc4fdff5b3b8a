import csv
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderloom.functions.text import ends_inside_quotes
from orderloom.sources.csv_read import read_csv, records


def as_pandas_reads(path):
    frame = pd.read_csv(path, dtype=str)
    return [
        tuple(None if isinstance(v, float) else v for v in row)
        for row in frame.itertuples(index=False)
    ]


def write(path, rows, **options):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, **{"lineterminator": "\n", **options}).writerows(rows)
    return str(path)


def ordered(rows):
    return sorted(map(repr, rows))


def random_text(rng):
    parts = ["a", "b c", ",", '"', '""', "\n", "\r\n", "\r", "NA", "é", '5" x', " ", "\n\n", '",', ',"']
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))


@pytest.mark.parametrize("split_bytes", ["128MB", "3000b", "40b"])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_free_text_agrees_with_pandas_wherever_files_are_split(
    spark, conf, tmp_path, split_bytes, line_end
):
    rng = random.Random(7)
    rows = [
        (n, random_text(rng), random_text(rng), rng.choice(["x", "01037", "NA", ""]))
        for n in range(400)
    ]
    header = ("id", "title", "message", "code")
    path = write(tmp_path / "t.csv", [header, *rows], lineterminator=line_end)
    conf(files__maxPartitionBytes=split_bytes, files__openCostInBytes="1b")
    df = read_csv(spark, path)
    assert df.columns == list(header)
    assert ordered(map(tuple, df.collect())) == ordered(as_pandas_reads(path))


def test_files_with_line_breaks_are_read_by_many_tasks(spark, conf, tmp_path):
    rows = [(n, f"one\ntwo {n}") for n in range(2000)]
    path = write(tmp_path / "t.csv", [("id", "text"), *rows])
    conf(files__maxPartitionBytes="4kb", files__openCostInBytes="1b")
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 5
    assert records(lines).count() == 2000


def test_record_longer_than_several_splits(spark, conf, tmp_path):
    text = "\n".join(f'line {n}, "quoted"' for n in range(200))
    path = write(tmp_path / "t.csv", [("id", "text"), (1, text), (2, "short")])
    conf(files__maxPartitionBytes="100b", files__openCostInBytes="1b")
    rows = {r.id: r.text for r in read_csv(spark, path).collect()}
    assert rows == {"1": text, "2": "short"}


def test_folder_of_files_with_headers(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write(folder / "a.csv", [("id", "text"), (1, "x\ny"), (2, "z")])
    write(folder / "b.csv", [("id", "text"), (3, "p"), (4, "q\n\nr")])
    rows = {r.id: r.text for r in read_csv(spark, str(folder)).collect()}
    assert rows == {"1": "x\ny", "2": "z", "3": "p", "4": "q\n\nr"}


@pytest.mark.parametrize("text", ["plain", "with\nbreak"])
def test_text_rules(spark, tmp_path, text):
    rows = [
        ("id", "text", "code"),
        ("1", text, "01037"),
        ("2", 'say "hi", twice', "NA"),
        ("3", "null", " kept "),
        ("4", "", "n/a"),
    ]
    path = write(tmp_path / "t.csv", rows)
    got = {r.id: (r.text, r.code) for r in read_csv(spark, path).collect()}
    assert got == {
        "1": (text, "01037"),
        "2": ('say "hi", twice', None),
        "3": (None, " kept "),
        "4": (None, None),
    }


@pytest.mark.parametrize("message", ["plain", '"with\nbreak"'])
def test_rows_of_other_length(spark, tmp_path, message):
    short = tmp_path / "short.csv"
    short.write_text(f"id,text,code\n1,{message},x\n2,only\n\n   \n3\n")
    got = {r.id: (r.text, r.code) for r in read_csv(spark, str(short)).collect()}
    assert got == {"1": (message.strip('"'), "x"), "2": ("only", None), "3": (None, None)}

    long = tmp_path / "long.csv"
    long.write_text(f"id,text,code\n1,{message},x\n2,a,b,c\n")
    with pytest.raises(Exception, match="more fields than the header"):
        read_csv(spark, str(long)).collect()


@pytest.mark.parametrize("message", ["plain", '"with\nbreak"'])
def test_byte_order_mark_and_quoted_header(spark, tmp_path, message):
    path = tmp_path / "t.csv"
    path.write_bytes(b"\xef\xbb\xbf" + f'"id","text"\n"1",{message}\n'.encode())
    df = read_csv(spark, str(path))
    assert df.columns == ["id", "text"]
    assert [tuple(r) for r in df.collect()] == [("1", message.strip('"'))]


def test_literal_quote_inside_an_unquoted_field(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,text\n1,5" pipe\n2,"a\nb"\n3,6" pipe, "\n'.replace(', "', ' "'))
    got = {r.id: r.text for r in read_csv(spark, str(path)).collect()}
    assert got == {"1": '5" pipe', "2": "a\nb", "3": '6" pipe "'}


@pytest.mark.parametrize("split_bytes", ["128MB", "20b"])
def test_quotes_that_never_close(spark, conf, tmp_path, split_bytes):
    path = tmp_path / "t.csv"
    path.write_text('id,text\n1,"a\nb"\n2,"open\n' + "3,x\n" * 50)
    conf(files__maxPartitionBytes=split_bytes, files__openCostInBytes="1b")
    with pytest.raises(Exception, match="quoted field without end"):
        read_csv(spark, str(path)).collect()


def test_carriage_returns(spark, tmp_path):
    quoted = tmp_path / "q.csv"
    quoted.write_bytes(b'id,text\r\n1,"a\rb"\r\n2,c\r\n')
    got = {r.id: r.text for r in read_csv(spark, str(quoted)).collect()}
    assert got == {"1": "a\rb", "2": "c"}
    bare = tmp_path / "b.csv"
    bare.write_bytes(b"id,text\n1,a\r2,b\n")
    with pytest.raises(Exception, match="carriage return"):
        read_csv(spark, str(bare)).collect()


def test_header_only_and_empty_files(spark, tmp_path):
    header_only = tmp_path / "t.csv"
    header_only.write_text("id,text\n")
    df = read_csv(spark, str(header_only))
    assert (df.columns, df.count()) == (["id", "text"], 0)
    empty = tmp_path / "e.csv"
    for text in ("", "\nid\n1\n"):
        empty.write_text(text)
        with pytest.raises(ValueError, match="header line"):
            read_csv(spark, str(empty))


@pytest.mark.parametrize(
    "line, inside",
    [
        ("a,b", False),
        ('a,"b"', False),
        ('a,"b', True),
        ('"a","b""c', True),
        ('a,"b""', True),
        ('a,"b"""', False),
        ('a"b,c', False),
        ('"', True),
        ('""', False),
        ('"a,""b"",c', True),
        ('"a"x,"b', True),
        ('x,"a" "b",c', False),
        ("", False),
        ('"' + "long text, " * 20_000, True),
        ('"' + 'two ""quoted"" words, ' * 20_000 + '"', False),
        ("a," * 20_000 + '"b"', False),
    ],
)
def test_ends_inside_quotes(spark, line, inside):
    df = spark.createDataFrame([(line,)], "line STRING")
    assert df.select(ends_inside_quotes(F.col("line"))).first()[0] is inside


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write(folder / "a.csv", [("order_id", "price", "note"), ("o1", "1", "x"), ("o2", "2", None)])
    write(folder / "b.csv", [("price", "note", "order_id"), ("7", "two\nlines", "o7")])
    write(folder / "c.csv", [("order_id", "price", "note"), ("o3", "3", "z")])
    (folder / "empty.csv").write_text("")
    df = read_csv(spark, str(folder))
    assert df.columns == ["order_id", "price", "note"]
    assert ordered(map(tuple, df.collect())) == ordered(
        [("o1", "1", "x"), ("o2", "2", None), ("o7", "7", "two\nlines"), ("o3", "3", "z")]
    )
    write(folder / "d.csv", [("order_id", "note"), ("o4", "n")])
    with pytest.raises(ValueError, match="other columns"):
        read_csv(spark, str(folder))


def test_repeated_names_get_numbers(spark, tmp_path):
    path = write(tmp_path / "t.csv", [("a", "b", "a", "a"), ("1", "2", "3", "4")])
    df = read_csv(spark, path)
    assert df.columns == ["a", "b", "a.1", "a.2"] == list(pd.read_csv(path).columns)
    assert tuple(df.first()) == ("1", "2", "3", "4")


@pytest.mark.parametrize("text", ["x", "two\nlines"])
def test_a_long_row_is_an_error_whatever_is_asked_for(spark, tmp_path, text):
    rows = [("a", "b"), ("1", text), ("2", "y", "surplus"), ("3",)]
    df = read_csv(spark, write(tmp_path / "t.csv", rows))
    for action in (df.collect, df.select("b").collect, df.select("a").collect, df.count):
        with pytest.raises(Exception, match="more fields than the header"):
            action()
    good = read_csv(spark, write(tmp_path / "u.csv", [r[:2] for r in rows]))
    assert good.count() == 3 and good.select("b").where("b is null").count() == 1
