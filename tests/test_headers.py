"""CSV columns are found by name."""

import gzip

import pytest

from cartsight.schema import KEY, KEYED_SCHEMA, SESSION_SCHEMA
from cartsight.sources import read_sessions, shop_sessions
from cartsight.sources.headers import read_csv_by_name, reconciled

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "a int, b double, c string"


def schema(spark, ddl=SCHEMA):
    return spark.createDataFrame([], ddl).schema


def files(folder, **texts):
    folder.mkdir(exist_ok=True, parents=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_orders_per_file(spark, tmp_path):
    path = files(tmp_path / "x", one="a,b,c\n1,1.5,x\n", two="c,a,b\ny,2,2.5\n", three='"b","c","a"\n3.5,z,3\n', empty="", only="a,b,c\n")
    assert rows(read_csv_by_name(spark, path, schema(spark))) == [(1, 1.5, "x"), (2, 2.5, "y"), (3, 3.5, "z")]
    with gzip.open(tmp_path / "x" / "four.csv.gz", "wt") as out:
        out.write("﻿c,b,a\nw,4.5,4\n")
    assert (4, 4.5, "w") in rows(read_csv_by_name(spark, path, schema(spark)))


def test_swapped_columns_of_records(spark, tmp_path):
    sessions = shop_sessions(spark, FOLDER)
    names = sessions.columns
    i, j = names.index("BounceRates"), names.index("ExitRates")
    names[i], names[j] = names[j], names[i]
    sessions.select(*names).write.option("header", True).csv(str(tmp_path / "s"))
    got = read_sessions(spark, str(tmp_path / "s"), KEYED_SCHEMA)
    assert got.columns == KEYED_SCHEMA.names and rows(got) == rows(sessions)


def test_faults_name_file_and_columns(spark, tmp_path):
    for name, text, fault in (("m", "a,c\n1,x\n", "missing: b"), ("f", "a,b,c,d\n1,2,x,4\n", "unknown: d"), ("r", "a,b,b,c\n1,2,2,x\n", "repeated: b")):
        path = files(tmp_path / name, good="a,b,c\n1,1.5,x\n", bad=text)
        with pytest.raises(ValueError, match=f"bad.csv.*{fault}"):
            read_csv_by_name(spark, path, schema(spark))


def test_optional_key(spark, tmp_path):
    sessions = shop_sessions(spark, FOLDER).limit(5)
    with_key, without = str(tmp_path / "k"), str(tmp_path / "n")
    sessions.write.option("header", True).csv(with_key)
    sessions.drop(KEY).write.option("header", True).csv(without)
    assert read_sessions(spark, with_key, KEYED_SCHEMA, optional=[KEY]).columns == KEYED_SCHEMA.names
    assert read_sessions(spark, without, KEYED_SCHEMA, optional=[KEY]).columns == SESSION_SCHEMA.names
    with pytest.raises(ValueError, match="but not in"):
        read_sessions(spark, [with_key, without], KEYED_SCHEMA, optional=[KEY])
    with pytest.raises(ValueError, match="unknown: session_id"):
        read_sessions(spark, with_key, SESSION_SCHEMA)


@pytest.mark.parametrize("second", ["a,b\n2,2.5\n", "b,a\n2.5,2\n"])
def test_folder_columns(spark, tmp_path, second):
    files(tmp_path / "p" / "part=1", x="a,b\n1,1.5\n")
    files(tmp_path / "p" / "part=2", x=second)
    got = read_csv_by_name(spark, str(tmp_path / "p"), schema(spark, "a int, b double, part int"))
    assert rows(got) == [(1, 1.5, 1), (2, 2.5, 2)]
    assert rows(read_csv_by_name(spark, [str(tmp_path / "p" / "part=1"), str(tmp_path / "p" / "part=2")], schema(spark, "b double, a int"))) == [(1.5, 1), (2.5, 2)]


def test_no_rows(spark, tmp_path):
    assert rows(read_csv_by_name(spark, files(tmp_path / "e", x=""), schema(spark))) == []


def test_reconciled():
    assert reconciled({"f": ("b", "a")}, ["a", "b", "k"], ["k"]) == ["a", "b"]
    assert reconciled({"f": ("k", "b", "a")}, ["a", "b", "k"], ["k"]) == ["a", "b", "k"]
