from pyspark.sql import types as T

from cartsight.operators.features import online_features, parse_lines, stream_features, typed_fields
from cartsight.operators.split import split_exact_halves
from cartsight.schema import KEY, KEYED_SCHEMA, SESSION_FIELDS, SESSION_SCHEMA
from cartsight.sources import (
    read_sessions, repartitioned, session_lines, shop_sessions, union_slices, write_slices,
)

FOLDER = "/root/testdata/sf0.001"
FULL = "1,2.0,0,0.0,3,9.0,0.1,0.2,5.5,0.0,June,2,4,1,3,New_Visitor,True,False"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_shop_sessions(spark):
    sessions = shop_sessions(spark, FOLDER)
    assert [(f.name, f.dataType) for f in sessions.schema] == [(f.name, f.dataType) for f in KEYED_SCHEMA]
    assert sessions.count() == sessions.select(KEY).distinct().count() == 1473
    assert sessions.where("Revenue").count() == 436


def test_slices_round_trip(spark, tmp_path):
    sessions = shop_sessions(spark, FOLDER)
    path = str(tmp_path / "slices")
    write_slices(split_exact_halves(sessions), path)
    first, second = (read_sessions(spark, f"{path}/slice={i}/*.csv", KEYED_SCHEMA) for i in (1, 2))
    assert (first.count(), second.count()) == (736, 737)
    both = read_sessions(spark, [f"{path}/slice=1/*.csv", f"{path}/slice=2/*.csv"], KEYED_SCHEMA, view="both")
    assert rows(both) == rows(sessions) == rows(union_slices(first, second)) == rows(spark.table("both"))
    assert rows(repartitioned(both, 3)) == rows(both)
    assert repartitioned(both, 3).rdd.getNumPartitions() == 3


def test_written_flags_are_the_texts_the_stream_expects(spark, tmp_path):
    path = str(tmp_path / "slices")
    write_slices(split_exact_halves(shop_sessions(spark, FOLDER)), path)
    raw = read_sessions(spark, f"{path}/slice=1", T.StructType(
        [T.StructField(KEY, T.LongType()), *(T.StructField(n, T.StringType()) for n in SESSION_FIELDS)]
    ))
    assert {r[0] for r in raw.select("Weekend").distinct().collect()} == {"True", "False"}


def test_inferred_types(spark, tmp_path):
    path = str(tmp_path / "csv")
    shop_sessions(spark, FOLDER).drop(KEY).write.option("header", True).csv(path)
    inferred = read_sessions(spark, path, schema=None)
    assert [(f.name, f.dataType) for f in inferred.schema] == [(f.name, f.dataType) for f in SESSION_SCHEMA]


def test_line_edges(spark):
    fields = FULL.split(",")
    garbage = fields.copy()
    garbage[6], garbage[11], garbage[0] = "x", "n/a", ""
    lines = {
        "full": FULL,
        "short": ",".join(fields[:17]),
        "long": FULL + ",extra",
        "empty": "",
        "garbage": ",".join(garbage),
        "lower": FULL.replace("True", "true"),
        "upper": FULL.replace("True", "TRUE"),
    }
    df = spark.createDataFrame(list(lines.items()), "session_id STRING, value STRING")
    everything = {r[KEY]: r for r in typed_fields(parse_lines(df, complete_only=False)).collect()}
    assert set(everything) == set(lines)
    assert everything["short"]["Revenue"] is None and everything["empty"]["Month"] is None
    garbled = everything["garbage"]
    assert (garbled["Administrative"], garbled["BounceRates"], garbled["OperatingSystems"]) == (None, None, None)

    stream = {r[KEY]: r for r in stream_features(parse_lines(df)).collect()}
    assert set(stream) == set(lines) - {"short", "empty"}
    assert [stream[k]["Weekend"] for k in ("full", "long", "lower", "upper")] == [1, 1, 0, 0]
    assert stream["garbage"]["Administrative_Duration_Per_Visit"] == 0.0
    assert stream["garbage"]["OperatingSystems"] == "OS_Other"

    online = {r[KEY]: r for r in online_features(parse_lines(df)).collect()}
    assert online["garbage"]["BounceRates"] == 0.0 and online["garbage"]["OS_is_2"] == 0.0
    assert tuple(online["full"])[1:] == (0.0, 2.0, 3.0, 0.1, 0.2, 5.5, 0.0, 1.0, 0.0, 1.0, 1.0, 1.0)


def test_lines_are_18_fields(spark):
    lines = session_lines(shop_sessions(spark, FOLDER))
    assert {len(r["value"].split(",")) for r in lines.collect()} == {18}
