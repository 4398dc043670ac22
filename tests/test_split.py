import pytest
from pyspark.sql import functions as F

from cartsight.operators import split
from cartsight.schema import KEY

PARTITIONS = [1, 3, 8]


def keys_frame(spark, keys, partitions):
    rows = [(int(k), f"v{k}") for k in keys]
    return spark.createDataFrame(rows, "session_id BIGINT, v STRING").repartition(partitions)


def hashed(k, seed=0):
    return (k % 2**32 + (k >> 32) * 1540483477 + seed) * 2654435761 % 2**32


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_halves_are_exact(spark, n):
    keys = range(3, 3 + n)
    first = set(sorted(keys, key=lambda k: (hashed(k, 1), k))[: n // 2])
    for partitions in PARTITIONS:
        halves = split.split_exact_halves(keys_frame(spark, keys, partitions)).collect()
        assert len(halves) == n
        assert {r["session_id"] for r in halves if r["slice"] == 1} == first


def test_halves_with_equal_hashes(spark):
    # The upper half counts as so many times the high multiplier in the lower one.
    keys = [i * 2**32 + (k - i * 1540483477) % 2**32 for k in range(5) for i in range(9)]
    assert len({hashed(k, 1) for k in keys}) == 5
    first = set(sorted(keys, key=lambda k: (hashed(k, 1), k))[: len(keys) // 2])
    halves = split.split_exact_halves(keys_frame(spark, keys, 3)).collect()
    assert {r["session_id"] for r in halves if r["slice"] == 1} == first


def test_train_and_test_make_up_the_input(spark):
    keys = range(1000)
    expected = {k for k in keys if hashed(k) % 100 < 80}
    for partitions in PARTITIONS:
        train, test = split.split_train_test(keys_frame(spark, keys, partitions))
        train, test = ({r["session_id"] for r in part.collect()} for part in (train, test))
        assert train == expected and test == set(keys) - expected


def test_folds(spark):
    for partitions in PARTITIONS:
        rows = split.with_fold(keys_frame(spark, range(1000), partitions)).collect()
        assert all(r["fold"] == hashed(r["session_id"]) // 100 % 5 for r in rows)
    assert {r["fold"] for r in rows} == set(range(5))


def test_cap_and_shuffle(spark):
    order = sorted(range(300), key=hashed)
    for partitions in PARTITIONS:
        df = keys_frame(spark, range(300), partitions)
        assert [r["session_id"] for r in split.cap_rows(df, 200).collect()] == order[:200]
        assert [r["session_id"] for r in split.shuffled(df, seed=0).collect()] == order
    assert split.cap_rows(df, 400).count() == 300


@pytest.mark.parametrize("step", [1 << 32, 1 << 20, 1 << 33, 1])
def test_wide_keys_spread(spark, step):
    """Keys that differ in their upper bits only, as generated ids do, still fall into even parts."""
    keys = spark.range(20_000).select((F.col("id") * step).alias("session_id"))
    shares = split.with_fold(keys).agg(
        F.avg(split.is_train().cast("int")).alias("train"), *(F.avg((F.col("fold") == i).cast("int")).alias(f"f{i}") for i in range(5))
    ).first()
    assert 0.79 <= shares["train"] <= 0.81
    assert all(0.19 <= shares[f"f{i}"] <= 0.21 for i in range(5))


def test_generated_keys_spread(spark):
    keys = spark.range(0, 40_000, numPartitions=7).select(F.monotonically_increasing_id().alias("session_id"))
    assert 0.79 <= keys.where(split.is_train()).count() / 40_000 <= 0.81


def test_null_keys_land_where_key_0_does(spark):
    df = spark.createDataFrame([(i if i % 3 else None, str(i)) for i in range(15)], "session_id BIGINT, v STRING")
    train, test = split.split_train_test(df)
    assert train.count() + test.count() == 15 and train.where("session_id IS NULL").count() == 5
    assert {r["fold"] for r in split.with_fold(df).where("session_id IS NULL").collect()} == {0}


def test_halves_with_null_and_repeated_keys(spark):
    one_null = spark.createDataFrame([(None, "n"), *((i, "v") for i in range(1, 11))], "session_id BIGINT, v STRING")
    assert split.split_exact_halves(one_null).where("slice = 1").count() == 5
    repeated = spark.createDataFrame([(7, "v")] * 10 + [(8, "v")], "session_id BIGINT, v STRING")
    counted = {r["slice"]: r["count"] for r in split.split_exact_halves(repeated).groupBy("slice").count().collect()}
    assert counted == {1: repeated.count() // 2, 2: repeated.count() - repeated.count() // 2}


def test_join_by_key(spark):
    left = keys_frame(spark, range(50), 3)
    right = left.select("session_id", (F.col("session_id") * 2).alias("y"))
    joined = split.join_features_target(left, right).collect()
    assert len(joined) == 50 and all(r["y"] == 2 * r["session_id"] for r in joined)


@pytest.mark.parametrize("partitions", [1, 4])
def test_exact_halves_of_repeated_keys(spark, partitions):
    """Ten equal keys of eleven rows, a hot null key, equal rows, and rows that differ in their content only."""
    tables = {
        "one key": [(7, i) for i in range(10)] + [(8, 0)],
        "equal rows": [(7, 0)] * 10 + [(8, 0)],
        "null key": [(None, i % 4) for i in range(30)] + [(i, 0) for i in range(12)],
        "some equal": [(5, i % 3) for i in range(21)],
        "one row": [(1, 1)], "two rows": [(1, 1)] * 2, "none": [],
    }
    for rows in tables.values():
        frame = spark.createDataFrame(rows, f"{KEY} bigint, x int").repartition(partitions)
        halves = split.split_exact_halves(frame).collect()
        assert sorted((r[KEY], r["x"]) for r in halves if r[KEY] is not None) == sorted(r for r in rows if r[0] is not None) and len(halves) == len(rows)
        assert sum(r["slice"] == 1 for r in halves) == len(rows) // 2
        again = split.split_exact_halves(frame.repartition(partitions + 1)).collect()
        assert sorted(map(repr, halves)) == sorted(map(repr, again))
