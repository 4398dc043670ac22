import math
import os
import time

import numpy as np
import pytest
from pyspark.mllib.classification import LogisticRegressionWithSGD
from pyspark.mllib.regression import LabeledPoint
from pyspark.sql import functions as F

from cartsight.operators import online
from cartsight.operators.features import online_features, parse_lines, stream_features
from cartsight.plans import QUERIES
from cartsight.schema import KEY, ONLINE_FEATURES
from cartsight.sources import line_stream, session_lines, shop_sessions
from cartsight.streaming import (
    keyed, online_batch, online_stream, parse_stream, parsed_sink, read_batches, run, run_logged, tree_batch, tree_stream,
)
from cartsight.streaming import online as online_module
from cartsight.streaming import progress as progress_module
from cartsight.streaming import tree as tree_module

BATCH = 30  # lines per file


@pytest.fixture(scope="module")
def texts(spark):
    lines = session_lines(shop_sessions(spark, "/root/testdata/sf0.001")).orderBy(KEY)
    return [r["value"] for r in lines.collect()]


@pytest.fixture()
def folder(tmp_path, texts):
    source = tmp_path / "lines"
    source.mkdir()
    for i in range(4):
        part = texts[i * BATCH:(i + 1) * BATCH]
        (source / f"part-{i}.txt").write_text("\n".join(part) + "\n")
        arrived = time.time() - 100 + i  # files are read in the order of their times
        os.utime(source / f"part-{i}.txt", (arrived, arrived))
    return tmp_path


def lines_of(spark, folder):
    return line_stream(spark, str(folder / "lines"), maxFilesPerTrigger=1)


def frame(spark, lines):
    return parse_stream(spark.createDataFrame([(line,) for line in lines], "value STRING"))


def test_parsed_sink_keeps_complete_lines(spark, folder, texts):
    (folder / "lines" / "short.txt").write_text("1,2,3\n\n")
    out = str(folder / "out")
    assert run(parsed_sink(lines_of(spark, folder), out, str(folder / "state"), available_now=True), 60)
    got = spark.read.parquet(out)
    assert got.count() == 4 * BATCH
    assert got.where("VisitorType is null").count() == 0


def tree_row(spark, lines, tmp_path, **options):
    table = str(tmp_path / "tree")
    tree_batch(stream_features(frame(spark, lines)), 0, table, **options)
    return read_batches(spark, table, tree_module.METRICS).first()


@pytest.mark.parametrize(("n", "status"), [(0, "empty"), (19, "too_few_rows"), (20, "any"), (201, "ok")])
def test_tree_batch_guards(spark, tmp_path, texts, n, status):
    row = tree_row(spark, texts[:n], tmp_path)
    assert (row["n_rows"], row["n_clean"]) == (n, n)
    if status != "any":
        assert row["status"] == status
    if n == 201:
        assert row["n_train"] + row["n_test"] == 201
        assert 0 <= row["auc_roc"] <= 1 and 0 <= row["f1"] <= 1


def test_tree_batch_with_bounded_training(spark, tmp_path, texts):
    free = tree_row(spark, texts[:300], tmp_path / "free")
    bound = tree_row(spark, texts[:300], tmp_path / "bound", max_train_rows=100)
    assert free["n_train"] + free["n_test"] == 300
    assert bound["n_train"] == 100 and bound["n_test"] == free["n_test"]


def test_tree_batch_counts_clean_rows(spark, tmp_path, texts):
    broken = [",".join([*t.split(",")[:6], bad, *t.split(",")[7:]]) for t, bad in zip(texts, ["x", "nan", ""])]
    row = tree_row(spark, broken + texts[3:18], tmp_path)
    assert (row["n_rows"], row["n_clean"], row["status"]) == (18, 15, "too_few_rows")


@pytest.mark.parametrize("flag", ["True", "False"])
def test_tree_batch_with_one_class(spark, tmp_path, texts, flag):
    one = [t.rsplit(",", 1)[0] + f",{flag}" for t in texts[:100]]
    row = tree_row(spark, one, tmp_path)
    assert row["status"] == "one_class" and row["auc_roc"] is None and row["accuracy"] == 1.0


def test_tree_batch_with_an_empty_side(spark, tmp_path, texts):
    row = tree_row(spark, [texts[0]] * 40, tmp_path)
    assert row["status"] == "empty_split"
    assert sorted((row["n_train"], row["n_test"])) == [0, 40]


def test_tree_stream(spark, folder):
    table = str(folder / "tree")
    query = tree_stream(lines_of(spark, folder), table, str(folder / "state"), available_now=True)
    assert run(query, 120)
    rows = read_batches(spark, table, tree_module.METRICS).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_rows"]) for r in rows] == [(i, BATCH) for i in range(4)]


def matrix(df):
    data = np.array([tuple(r) for r in df.select("label", *ONLINE_FEATURES).collect()])
    return data[:, 0], data[:, 1:]


def by_hand(df, weights, steps=6, step_size=0.1, tolerance=0.001):
    y, x = matrix(df)
    w = np.array(weights, dtype=float)
    for i in range(1, steps + 1):
        errors = np.array([1 / (1 + math.exp(-max(-700.0, min(700.0, m)))) for m in x @ w]) - y
        new = w - step_size / math.sqrt(i) * (errors[:, None] * x).mean(axis=0)
        moved, w = np.linalg.norm(new - w), new
        if i > 1 and moved < tolerance * max(np.linalg.norm(w), 1):
            break
    return w


@pytest.mark.parametrize("steps", [1, 20])
def test_descent_agrees_with_the_library(spark, texts, steps):
    batch = online_features(frame(spark, texts[:200])).persist()
    ours = online.descend(batch, steps=steps)
    points = batch.select("label", F.array(*ONLINE_FEATURES)).rdd.map(lambda r: LabeledPoint(r[0], r[1]))
    library = LogisticRegressionWithSGD.train(points, steps, 0.1, 1.0, [0.0] * 11, regParam=0.0, convergenceTol=0.001)
    assert ours == pytest.approx(list(library.weights), rel=1e-9, abs=1e-12)
    batch.unpersist()


def test_descent_stops_early(spark, texts):
    batch = online_features(frame(spark, texts[:200]))
    args = dict(step_size=0.001, tolerance=0.5, steps=5)
    assert online.descend(batch, **args) == pytest.approx(list(by_hand(batch, [0.0] * 11, **args)), rel=1e-9)
    two_steps = online.descend(batch, steps=2, step_size=0.001, tolerance=0.0)
    assert online.descend(batch, **args) == pytest.approx(two_steps, rel=1e-9)
    assert online.descend(batch.where("false"), two_steps) == two_steps


def test_descent_by_mini_batches(spark, texts):
    """Each step reads its own part, the same in any layout; a step whose part is empty moves nothing."""
    batch = online_features(frame(spark, texts[:200])).persist()
    weights = np.zeros(11)
    for i in (1, 2, 3):
        y, x = matrix(online.mini_batch(batch, 0.3, i))
        assert 20 < len(y) < 120
        errors = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700))) - y
        weights = weights - 0.1 / math.sqrt(i) * (errors[:, None] * x).mean(axis=0)
    args = dict(steps=3, tolerance=0.0, fraction=0.3)
    assert online.descend(batch, **args) == pytest.approx(list(weights), rel=1e-9)
    assert online.descend(batch.repartition(7), **args) == pytest.approx(list(weights), rel=1e-9)
    parts = [{r[0] for r in online.mini_batch(batch, 0.3, i).select(KEY).collect()} for i in (1, 2)]
    assert parts[0] != parts[1]
    assert online.descend(batch, [0.5] * 11, fraction=0.00001, steps=2) == (0.5,) * 11
    for wrong in (0.0, 1.5):
        with pytest.raises(ValueError, match="fraction"):
            online.mini_batch(batch, wrong, 1)
    batch.unpersist()


def run_online(spark, folder, **options):
    tables = str(folder / "weights"), str(folder / "online")
    query = online_stream(lines_of(spark, folder), *tables, str(folder / "state"), available_now=True, steps=6, **options)
    assert run(query, 120)
    weights = read_batches(spark, tables[0], online_module.WEIGHTS).orderBy("batch_id").collect()
    metrics = read_batches(spark, tables[1], online_module.METRICS).orderBy("batch_id").collect()
    return [r["weights"] for r in weights], metrics


def test_online_stream_carries_weights_over_batches_and_restarts(spark, folder, texts):
    weights, metrics = run_online(spark, folder)
    expected = [0.0] * 11
    for i in range(4):
        expected = by_hand(online_features(frame(spark, texts[i * BATCH:(i + 1) * BATCH])), expected)
        assert weights[i] == pytest.approx(list(expected), rel=1e-9, abs=1e-12)
    assert [r["n_rows"] for r in metrics] == [BATCH] * 4
    assert all(len(r["preview"]) == 5 for r in metrics)

    (folder / "lines" / "part-4.txt").write_text("\n".join(texts[4 * BATCH:5 * BATCH]) + "\n")
    again, more = run_online(spark, folder)
    assert again[:4] == weights and more[:4] == metrics and len(again) == len(more) == 5
    last = by_hand(online_features(frame(spark, texts[4 * BATCH:5 * BATCH])), weights[3])
    assert again[4] == pytest.approx(list(last), rel=1e-9, abs=1e-12)


def test_online_batch_modes_replay_and_empty(spark, tmp_path, texts):
    weights, table = str(tmp_path / "weights"), str(tmp_path / "online")
    first = online_features(frame(spark, texts[:60]))
    online_batch(first, 0, weights, table, mode="test_then_train", steps=2)
    before = read_batches(spark, table, online_module.METRICS).first()
    assert before["auc_roc"] == 0.5 and before["recall"] == 0.0  # zero weights score 0.5 everywhere
    online_batch(first, 0, weights, table, steps=2)
    online_batch(first, 0, weights, table, steps=2)
    assert read_batches(spark, table, online_module.METRICS).count() == 1
    online_batch(first.where("false"), 1, weights, table)
    rows = read_batches(spark, weights, online_module.WEIGHTS).orderBy("batch_id").collect()
    assert rows[0]["weights"] == rows[1]["weights"]
    statuses = read_batches(spark, table, online_module.METRICS).orderBy("batch_id").collect()
    assert [r["status"] for r in statuses] == ["ok", "empty"]
    with pytest.raises(ValueError):
        online_batch(first, 2, weights, table, mode="other")


def test_timed_trigger_and_timeout(spark, folder):
    """A stream on a clock runs on until it is stopped; waiting ends after the time given."""
    table = str(folder / "tree")
    query = tree_stream(lines_of(spark, folder), table, str(folder / "state"), every="1 second")
    try:
        assert not run(query, 1)
        for _ in range(60):
            if query.lastProgress and query.lastProgress["batchId"] >= 3 and not query.status["isTriggerActive"]:
                break
            run(query, 1)
        assert query.isActive
    finally:
        query.stop()
    assert run(query, 5)
    assert read_batches(spark, table, tree_module.METRICS).count() == 4


def test_progress_is_a_table_and_a_stop_falls_between_batches(spark, folder):
    """A stream on a clock reports its batches, stops when asked, and goes on with the next batch."""
    out, table, state = str(folder / "out"), str(folder / "progress"), str(folder / "state")
    query = parsed_sink(lines_of(spark, folder), out, state, every="4 seconds")
    assert run_logged(spark, query, table, until=lambda n: n >= 2, timeout=120) and not query.isActive
    rows = read_batches(spark, table, progress_module.PROGRESS).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_input"]) for r in rows] == [(0, BATCH), (1, BATCH)]
    assert all(r["duration_ms"] >= r["phase_ms"]["addBatch"] >= 0 and r["run_id"] == str(query.runId) for r in rows)
    assert rows[0]["started"] < rows[1]["started"] and spark.read.parquet(out).count() == 2 * BATCH

    query = parsed_sink(lines_of(spark, folder), out, state, available_now=True)
    assert run_logged(spark, query, table)
    rows = read_batches(spark, table, progress_module.PROGRESS).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_input"]) for r in rows] == [(i, BATCH) for i in range(4)]
    assert len({r["run_id"] for r in rows}) == 2 and spark.read.parquet(out).count() == 4 * BATCH


def test_progress_of_a_query_that_fails_or_goes_on(spark, folder):
    table = str(folder / "progress")

    def fail(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("second batch")
        batch.count()

    def started(handle, state, **trigger):
        writer = lines_of(spark, folder).writeStream.foreachBatch(handle).option("checkpointLocation", str(folder / state))
        return writer.trigger(**trigger).start()

    with pytest.raises(Exception, match="second batch"):
        run_logged(spark, started(fail, "failing", availableNow=True), table)
    assert [r["batch_id"] for r in read_batches(spark, table, progress_module.PROGRESS).collect()] == [0]
    query = started(lambda batch, batch_id: None, "going", processingTime="1 second")
    try:
        assert not run_logged(spark, query, table, timeout=1) and query.isActive
    finally:
        query.stop()


def test_old_weights_are_refused(spark, tmp_path, texts):
    weights, table = str(tmp_path / "weights"), str(tmp_path / "online")
    rows = online_features(frame(spark, texts[:40]))
    for batch in (0, 1):
        online_batch(rows, batch, weights, table, steps=1)
    with pytest.raises(ValueError, match="earlier run"):
        online_batch(rows, 0, weights, table, steps=1)


def test_arrivals_are_repeatable(spark):
    """One arrival is one micro-batch, so two runs give the same tables."""
    first, second = (sorted(map(repr, QUERIES["stream_tree_metrics_all_rows"](spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert first == second and len(first) == 4


def test_keys_follow_the_text(spark):
    rows = keyed(spark.createDataFrame([("a",), ("b",), ("a",)], "value STRING")).collect()
    assert rows[0][KEY] == rows[2][KEY] != rows[1][KEY]
