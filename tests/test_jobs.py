import pytest

from cartsight.__main__ import main
from cartsight.operators.features import model_features
from cartsight.operators.metrics import class_distribution
from cartsight.operators.split import split_train_test
from cartsight.schema import KEY
from cartsight.sources import session_lines, shop_sessions

FOLDER = "/root/testdata/sf0.001"


def test_prepare_profile_train_compare(spark, tmp_path, capsys):
    sessions = shop_sessions(spark, FOLDER)
    x, y, out = (str(tmp_path / n) for n in ("x", "y", "out"))
    sessions.drop("Revenue").write.option("header", True).csv(x)
    sessions.select(KEY, "Revenue").write.option("header", True).csv(y)
    main(["prepare", x, y, out], spark)
    assert "|1    |736  |" in capsys.readouterr().out

    # The slices hold the key first: columns are found by name, and the classes are those of the records.
    main(["profile", f"{out}/slice=1"], spark)
    assert "VisitorType" in capsys.readouterr().out
    main(["train", f"{out}/slice=1", f"{out}/slice=2"], spark)
    printed = capsys.readouterr().out
    records = spark.table("session_records")
    assert sorted(map(tuple, records.select(sessions.columns).collect())) == sorted(map(tuple, sessions.collect()))
    classes = class_distribution(split_train_test(model_features(sessions))[0])
    assert all(f"|{r['Revenue']}      |{r['count']}" in printed.split("Classes in the training part")[1].split("Predictions")[0] for r in classes.collect())
    main(["compare", out], spark)
    assert "pooled" in capsys.readouterr().out

    sessions.select(KEY, "Revenue").unionByName(sessions.select(KEY, "Revenue").limit(1)).write.option("header", True).csv(f"{y}2")
    with pytest.raises(ValueError, match="target"):
        main(["prepare", x, f"{y}2", f"{out}2"], spark)

    keyless = str(tmp_path / "keyless")
    sessions.drop(KEY).write.option("header", True).csv(keyless)
    main(["profile", keyless], spark)
    printed = capsys.readouterr().out
    assert "VisitorType" in printed and "|1473" in printed

    main(["train", keyless], spark)
    printed = capsys.readouterr().out
    for title in ("Null values", "Rows per part", "Predictions", "Quality of the tree", "Confusion matrix"):
        assert f"\n{title}\n" in printed
    assert spark.table("session_records").count() == 1473

    sliced = str(tmp_path / "sliced")
    for n in (1, 2):
        sessions.where(f"session_id % 2 = {n - 1}").drop(KEY).write.option("header", True).csv(f"{sliced}/slice={n}")
    main(["compare", sliced], spark)
    assert "pooled" in capsys.readouterr().out


def test_streams(spark, tmp_path, capsys):
    lines = str(tmp_path / "lines")
    session_lines(shop_sessions(spark, FOLDER)).select("value").write.text(lines)
    main(["stream-tree", lines, str(tmp_path / "t"), str(tmp_path / "s1"), "--once"], spark)
    assert "|0       |ok" in capsys.readouterr().out
    main(["stream-online", lines, str(tmp_path / "w"), str(tmp_path / "o"), str(tmp_path / "s2"), "--once"], spark)
    assert "|0       |ok" in capsys.readouterr().out
    logged = ["--progress", str(tmp_path / "p"), "--batches", "1", "--every", "1 second"]
    main(["stream-online", lines, str(tmp_path / "w2"), str(tmp_path / "o2"), str(tmp_path / "s3"), *logged], spark)
    printed = capsys.readouterr().out
    assert "\nBatches\n" in printed and printed.count("|0       |") == 2
    with pytest.raises(SystemExit):
        main(["stream-tree", lines, "t2", "s4", "--batches", "1"], spark)
