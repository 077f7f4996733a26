"""The flows from files to files."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import views
from clickloom.plans import files
from clickloom.plans.models import Boosting
from clickloom.sources.tables import read_csv

SMALL = "/root/testdata/sf0.001"
QUICK = Boosting(rounds=3, depth=2, rate=0.3)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    for name in ("train", "test", "offers", "trans", "history"):
        df = getattr(views, name)(spark, SMALL)
        df.write.parquet(f"{folder}/{name}")
        df.write.option("header", True).csv(f"{folder}/{name}.csv")
    return str(folder)


def test_last_prediction_in_the_file_wins(spark, tmp_path):
    """Whatever way the file is cut into splits."""
    rnd = random.Random(4)
    rows = [(rnd.randrange(40), rnd.randrange(5), rnd.random()) for _ in range(3000)]
    lines = ["id1,id2,id3,id5,pred"] + [f"{i},{a},{b},x,{p!r}" for i, (a, b, p) in enumerate(rows)]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "t.csv").write_text("id2,id3,note\n" + "\n".join(
        f"{a},{b},n" for a in range(50) for b in range(6)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        parts = read_csv(spark, str(tmp_path / "p.csv"), position="pos")
        assert parts.rdd.getNumPartitions() > 5
        ordered = [r["id1"] for r in parts.orderBy("pos").select("id1").collect()]
        assert ordered == list(range(3000))
        got = files.template_files(
            spark, str(tmp_path / "t.csv"), str(tmp_path / "p.csv"), str(tmp_path / "out.csv"))
        last = {(a, b): p for a, b, p in rows}
        assert {(r["id2"], r["id3"]): r["pred"] for r in got.collect()} == {
            (a, b): last.get((a, b), 0.0) for a in range(50) for b in range(6)}
        back = read_csv(spark, str(tmp_path / "out.csv"))
        assert back.columns == ["id2", "id3", "note", "pred"] and back.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("kind", ["", ".csv"])
def test_features_then_submissions(spark, stored, tmp_path, kind):
    names = [f"{stored}/{n}{kind}" for n in ("train", "test", "offers", "history", "trans")]
    train, test = f"{tmp_path}/train{kind}", f"{tmp_path}/test{kind}"
    files.feature_files(spark, *names, train, test, datetime(2024, 1, 24))
    assert files.read_table(spark, train).count() == 793
    files.rank_files(spark, train, test, f"{tmp_path}/ranked{kind}", QUICK)
    ranked = files.read_table(spark, f"{tmp_path}/ranked{kind}")
    assert ranked.count() == 207 and ranked.columns == ["id1", "id2", "id3", "id5", "pred"]
    files.forest_files(spark, train, test, test, f"{tmp_path}/forest{kind}", 5, 3)
    forest = files.read_table(spark, f"{tmp_path}/forest{kind}")
    assert forest.count() == 207 and forest.where("pred not in (0, 1)").isEmpty()


def test_train_then_score(spark, stored, tmp_path):
    losses = files.train_files(
        spark, f"{stored}/train", f"{stored}/offers", f"{stored}/trans", f"{tmp_path}/bundle",
        datetime(2024, 1, 24), datetime(2024, 1, 20), dates=["id4"], first=QUICK, second=QUICK)
    assert 0 < losses.first()["blend_loss"] < 1
    files.score_files(
        spark, f"{tmp_path}/bundle", f"{stored}/test", f"{stored}/offers", None,
        f"{tmp_path}/out.csv", datetime(2024, 1, 24))
    got = read_csv(spark, f"{tmp_path}/out.csv")
    assert got.count() == 207 and got.where("pred is null or id5 not rlike '^01/[0-9]+/2024$'").isEmpty()
    again = files.train_files(  # dates that are text in a CSV split alike
        spark, f"{stored}/train.csv", None, None, f"{tmp_path}/other",
        datetime(2024, 1, 24), datetime(2024, 1, 20), first=QUICK, second=None)
    assert 0 < again.first()["blend_loss"] < 1
    with pytest.raises(FileNotFoundError):
        files.score_files(spark, f"{tmp_path}/none", f"{stored}/test", None, None, f"{tmp_path}/o")
