"""Boosted trees against brute force on small frames."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickloom.boosting import fit as boosting
from clickloom.boosting import growth, objectives
from clickloom.boosting.fit import Boosting
from clickloom.operators import metrics
from clickloom.plans import models

PLAIN = {"feature_share": 1.0, "row_share": 1.0, "rate": 0.3, "min_rows": 5}


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(12), rnd.randrange(9), rnd.randrange(7), rnd.randrange(30)) for i in range(900)]
    rows = [(*r, float(rnd.random() < 0.1 + 0.5 * (r[1] > 5) * (r[2] < 4) + 0.3 * (r[3] == 2))) for r in rows]
    df = spark.createDataFrame(rows, "id long, a int, b int, c int, customer long, label double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache(), rows


def best(rows, g, h, s):
    """The best split of some rows, as (gain, feature, value)."""
    found = None
    quality = lambda part: g[part].sum() ** 2 / (h[part].sum() + s.l2)
    for f in range(rows.shape[1]):
        for v in np.unique(rows[:, f])[:-1]:
            left = rows[:, f] <= v
            if min(left.sum(), (~left).sum()) < s.min_rows or min(h[left].sum(), h[~left].sum()) < s.min_curvature:
                continue
            gain = quality(left) + quality(~left) - quality(np.ones(len(rows), bool))
            if gain > 0 and (found is None or gain > found[0] + 1e-9):
                found = (gain, f, int(v))
    return found


def grow(x, g, h, s):
    """Best leaf first; the leaf of every row and the splits in their order."""
    parts, splits = {0: (np.arange(len(x)), 0)}, []
    while len(parts) < s.leaves:
        options = [(best(x[r], g[r], h[r], s), k) for k, (r, d) in parts.items()
                   if len(r) >= 2 * s.min_rows and (s.depth is None or d < s.depth)]
        options = [o for o in options if o[0]]
        if not options:
            break
        (gain, f, v), k = max(options, key=lambda o: o[0][0])
        r, d = parts.pop(k)
        left = x[r, f] <= v
        parts[2 * len(splits) + 1], parts[2 * len(splits) + 2] = (r[left], d + 1), (r[~left], d + 1)
        splits.append((round(gain, 4), f, v))
    out = np.zeros(len(x))
    for r, _ in parts.values():
        out[r] = -s.rate * g[r].sum() / (h[r].sum() + s.l2)
    return out, splits


@pytest.mark.parametrize("small", [0, 100, 10**6])
@pytest.mark.parametrize("depth", [None, 3])
def test_trees_equal_brute_force(frame, monkeypatch, small, depth):
    """Leaves are found by histograms of all tasks, in one task each, or both: the trees are the same."""
    monkeypatch.setattr(growth, "SMALL", small)
    df, rows = frame
    s = Boosting(rounds=3, leaves=9, depth=depth, l2=0.5, **PLAIN)
    (model,) = boosting.fit(df, [s], ["m"], size=128)
    x, y = np.array([r[1:4] for r in rows]), np.array([r[5] for r in rows])
    score = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    assert model.base == pytest.approx(score[0])
    for tree in model.trees:
        p = 1 / (1 + np.exp(-score))
        step, splits = grow(x, p - y, p * (1 - p), s)
        inner = tree.feature >= 0
        assert sorted(zip(tree.gain[inner].round(4), tree.feature[inner], tree.threshold[inner])) == sorted(splits)
        score += step
        assert tree.rows[0] == len(y) and (tree.feature < 0).sum() <= 9
    got = {r["id"]: r["m_raw"] for r in model.transform(df).select("id", "m_raw").collect()}
    assert max(abs(got[r[0]] - score[i]) for i, r in enumerate(rows)) < 1e-5


def test_result_does_not_depend_on_the_deal(frame):
    df, _ = frame
    s = Boosting(rounds=4, leaves=8, feature_share=0.7, row_share=0.6, row_every=2, min_rows=5)
    one, two = (boosting.fit(d, [s], ["m"], size=n)[0] for d, n in ((df, 128), (df.repartition(7), 50)))
    assert one.nodes().exceptAll(two.nodes()).isEmpty() and one.getNumTrees == 4


def test_prefix_and_continued_fit_equal_a_fit_anew(frame):
    df, _ = frame
    s = lambda n: Boosting(rounds=n, leaves=6, feature_share=0.7, row_share=0.7, min_rows=5)
    (six,) = boosting.fit(df, [s(6)], ["m"])
    (three,) = boosting.fit(df, [s(3)], ["m"])
    (again,) = boosting.fit(df, [s(6)], ["m"], start=[three])
    assert six.prefix(3).nodes().exceptAll(three.nodes()).isEmpty()
    a, b = (m.nodes().drop("value", "gain") for m in (six, again))
    assert a.exceptAll(b).isEmpty() and again.getNumTrees == 6


def test_one_fit_judges_every_round(frame, monkeypatch):
    """As many rounds are grown as are judged, one after the other, and the best one is kept."""
    monkeypatch.setattr(boosting, "KEEP", 3)  # scores are kept several times on the way
    df, _ = frame
    grown = []
    old = growth.Growing.finished
    monkeypatch.setattr(boosting.Growing, "finished", lambda self, *a: grown.append(1) or old(self, *a))
    s = Boosting(rounds=200, patience=4, leaves=8, rate=0.6, min_rows=5)
    (model,) = boosting.fit(df, [s], ["m"], held=F.col("id") % 3 == 0)
    kept, over = boosting.best_round(model.history, 4)
    assert over and len(grown) == len(model.history) < 200 and model.getNumTrees == kept
    held = model.transform(df).where("id % 3 = 0")
    loss = metrics.log_losses(held, "label", {"l": "m_score"}).first()[0]
    assert loss == pytest.approx(min(model.history), abs=1e-6)


def test_several_models_in_one_fit_equal_single_fits(frame):
    df, _ = frame
    pair = [Boosting(rounds=3, leaves=5, min_rows=5), Boosting(rounds=5, depth=2, l2=1.0, row_every=1, seed=7)]
    both = boosting.fit(df, pair, ["a", "b"])
    for s, model in zip(pair, both):
        assert model.nodes().exceptAll(boosting.fit(df, [s], ["x"])[0].nodes()).isEmpty()


def test_listwise_gradients_equal_pairs():
    rng = np.random.default_rng(1)
    score, label = rng.normal(size=30), (rng.random(30) < 0.3).astype(float)
    a, b = objectives.list_sums(score, label, np.ones(30, bool))
    g, h = objectives.listwise(score, label, np.full(30, a.sum()), np.full(30, b.sum()))

    def loss(s):
        return math.log(1 + sum(math.exp(s[j] - s[i]) for i in range(30) for j in range(30) if label[i] > label[j]))

    for i in range(30):
        step = np.zeros(30)
        step[i] = 1e-4
        up, mid, down = loss(score + step), loss(score), loss(score - step)
        assert g[i] == pytest.approx((up - down) / 2e-4, abs=1e-6)
        assert h[i] == pytest.approx((up - 2 * mid + down) / 1e-8, abs=1e-4)


@pytest.fixture(scope="module")
def lists(spark):
    """What a customer clicks depends on one feature; how much, on another that says nothing within the list."""
    rnd = random.Random(9)
    rows = []
    for c in range(150):
        level = rnd.random()
        for _ in range(rnd.randrange(5, 20) if c else 400):
            x = rnd.random()
            rows.append((len(rows), c, level, x, float(rnd.random() < max(0.02, level * 0.9 - 0.1) * (0.4 + 0.6 * x))))
    df = spark.createDataFrame(rows, "id1 long, id2 long, level double, x double, label double").repartition(4)
    return VectorAssembler(inputCols=["level", "x"], outputCol="features").transform(df).cache(), rows


def test_lists_in_several_blocks_count_whole(lists):
    df, _ = lists
    s = Boosting(rounds=2, leaves=5, objective="listwise", l2=0.1, **{**PLAIN, "rate": 0.5})
    one, many = (boosting.fit(df, [s], ["m"], held=F.col("id2") % 5 == 1, lists=F.col("id2"), size=n, whole=True)[0]
                 for n in (5000, 60))
    assert one.nodes().drop("value", "gain").exceptAll(many.nodes().drop("value", "gain")).isEmpty()
    assert one.history == pytest.approx(many.history)


def test_history_is_mean_average_precision(lists):
    df, _ = lists
    s = Boosting(rounds=3, leaves=5, objective="listwise", l2=0.1, **PLAIN)
    (model,) = boosting.fit(df, [s], ["m"], held=F.col("id2") % 5 == 0, lists=F.col("id2"), size=100, whole=True)
    scored = model.transform(df).where("id2 % 5 = 0").withColumn("mark", F.xxhash64("label", F.array("level", "x")))
    got = metrics.map_at_k(scored, 5, key="id2", label="label", score="m_raw", ties="mark").first()
    assert got["map_at_5"] == pytest.approx(-model.history[-1])


def test_listwise_ranks_better_than_pointwise(lists):
    """The pointwise loss spends its few leaves on the level, which orders nothing within a list."""
    df, _ = lists
    s = Boosting(rounds=6, leaves=3, patience=6, **PLAIN, objective="listwise")
    p = Boosting(rounds=6, leaves=3, patience=6, **PLAIN, objective="squared")
    held = F.col("id2") % 3 == 0
    found = {}
    for name, settings in (("list", s), ("point", p)):
        (model,) = boosting.fit(df, [settings], ["m"], held=held, lists=F.col("id2"))
        rows = model.transform(df).where(held)
        found[name] = metrics.map_at_k(rows, 5, key="id2", label="label", score="m_score", ties="id1").first()[1]
    assert found["list"] > found["point"]


def test_gains_by_hand(spark):
    """Four rows of each corner: the first split is by a, the second by b, on one side."""
    rows = [(a, b, float(a == 1 and b == 1)) for a in (0, 1) for b in (0, 1) for _ in range(4)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a int, b int, label double"))
    s = Boosting(rounds=1, leaves=3, min_rows=1, rate=1.0, feature_share=1.0, row_share=1.0, objective="squared")
    (model,) = boosting.fit(df, [s], ["m"])
    # the mean is 1/4: residual sums -2 and 2 by a (8 rows each), then -1 and 3 by b (4 rows each)
    gains = {r["feature"]: (r["gain"], r["splits"]) for r in model.gains(["a", "b", ]).collect()}
    assert gains["a"] == (pytest.approx(4 / 8 + 4 / 8), 1)
    assert gains["b"] == (pytest.approx(1 / 4 + 9 / 4 - 4 / 8), 1)
    values = {(r["a"], r["b"]): r["m_score"] for r in model.transform(df).collect()}
    assert values == {(0, 0): pytest.approx(0), (0, 1): pytest.approx(0), (1, 0): pytest.approx(0), (1, 1): pytest.approx(1)}


def test_saved_model_scores_alike(spark, tmp_path, frame):
    df, _ = frame
    (model,) = boosting.fit(df, [Boosting(rounds=3, leaves=6, min_rows=5)], ["m"], held=F.col("id") % 4 == 0)
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).stages[0]
    a, b = (m.transform(df).select("id", "m_score") for m in (model, back))
    assert a.exceptAll(b).isEmpty() and back.history == pytest.approx(model.history)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (float("nan"), 0.0), (2.0, 1.0)], "a double, label double")
    df = VectorAssembler(inputCols=["a"], outputCol="features", handleInvalid="keep").transform(rows)
    (model,) = boosting.fit(df, [Boosting(rounds=2, min_rows=1, min_curvature=0.0)], ["m"])
    assert model.transform(df).where("m_score is null or isnan(m_score)").isEmpty()
    (none,) = boosting.fit(df.limit(0), [Boosting(rounds=2)], ["m"])
    assert none.transform(df).count() == 3
    (same,) = boosting.fit(df.withColumn("label", F.lit(1.0)), [Boosting(rounds=2)], ["m"])
    assert same.transform(df).agg(F.min("m_score")).first()[0] > 0.99


def test_pair_is_two_settings_of_one_fit():
    assert (models.Boosting().leaves, models.Boosting().depth) == (64, None)
    assert (models.SECOND_BOOSTER.depth, models.SECOND_BOOSTER.l2, models.SECOND_BOOSTER.row_every) == (6, 1.0, 1)
    assert (models.RANKER_BOOSTER.rounds, models.RANKER_BOOSTER.patience, models.RANKER_BOOSTER.leaves) == (500, 40, 63)


def test_more_rounds_take_no_more_jobs(spark, frame):
    """Rows that fit into memory are not read anew for each pass."""
    df, _ = frame
    jobs = []
    for rounds in (1, 8):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        boosting.fit(df, [Boosting(rounds=rounds, leaves=6, min_rows=5)], ["m"], held=F.col("id") % 4 == 0)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    spark.sparkContext.setJobGroup("rest", "")
    assert jobs[0] == jobs[1]


@pytest.mark.parametrize("objective", ["logistic", "listwise"])
def test_one_task_several_and_passes_over_files_agree(lists, monkeypatch, objective):
    df, _ = lists
    s = Boosting(rounds=2, leaves=4, objective=objective, l2=0.1, min_rows=5, row_share=0.8)
    found = []
    for blocks, held in ((64, 1 << 29), (8, 1 << 29), (64, 0)):
        monkeypatch.setattr(boosting.together, "PER_TASK", blocks)
        monkeypatch.setattr(boosting.together, "HELD", held)
        (m,) = boosting.fit(df, [s], ["m"], held=F.col("id2") % 5 == 1, lists=F.col("id2"), size=100, whole=True)
        found.append(m)
    for other in found[1:]:
        assert found[0].nodes().drop("value", "gain").exceptAll(other.nodes().drop("value", "gain")).isEmpty()
        assert found[0].history == pytest.approx(other.history)


@pytest.mark.parametrize("files", [True, False])
def test_tasks_agree_by_files_and_through_spark(frame, monkeypatch, files):
    df, _ = frame
    s = Boosting(rounds=2, leaves=6, min_rows=5, row_share=0.8)
    (one,) = boosting.fit(df, [s], ["m"], size=100)
    monkeypatch.setattr(boosting.together, "PER_TASK", 3 if files else 1)
    monkeypatch.setattr(boosting.together, "SLOW", 3)
    if not files:
        monkeypatch.setattr(boosting.together, "folder_of_files", lambda spark: None)
    (other,) = boosting.fit(df, [s], ["m"], size=100)
    assert one.nodes().exceptAll(other.nodes()).isEmpty() and one.getNumTrees == other.getNumTrees


def test_many_rounds_of_several_tasks_do_not_wait(frame, monkeypatch):
    """Some sixty passes; a second each, as ``allGather`` takes, would be a minute."""
    import time

    monkeypatch.setattr(boosting.together, "PER_TASK", 3)
    df, _ = frame
    begun = time.time()
    (model,) = boosting.fit(df, [Boosting(rounds=12, leaves=16, min_rows=5)], ["m"], size=100)
    assert model.getNumTrees == 12 and time.time() - begun < 30


class Threads:
    """The contexts of ``n`` tasks that are threads here."""

    def __init__(self, n):
        import threading

        self.n, self.said, self.gate = n, [None] * n, threading.Barrier(n)

    def of(self, me):
        from types import SimpleNamespace

        def gather(text):
            self.said[me] = text
            self.gate.wait()
            told = list(self.said)
            self.gate.wait()
            return told

        return SimpleNamespace(getTaskInfos=lambda: [None] * self.n, partitionId=lambda: me, allGather=gather,
                               taskAttemptId=lambda: 70 + me)


@pytest.mark.parametrize("lost", [False, True])
def test_talk(tmp_path, monkeypatch, lost):
    """By files where all see them, else through Spark; files of earlier steps are gone."""
    from concurrent.futures import ThreadPoolExecutor

    from clickloom.boosting import together

    monkeypatch.setattr(together, "SEEN", 0.3)
    contexts = Threads(3)

    def task(me):
        talk = together.talk(contexts.of(me), str(tmp_path / ("other" if lost and me == 1 else "one")))
        dealt = [talk.deal([f"{me} to {k}, {step}" for k in range(3)]) for step in range(4)]
        return type(talk), dealt, talk.all(np.full(3, me))

    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(task, range(3)))
    for me, (kind, dealt, every) in enumerate(found):
        assert kind is (together.Gather if lost else together.Files)
        assert dealt == [[f"{k} to {me}, {step}" for k in range(3)] for step in range(4)]
        assert [e.tolist() for e in every] == [[k] * 3 for k in range(3)]
    left = sorted(p.name for p in (tmp_path / "one").rglob("*-*"))
    assert left == ([] if lost else ["4-0", "4-1", "4-2"])


def test_precisions_of_all_lists_at_once():
    rng = np.random.default_rng(4)
    of = np.sort(rng.integers(0, 300, 2000))
    score, mark = rng.integers(0, 5, 2000).astype(float), rng.permutation(2000)
    label = (rng.random(2000) < 0.3).astype(float)
    clicks = np.bincount(of, label, minlength=300).astype(int)
    use = clicks[of] > 0
    got = boosting.precisions_of_lists(of[use], score[use], label[use], mark[use], clicks)
    want = [boosting.average_precisions(score[of == i], label[of == i], mark[of == i], clicks[i])
            for i in np.unique(of[use])]
    assert got == pytest.approx(want) and len(boosting.precisions_of_lists(of[:0], score[:0], label[:0], mark[:0], clicks)) == 0


def test_rows_go_down_a_tree_as_their_values_do(frame):
    df, rows = frame
    (model,) = boosting.fit(df, [Boosting(rounds=1, leaves=20, **PLAIN)], ["m"])
    x = np.array([r[1:4] for r in rows], float)
    (tree,) = model.trees
    cuts = [np.unique(x[:, f])[:-1] for f in range(3)]
    bins = np.array([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], np.uint8)
    assert (tree.of_bins(bins) == tree.of_values(x)).all() and len(tree.of_bins(bins[:, :0])) == 0
