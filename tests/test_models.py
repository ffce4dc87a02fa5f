"""Splits, metrics, training and explanations."""

from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardlight.ml import boosting, explain, metrics, scoring, split, train
from wardlight.ml.explain import Leaves
from wardlight.operators import joins, ordering


@pytest.fixture(scope="module")
def rows(spark):
    x = lambda k: ((F.col("id") * k % 101) / 101.0)
    df = spark.range(400).select(F.format_string("k%04d", "id").alias("key"), x(7).alias("a"), x(13).alias("b"), x(29).alias("c"))
    y = F.col("a") * 3 - F.col("b") * F.col("c")
    label = F.when(F.col("a") > 0.66, "High").when(F.col("a") < 0.33, "Low").otherwise("Medium")
    return df.withColumn("y", y).withColumn("label", label).cache()


FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def regressor(rows):
    return train.fit_regressor(rows, FEATURES, "y", "key", num_leaves=8, n_estimators=5).model


@pytest.fixture(scope="module")
def classifier(rows):
    return train.fit_classifier(rows, FEATURES, "label", "key", max_depth=2, n_estimators=6).model


def test_splits_do_not_depend_on_partitioning(rows):
    ids = lambda df: {r.key for r in df.select("key").collect()}
    one, two = split.split(rows, "key")
    again, _ = split.split(rows.repartition(5), "key")
    assert ids(one) == ids(again) and not ids(one) & ids(two) and len(ids(one) | ids(two)) == 400


def test_stratified_parts(rows):
    _, test = split.split(rows, "key", strata="label")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert {r.label: r["count"] for r in test.groupBy("label").count().collect()} == {k: round(v * 0.2) for k, v in n.items()}
    folds = split.with_folds(rows, "key", 5, strata="label")
    for r in folds.groupBy("label", "fold").count().groupBy("label").agg(F.min("count"), F.max("count"), F.count("*")).collect():
        assert r[2] - r[1] <= 1 and r[3] == 5


def test_class_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    got = {r["class"]: r for r in metrics.class_metrics(df, "t", "p").collect()}
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    assert (got["a"].precision, got["a"].recall) == (0.5, 0.5)
    assert metrics.macro_f1(df, "t", "p").first()[0] == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    assert metrics.confusion_matrix(df, "t", "p").agg(F.sum("n")).first()[0] == 4


def test_auc_by_pairs(rows):
    data = [(r.label == "High", round(r.b, 1)) for r in rows.select("label", "b").collect()]
    pos, neg = [s for h, s in data if h], [s for h, s in data if not h]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    df = rows.withColumn("s", F.round("b", 1))
    assert metrics.auc(df, F.col("label") == "High", "s").first()[0] == pytest.approx(want)


def test_contributions_add_up(rows, regressor, classifier):
    for model in (regressor, classifier):
        gaps = [r.gap for r in explain.additive(rows, model, "key").collect()]
        assert len(gaps) == 400 and max(gaps) < 1e-9
    shap = explain.shap_values(regressor, rows, "key").join(regressor.transform(rows), "key")
    base = explain.base_value(regressor.base[0], explain.leaves_of(regressor)[0])
    named = shap.select([F.col(c) for c in ("key", "predicted_quality")])
    assert named.count() == 400 and np.isfinite(base)


def test_contributions_of_many_deep_trees():
    """A hundred trees of depth seven: base value and contributions make the margin."""
    rnd = np.random.default_rng(0)
    codes, target = rnd.integers(0, 64, (3000, 14)), None
    target = np.sin(codes[:, 0] / 9) + codes[:, 1] * codes[:, 2] / 900 + rnd.normal(size=3000) / 5
    s = boosting.Settings(0, n_estimators=100, max_depth=7, min_child_weight=1)
    edges = [np.arange(63.0)] * 14
    found = [row for n, trees in enumerate(boosting.fit_rows(codes, target, np.arange(3000), s))
             for row in train._node_rows(n, trees, edges, 1.0)]
    nodes = pa.table([pa.array(c) for c in zip(*found)], names=train.NODE_NAMES).cast(train.NODE_TYPES)
    model = train.Model([f"f{k}" for k in range(14)], [0.0], nodes)
    x = codes[:200].astype(float)
    groups = explain.leaves_of(model)[0]
    assert sum(len(g.value) for g in groups) > 3000 and max(g.features.shape[1] for g in groups) == 7
    assert np.allclose(explain.contributions(groups, x).sum(1) + explain.base_value(0.0, groups), model.margins(x)[:, 0])


def test_leaf_contributions_are_shapley_values():
    leaf = Leaves(np.array([5.0]), np.array([[0, 1, 2]]), np.array([[0.5, -np.inf, 0.2]]), np.array([[np.inf, 0.4, 0.9]]),
                  np.array([[0.3, 0.6, 0.7]]))
    x = np.array([[0.6, 0.1, 0.5], [0.1, 0.3, 0.95], [0.9, 0.9, 0.3]])
    got = explain.leaf_contributions(leaf, x)[:, 0]
    for row, phi in zip(x, got):
        holds = (row > leaf.low[0]) & (row <= leaf.high[0])
        value = lambda known: 5.0 * np.prod([holds[j] if j in known else leaf.share[0, j] for j in range(3)])
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = sum(factorial(k) * factorial(2 - k) / 6 * (value({*s, i}) - value(set(s)))
                       for k in range(3) for s in combinations(others, k))
            assert phi[i] == pytest.approx(want)


# ---- boosting ----------------------------------------------------------------

def plain_tree(codes, g, h, s, depth=0):
    """Level-wise, by trying every cut on the rows themselves."""
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + s.l2)
    every, best = np.ones(len(g), bool), (1e-9, None)
    for f in range(codes.shape[1]):
        for cut in range(boosting.BINS - 1):
            left = codes[:, f] <= cut
            if min(left.sum(), (~left).sum()) < s.min_child_samples or min(h[left].sum(), h[~left].sum()) < s.min_child_weight:
                continue
            gain = score(left) + score(~left) - score(every)
            if gain > best[0] + 1e-9:
                best = gain, (f, cut, left)
    if depth == s.max_depth or best[1] is None:
        return -g.sum() / (h.sum() + s.l2) * s.learning_rate * np.ones(len(g))
    out, (_, _, left) = np.empty(len(g)), best[1]
    for side in (left, ~left):
        out[side] = plain_tree(codes[side], g[side], h[side], s, depth + 1)
    return out


def boosting_rows(n=300, classes=3, seed=4):
    rnd = np.random.default_rng(seed)
    codes = rnd.integers(0, 12, (n, 4))
    target = (codes[:, 0] > 5).astype(int) + (codes[:, 1] > rnd.integers(0, 12, n))
    return codes, target.astype(float) % classes, rnd.integers(-2 ** 62, 2 ** 62, n)


def test_a_round_against_brute_force():
    codes, target, marks = boosting_rows()
    s = boosting.Settings(3, n_estimators=2, max_depth=3, learning_rate=0.3)
    margins = np.zeros((300, 3))
    for trees in boosting.fit_rows(codes, target, marks, s):
        sums = boosting.gradients(margins, target, s) / boosting.UNIT
        for k, tree in enumerate(trees):
            assert np.allclose(tree.value[tree.leaf_of(codes)], plain_tree(codes, sums[k, :, 0], sums[k, :, 1], s))
        for k, tree in enumerate(trees):
            margins[:, k] += tree.value[tree.leaf_of(codes)]


def test_log_loss_falls_every_round():
    codes, target, marks = boosting_rows()
    margins, losses = np.zeros((300, 3)), [np.log(3)]
    for trees in boosting.fit_rows(codes, target, marks, boosting.Settings(3, n_estimators=20, max_depth=3)):
        for k, tree in enumerate(trees):
            margins[:, k] += tree.value[tree.leaf_of(codes)]
        shares = np.exp(margins) / np.exp(margins).sum(1, keepdims=True)
        losses.append(-np.log(shares[np.arange(300), target.astype(int)]).mean())
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_best_leaf_first_differs_from_level_by_level():
    rnd = np.random.default_rng(6)
    codes = rnd.integers(0, 60, (2000, 3))
    target = np.where(codes[:, 0] > 30, np.sin(codes[:, 1]) * 5, 0.0) + rnd.normal(size=2000) / 100
    by_leaf = boosting.Settings(0, n_estimators=1, num_leaves=8, l2=0.0, learning_rate=1.0)
    by_level = boosting.Settings(0, n_estimators=1, max_depth=3, l2=0.0, learning_rate=1.0)
    (one,), (two,) = (next(boosting.fit_rows(codes, target, np.arange(2000), s)) for s in (by_leaf, by_level))
    loss = lambda tree: ((tree.value[tree.leaf_of(codes)] - target) ** 2).sum()
    assert (one.feature < 0).sum() == 8 >= (two.feature < 0).sum()
    assert loss(one) < loss(two)
    assert all(((next(boosting.fit_rows(codes, target, np.arange(2000), boosting.Settings(0, num_leaves=n)))[0].feature < 0).sum()) <= n
               for n in (2, 31, 50))


@pytest.mark.parametrize("s", [boosting.Settings(3, n_estimators=2, max_depth=3, subsample=0.8),
                               boosting.Settings(0, n_estimators=2, num_leaves=6, min_child_samples=20, min_child_weight=1e-3, l2=0.0)])
def test_rows_in_spark_give_the_same_trees(spark, s):
    codes, target, marks = boosting_rows()
    table = spark.createDataFrame([(c.tolist(), float(t), int(m)) for c, t, m in zip(codes, target, marks)],
                                  "codes array<int>, target double, mark bigint").repartition(5)
    pairs = zip(boosting.fit_rows(codes, target, marks, s), boosting.fit_table(table, 4, s), strict=True)
    for here, there in pairs:
        for a, b in zip(here, there, strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values(), strict=True))


def test_the_grid_shares_fits(spark, rows):
    label = F.when(F.col("label") == "High", 0.0).when(F.col("label") == "Low", 1.0).otherwise(2.0)
    s = boosting.Settings(3, max_depth=2)
    parted = split.with_folds(rows, "key", 3, strata="label", out="_fold")
    ready = train.prepare(parted, FEATURES, "key", label, 3, F.col("_fold"))
    grid = {"max_depth": [1, 2], "n_estimators": [2, 4]}
    shared = train.grid_scores(ready, s, grid, 3)
    assert [o for o, _ in shared] == train.combinations(grid)
    for options, score in shared:
        assert train.grid_scores(ready, s, {k: [v] for k, v in options.items()}, 3)[0][1] == score
    few = {"n_estimators": [2, 3]}
    assert train.grid_scores(ready, s, few, 2, task_rows=10) == train.grid_scores(ready, s, few, 2)
    one = train.fit_model(ready, boosting.Settings(3, n_estimators=2), FEATURES, ["a", "b", "c"])
    two = train.fit_model(ready, boosting.Settings(3, n_estimators=2), FEATURES, ["a", "b", "c"], task_rows=10)
    assert one.nodes.equals(two.nodes)


def test_macro_auc_of_probabilities(rows, classifier):
    scored = classifier.transform(rows)
    data = [(r.label, list(r.probabilities)) for r in scored.select("label", "probabilities").collect()]
    areas = []
    for k, label in enumerate(classifier.labels):
        pos, neg = [p[k] for t, p in data if t == label], [p[k] for t, p in data if t != label]
        areas.append(np.mean([[(a > b) + 0.5 * (a == b) for b in neg] for a in pos]))
    assert metrics.probability_auc(scored, "label", classifier.labels).first()[0] == pytest.approx(np.mean(areas))


def test_missing_values_go_right(spark, regressor):
    table = spark.createDataFrame([("1", None, 0.5, 0.5), ("2", float("nan"), 0.5, 0.5), ("3", 9.0, 0.5, 0.5)], "key string, a double, b double, c double")
    got = {r.predicted_quality for r in regressor.transform(table).collect()}
    assert len(got) == 1
    assert max(r.gap for r in explain.additive(table, regressor, "key").collect()) < 1e-9


def test_class_shares_and_storage(spark, rows, classifier, regressor, tmp_path):
    out = classifier.transform(rows)
    assert out.where(F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-9).count() == 0
    assert out.where("label = predicted_label").count() > 360
    classifier.save(spark, str(tmp_path / "c"))
    regressor.save(spark, str(tmp_path / "r"))
    again = train.Model.load(spark, str(tmp_path / "c")).transform(rows)
    assert out.select("key", "predicted_label").exceptAll(again.select("key", "predicted_label")).count() == 0
    assert train.Model.load(spark, str(tmp_path / "r")).features == FEATURES


def test_scoring_fills_missing_features(rows, classifier, regressor):
    got = scoring.score(classifier, regressor, rows.drop("c"), "key", k=2).collect()
    assert len(got) == 400 and all(len(r.top_drivers) == 2 for r in got)
    assert all(abs(r.top_drivers[0].contribution) >= abs(r.top_drivers[1].contribution) for r in got)


def test_tuning_keeps_the_best(rows):
    fitted = train.fit_regressor(rows, FEATURES, "y", "key", grid={"num_leaves": [2, 8], "n_estimators": [3, 30]}, folds=2)
    assert fitted.best == {"num_leaves": 8, "n_estimators": 30} and -1 < fitted.score < 0
    assert len(fitted.scores) == 4 and fitted.score == max(score for _, score in fitted.scores)
    wider = train.fit_regressor(rows.withColumn("y", F.col("y") * 1000), FEATURES, "y", "key", grid={"num_leaves": [2, 8], "n_estimators": [3, 30]}, folds=2)
    assert wider.score == pytest.approx(1000 * fitted.score)  # in units of the target


def test_explanations_and_profiles(spark, rows):
    df = spark.createDataFrame([("1", "High", -5.0, 2.0, 2.0)], "key string, label string, x double, y double, z double")
    assert scoring.explain_text(df, "label", ["x", "y", "z"], ["key"], 2).first().explanation == (
        "This hospital was flagged High primarily because of x, y.")
    mart = spark.createDataFrame([("1",), ("2",)], "provider_id string")
    shap = spark.createDataFrame([("1", 0.5, -1.0)], "provider_id string, a double, b double")
    got = {r.provider_id: r.shap for r in joins.profiles(mart, {"shap": shap}).collect()}
    assert got == {"1": {"a": 0.5, "b": -1.0}, "2": None}
    assert ordering.sample_n(rows, 10, 1, "key").count() == 10


# ---- sums and contributions of many rows -----------------------------------------

@pytest.mark.parametrize("s", [boosting.Settings(3, n_estimators=3, max_depth=4, subsample=0.7),
                               boosting.Settings(0, n_estimators=3, num_leaves=12, min_child_samples=20, l2=0.0)])
def test_packed_columns_add_up_as_single_ones(s):
    rnd = np.random.default_rng(8)
    state = rnd.integers(0, 25, 30_000)
    codes = np.column_stack([state, state * 3 % 20, state % 7, rnd.integers(0, 64, (30_000, 3)), np.zeros(30_000, int)])
    columns = boosting.Columns(codes)
    assert len(columns.packed) < codes.shape[1]
    target = (codes[:, 3] > 20.0) + (state > 12) * 1.0
    sums = [(a, np.full_like(a, boosting.UNIT) if b is None else b)
            for a, b in boosting.derivatives(np.zeros((max(s.classes, 1), 30_000)), target, s)]
    parts = [np.arange(30_000), np.flatnonzero(state == 3), np.arange(5), np.arange(0)]
    for first, second in sums:
        got = columns.histograms(parts, first, second if s.classes else None)
        for rows, found in zip(parts, got):
            pair = np.column_stack([first, second])[rows]
            assert np.array_equal(found, boosting.histograms(codes[rows], pair, np.zeros(len(rows), np.int64), 1)[0])
    marks, known = rnd.integers(-2 ** 62, 2 ** 62, 30_000), 24_000
    want = np.zeros((30_000, max(s.classes, 1)))
    for trees, margins in boosting.boosted(columns, target[:known], marks[:known], s):
        for k, tree in enumerate(trees):
            want[:, k] += tree.value[tree.leaf_of(codes)]
        assert np.array_equal(margins.T, want)  # rows held out and rows not drawn as well
    own = boosting.Columns(codes[:known])
    assert np.array_equal(margins[:, :known], [m for _, m in boosting.boosted(own, target[:known], marks[:known], s)][-1])


def test_every_fit_has_a_task_of_its_own(spark, rows, monkeypatch):
    """Also of tables beyond the 200,000 rows that the limit once was."""
    assert train.TASK_ROWS >= 1_000_000
    asked = []
    real = type(spark).range
    monkeypatch.setattr(type(spark), "range", lambda self, *a, **k: asked.append(a) or real(self, *a, **k))
    label = F.when(F.col("label") == "High", 0.0).otherwise(1.0)
    parted = split.with_folds(rows, "key", 3, strata="label", out="_fold")
    train.grid_scores(train.prepare(parted, FEATURES, "key", label, 2, F.col("_fold")), boosting.Settings(2, n_estimators=1), {"max_depth": [1, 2]}, 3)
    assert asked == [(0, 6, 1, 6)]


def test_contributions_by_pattern_are_those_of_rows():
    rnd = np.random.default_rng(9)
    n, d = 40, 4
    columns = np.array([rnd.permutation(6)[:d] for _ in range(n)])
    low = rnd.choice([-np.inf, 0.2, 0.4], (n, d))
    high = np.where(np.isinf(low), rnd.choice([0.5, 0.8], (n, d)), rnd.choice([0.6, np.inf], (n, d)))
    group = Leaves(rnd.normal(size=n), columns, low, high, rnd.uniform(0.1, 0.9, (n, d)))
    x = rnd.choice([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.9, np.nan], (500, 6))
    want = np.zeros(x.shape)
    for leaf, features in enumerate(columns):
        want[:, features] += explain.leaf_contributions(group, x)[:, leaf]
    worked = []
    real, explain._shapley = explain._shapley, lambda leaves, holds: worked.append(len(holds)) or real(leaves, holds)
    try:
        assert np.allclose(explain.contributions([group], x), want, atol=1e-12)
    finally:
        explain._shapley = real
    assert worked == [1 << d]  # patterns, not rows
    assert np.allclose(explain.contributions([group], x[:7]), want[:7], atol=1e-12)  # fewer rows than patterns


@pytest.mark.parametrize("s", [boosting.Settings(3, n_estimators=3, max_depth=2, subsample=0.7, min_child_weight=1e-3),
                               boosting.Settings(0, n_estimators=3, num_leaves=12, l2=0.0)])
def test_cells_are_added_up_once(s, monkeypatch):
    """Both derivatives and the row itself in one number, also beyond the rows whose sum is exact; nothing for the last leaves."""
    rnd = np.random.default_rng(10)
    codes = np.column_stack([rnd.integers(0, 64, (150_000, 2)), rnd.integers(0, 3, 150_000)])
    columns, target = boosting.Columns(codes), rnd.integers(0, 3, 150_000) * 1.0
    if not s.classes:
        target *= 1000  # gradients of many units
    for first, second in boosting.derivatives(np.zeros((max(s.classes, 1), 150_000)), target, s):
        weights = boosting.Weights(first, second)
        assert weights.most < 150_000
        both = np.column_stack([first, np.full_like(first, boosting.UNIT) if second is None else second])
        for rows in (np.arange(150_000), np.arange(0, 150_000, 2), np.arange(9)):
            want = boosting.histograms(codes[rows], both[rows], np.zeros(len(rows), np.int64), 1)
            assert np.array_equal(columns.summed([rows], weights), want)
    summed, real = [], boosting.Columns.summed
    monkeypatch.setattr(boosting.Columns, "summed", lambda self, parts, w: summed.append(len(parts)) or real(self, parts, w))
    for trees, margins in boosting.boosted(columns, target, np.arange(150_000), s):
        assert sum(summed) == sum(1 + (tree.feature >= 0).sum() - (2 if s.max_depth == 2 and len(tree.feature) == 7 else 0) for tree in trees)
        summed.clear()


@pytest.mark.parametrize("most", [explain.BITS, 2])
@pytest.mark.parametrize("s", [boosting.Settings(0, n_estimators=6, max_depth=7),
                               boosting.Settings(0, n_estimators=6, num_leaves=40, min_child_samples=5)])
def test_contributions_by_branch_are_those_of_leaves(s, most):
    """A branch is looked up as a whole; paths that test more features than a branch has bits are left to the leaves."""
    rnd = np.random.default_rng(4)
    codes = rnd.integers(0, 64, (3000, 9))
    target = np.sin(codes[:, 0] / 9) + codes[:, 1] * codes[:, 2] / 900 + rnd.normal(size=3000) / 5
    edges = [np.arange(63.0)] * 9
    found = [row for n, trees in enumerate(boosting.fit_rows(codes, target, np.arange(3000), s))
             for row in train._node_rows(n, trees, edges, 1.0)]
    nodes = pa.table([pa.array(c) for c in zip(*found)], names=train.NODE_NAMES).cast(train.NODE_TYPES)
    model = train.Model([f"f{k}" for k in range(9)], [0.0], nodes)
    x = codes.astype(float)
    x[::7, 1], x[::11, 0] = np.nan, np.inf
    groups, (branches, deep) = explain.leaves_of(model)[0], explain.branches_of(model, most)[0]
    assert max(len(b.bits) for b in branches) <= most and (most > 2) == (not deep)
    assert sum(len(b.leaves) for b in branches) + sum(len(g.value) for g in deep) == sum(len(g.value) for g in groups)
    assert most == 2 or 2 * len(branches) < sum(len(g.value) for g in groups)
    got = explain.branch_contributions(branches, x).T + (explain.contributions(deep, x) if deep else 0.0)
    assert np.allclose(got, explain.contributions(groups, x), atol=1e-12)


def test_many_rows_are_explained_by_branch(spark, rows, classifier, monkeypatch):
    """The same contributions by leaf (few rows in a block) and by branch."""
    by_leaf = {r.key: r.contributions for r in explain.with_contributions(rows, classifier, ["key"]).collect()}
    monkeypatch.setattr(explain, "BITS", 3)  # blocks of 8 rows are many
    by_branch = {r.key: r.contributions for r in explain.with_contributions(rows, classifier, ["key"]).collect()}
    assert by_branch.keys() == by_leaf.keys() and len(by_leaf) == 400
    assert all(np.allclose(by_branch[k], by_leaf[k], atol=1e-12) for k in by_leaf)


# ---- fits that share their work --------------------------------------------------

def _same_trees(here, there):
    return all(np.array_equal(x, y) for a, b in zip(here, there, strict=True) for x, y in zip(vars(a).values(), vars(b).values(), strict=True))


@pytest.mark.parametrize("s", [boosting.Settings(3, n_estimators=3, max_depth=4, subsample=0.7),
                               boosting.Settings(0, n_estimators=3, num_leaves=12, min_child_samples=20, l2=0.0)])
def test_rows_dealt_out_to_processes_give_the_same_trees(s):
    codes, target, marks = boosting_rows(5000)
    pairs = list(zip(boosting.fit_rows(codes, target, marks, s), boosting.fit_rows(codes, target, marks, s, processes=3), strict=True))
    assert len(pairs) == 3 and all(_same_trees(*pair) for pair in pairs)


@pytest.mark.parametrize("grown", [dict(classes=0, num_leaves=6, l2=0.0), dict(classes=0, num_leaves=20, l2=0.0),
                                   dict(classes=3, max_depth=3, subsample=0.8)])
def test_settings_share_rounds_while_their_trees_are_the_same(grown):
    """Of rows that more and more small leaves are cut from; rounds differ as well."""
    codes, target, marks = boosting_rows(3000)
    target = target if grown["classes"] else target + codes[:, 2] ** 2 / 90
    family = [boosting.Settings(n_estimators=n, min_child_samples=m, **grown) for m, n in ((40, 4), (1, 6), (90, 6), (8, 5))]
    columns, held = boosting.Columns(codes), (600, 1200)
    grew, real = [], boosting.Growing.tree
    found = {s: [] for s in family}
    boosting.Growing.tree = lambda self: grew.append(1) or real(self)
    try:
        for fits in boosting.boosted_alike(columns, target, marks, family, held):
            for members, trees, margins in fits:
                for s in members:
                    found[s].append((trees, margins.copy()))
    finally:
        boosting.Growing.tree = real
    assert len(grew) < sum(s.n_estimators for s in family) * max(1, grown["classes"])  # some were shared
    for s in family:
        alone = [(trees, margins.copy()) for trees, margins in boosting.boosted(columns, target, marks, s, held)]
        assert len(alone) == s.n_estimators
        for (trees, margins), (own, own_margins) in zip(found[s], alone, strict=True):
            assert _same_trees(trees, own) and np.array_equal(margins, own_margins)


def test_a_stretch_held_out_is_as_good_as_the_last_rows():
    codes, target, marks = boosting_rows(3000)
    s, order = boosting.Settings(3, n_estimators=3, max_depth=3, subsample=0.7), np.r_[0:500, 900:3000, 500:900]
    inside = [(t, m.copy()) for t, m in boosting.boosted(boosting.Columns(codes), target, marks, s, (500, 900))]
    behind = boosting.boosted(boosting.Columns(codes[order]), target[order][:2600], marks[order][:2600], s)
    for (trees, margins), (own, own_margins) in zip(inside, behind, strict=True):
        assert _same_trees(trees, own) and np.array_equal(margins[:, order], own_margins)


def test_a_grid_of_six_times_a_gigabyte_runs_in_tasks(spark, rows, monkeypatch):
    """The train part of 360 copies of sf0.1 is 4.3 million rows. Rows are collected once, and fits of one family are one task."""
    assert train.TASK_ROWS >= 4_500_000
    parted = split.with_folds(rows, "key", 3, out="_fold")
    ready = train.prepare(parted, FEATURES, "key", F.col("y"), 0, F.col("_fold"))
    s = boosting.Settings(0, num_leaves=8, min_child_weight=1e-3, l2=0.0)
    grid = {"num_leaves": [4, 8], "n_estimators": [2, 3], "min_child_samples": [5, 60]}
    asked, collected, real, at_hand = [], [], type(spark).range, train._rows_at_hand
    monkeypatch.setattr(type(spark), "range", lambda self, *a, **k: asked.append(a) or real(self, *a, **k))
    monkeypatch.setattr(train, "_rows_at_hand", lambda *a: collected.append(1) or at_hand(*a))
    shared = train.grid_scores(ready, s, grid, 3)
    assert asked == [(0, 6, 1, 6)]
    monkeypatch.setattr(train, "_STRIPE_ROWS", 100)
    model = train.fit_model(ready, boosting.Settings(0, n_estimators=2, num_leaves=5), FEATURES)
    assert len(collected) == 1
    for options, score in shared:
        assert train.grid_scores(ready, s, {k: [v] for k, v in options.items()}, 3)[0][1] == score
    assert len({score for _, score in shared}) > 4
    few = {"num_leaves": [4], "n_estimators": [2], "min_child_samples": [5, 60]}
    assert train.grid_scores(ready, s, few, 2, task_rows=10) == [
        (options, pytest.approx(score, rel=1e-12)) for options, score in train.grid_scores(ready, s, few, 2)]
    assert model.nodes.equals(train.fit_model(ready, boosting.Settings(0, n_estimators=2, num_leaves=5), FEATURES, task_rows=10).nodes)


def test_stratified_parts_are_stored_once_and_folds_are_dealt_to_binned_rows(spark, rows, monkeypatch):
    """Wide rows are put in order once for a split, and not at all for folds, which are the same as those of the rows themselves."""
    placed, real = [], split.ranking.numbered_in
    monkeypatch.setattr(split.ranking, "numbered_in", lambda df, *a, **k: placed.append(df.columns) or real(df, *a, **k))
    kept, test = split.split(rows, "key", strata="label")
    assert all("Window" not in part._jdf.queryExecution().optimizedPlan().toString() for part in (kept, test))
    asked = []
    monkeypatch.setattr(train, "grid_scores", lambda rows, s, grid, folds: asked.append(rows) or [({"n_estimators": 1}, 0.0)])
    some = kept.withColumn("label", F.when(F.col("key") < "k0350", F.col("label")))  # rows without a label are left out
    train.fit_classifier(some, FEATURES, "label", "key", grid={"n_estimators": [1]}, folds=3)
    assert "codes" in placed[-1] and not set(FEATURES) & set(placed[-1])
    want = {r.mark: r.fold for r in split.with_folds(some, "key", 3, strata="label").where("label is not null")
            .select(F.xxhash64("key").alias("mark"), "fold").collect()}
    got = {r.mark: r.fold for r in asked[0].table.select("mark", "fold").collect()}
    assert got == want and len(got) > 200
