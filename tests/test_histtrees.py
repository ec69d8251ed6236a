"""Histogram trees against plain NumPy versions, and independence of how rows are dealt."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlens.operators import ensemble, grids, histtrees, search, treeshap


def _rows(n=300, seed=3):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 12, n), r.random(n).round(1), r.integers(0, 2, n), r.integers(0, 2, n)]).astype(float)
    y = np.where(x[:, 0] < 4, 0, np.where(x[:, 1] + 0.3 * x[:, 2] < 0.6, 1, 2))
    y = np.where(r.random(n) < 0.1, r.integers(0, 3, n), y)
    return x, y


@pytest.fixture(scope="module")
def data(spark):
    x, y = _rows()
    return spark.createDataFrame([(i, Vectors.dense(v), float(c), i % 3) for i, (v, c) in enumerate(zip(x, y))], ["id", "features", "label", "fold"]).cache()


def _same(a, b):
    return all((s.feature == t.feature).all() and (s.cut == t.cut).all() and np.array_equal(s.value, t.value) for u, v in zip(a.trees, b.trees, strict=True) for s, t in zip(u, v, strict=True))


def test_boosting_is_the_same_however_rows_are_dealt(data):
    make = lambda: [histtrees.Boosting(stages=7, depth=3, subsample=0.7, colsample=0.8), histtrees.Boosting(histtrees.Rows(fold=1), stages=4, depth=2, l2=1.0, second_order=True)]
    one = histtrees.fit_boosted(histtrees.Table(data, key="id", fold="fold"), make())
    many = histtrees.fit_boosted(histtrees.Table(data.repartition(5), key="id", fold="fold", block_rows=40), make())
    assert all(_same(a, b) for a, b in zip(one, many, strict=True))


def test_trees_are_the_same_however_rows_are_dealt(data, monkeypatch):
    make = lambda: [histtrees.ClassTree(criterion="entropy"), histtrees.ClassTree(histtrees.Rows(fold=0), 4, 5, 3, draw=7, subset=2)]
    one = histtrees.fit_trees(histtrees.Table(data, key="id", fold="fold"), make())
    monkeypatch.setattr(histtrees, "PASS_BYTES", 4000)  # several waves a level
    many = histtrees.fit_trees(histtrees.Table(data, key="id", fold="fold", block_rows=40), make())
    for a, b in zip(one, many, strict=True):
        assert a.tree.feature == b.tree.feature and a.tree.cut == b.tree.cut and all((s == t).all() for s, t in zip(a.tree.stats, b.tree.stats, strict=True))
    f = [histtrees.Forest(histtrees.Rows(fold=0), count=5, depth=4)]
    a = histtrees.fit_forests(histtrees.Table(data, key="id", fold="fold"), f, judged=True)
    b = histtrees.fit_forests(histtrees.Table(data, key="id", fold="fold", block_rows=40), f, judged=True)
    assert a.keys() == b.keys() and all((a[k] == b[k]).all() for k in a)


def test_judged_forests_are_held_a_few_trees_at_a_time(data, monkeypatch):
    forests = lambda: [histtrees.Forest(histtrees.Rows(fold=f), count=7) for f in (0, None)]
    whole = histtrees.Table(data, key="id", fold="fold")
    want = histtrees.fit_forests(whole, forests(), judged=True)
    whole.release()
    grown, fit = [], histtrees.fit_trees

    def counted(table, models):
        out = fit(table, models)
        grown.append(sum(len(m.tree.feature) for m in out) if len(out) > 1 else 0)
        return out

    monkeypatch.setattr(histtrees, "fit_trees", counted)
    monkeypatch.setattr(histtrees, "DRIVER_NODES", 400)
    table = histtrees.Table(data, key="id", fold="fold", block_rows=40)
    got = histtrees.fit_forests(table, forests(), judged=True)
    table.release()
    assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)
    assert len(grown) > 2 and max(grown) <= 600  # some trees are larger than the largest so far


def _plain_boosting(x, y, stages, rate, depth, classes=3):
    """Exact greedy trees on residuals, Newton leaves: raw scores of all rows."""
    scores = np.tile(np.log(np.bincount(y, minlength=classes) / len(y)), (len(y), 1))
    for _ in range(stages):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        step = np.zeros_like(scores)
        for k in range(classes):
            g, h = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])

            def grow(rows, left_levels):
                best = None
                if left_levels:
                    for f in range(x.shape[1]):
                        values = np.unique(x[:, f])
                        for c in (values[1:] + values[:-1]) / 2:
                            left = x[rows, f] <= c
                            if left.any() and not left.all():
                                a, b = rows[left], rows[~left]
                                gain = g[a].sum() ** 2 / len(a) + g[b].sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows)
                                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                                    best = gain, a, b
                if best is None:
                    step[rows, k] = (classes - 1) / classes * g[rows].sum() / h[rows].sum()
                else:
                    grow(best[1], left_levels - 1)
                    grow(best[2], left_levels - 1)

            grow(np.arange(len(y)), depth)
        scores = scores + rate * step
    return scores


def test_boosting_against_plain_numpy(spark, data):
    x, y = _rows()
    model = ensemble.SoftmaxBoost(5, 0.3, max_depth=2, key="id").fit(data)
    got = {r["id"]: r["__F"] for r in model.raw_scores(data).collect()}
    want = _plain_boosting(x, y, 5, 0.3, 2)
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-3)


def test_second_order_leaf_value():
    m = histtrees.Boosting(l2=1.0, second_order=True, start=[0.0] * 3)
    stats = np.array([3, 2, 10]) * int(histtrees.SCALE)
    assert m.value(stats) == pytest.approx(3 / (2 * 2 + 1))
    assert histtrees.Boosting(start=[0.0] * 3).value(stats) == pytest.approx(2 / 3 * 3 / 2)


def test_cuts_and_bins():
    values = np.array([[1.0], [1.0], [3.0], [np.nan], [7.0]])
    cuts = histtrees.cuts_of(values)
    assert cuts.points[0].tolist() == [2.0, 5.0]
    assert cuts.bins(values)[0].tolist() == [0, 0, 1, 2, 2]
    assert len(histtrees.cuts_of(np.arange(1000.0)[:, None], 64).points[0]) == 63


def test_depths_are_prefixes(data):
    table = histtrees.Table(data, fold="fold")
    [deep] = histtrees.fit_trees(table, [histtrees.ClassTree(histtrees.Rows(fold=0))])
    [flat] = histtrees.fit_trees(table, [histtrees.ClassTree(histtrees.Rows(fold=0), depth=2)])
    counts = histtrees.confusions(table, [deep, flat], [2, None])
    assert (counts[0, 2, "valid"] == counts[1, None, "valid"]).all() and counts[0, None, "valid"].sum() == 100


def test_whole_tree_grid(data):
    found = search.search_trees(data)
    assert len(found.candidates) == 90 and found.scores.shape == (90, 3)
    out = found.model.transform(data)
    assert out.where(F.col("prediction") == F.col("label")).count() > 200


def test_boosting_grid_takes_prefixes(data):
    grid = {"n_estimators": [2, 4], "learning_rate": [0.1, 0.5], "max_depth": [2]}
    found = search.search_boosting(data, grid)
    one = search.search_boosting(data, {"n_estimators": [2], "learning_rate": [0.5], "max_depth": [2]})
    assert len(found.candidates) == 4 and found.scores[1].tolist() == one.scores[0].tolist()


def test_neighbour_grid_against_plain(data):
    x, y = _rows()
    found = search.search_neighbours(data)
    assert len(found.candidates) == len(grids.candidates(grids.KNN)) == 20
    c = found.candidates[0]
    assert (c["n_neighbors"], c["weights"], c["metric"]) == (3, "uniform", "euclidean")
    fold = np.arange(len(y)) % 3
    for f in range(3):
        counts = np.zeros((3, 3), int)
        for i in np.flatnonzero(fold == f):
            others = np.flatnonzero(fold != f)
            near = others[np.lexsort((others, np.sqrt(((x[others] - x[i]) ** 2).sum(1))))[:3]]
            counts[y[i], np.bincount(y[near], minlength=3).argmax()] += 1
        assert found.scores[0, f] == pytest.approx(histtrees.weighted_f1(counts))


def test_curves_count_nested_prefixes(data):
    out = search.grown_curve(histtrees.Boosting(stages=2, depth=2), data, [0.1, 0.5, 1.0]).collect()
    assert len(out) == 9 and {(r["size"], r["train_rows"]) for r in out} == {(0.1, 20), (0.5, 100), (1.0, 200)}


def test_pool_keeps_properties_apart(spark):
    got = search.fit_pool(spark, [lambda i=i: spark.range(i + 1).groupBy().count().first()[0] for i in range(12)], 6)
    assert got == list(range(1, 13))
    with pytest.raises(ZeroDivisionError):
        search.fit_pool(spark, [lambda: 1 / 0])


def test_parameter_maps_take_every_name():
    sizes = {"bagging": (ensemble.BaggingClassifier(), grids.BAGGING), "regressor": (ensemble.BaggingClassifier(regression=True), grids.BAGGING_REGRESSOR),
             "samme": (ensemble.SammeClassifier(), grids.ADABOOST), "boosting": (ensemble.SoftmaxBoostClassifier(), grids.GRADIENT_BOOSTING),
             "second": (ensemble.SoftmaxBoostClassifier(), grids.SECOND_ORDER_BOOSTING)}
    assert {k: len(grids.param_maps(e, g)) for k, (e, g) in sizes.items()} == {"bagging": 54, "regressor": 27, "samme": 12, "boosting": 108, "second": 108}
    with pytest.raises(ValueError, match="no parameter for learning_rate"):
        grids.param_maps(ensemble.BaggingClassifier(), grids.ADABOOST)


@pytest.mark.parametrize("kind", ["bagging", "regressor", "samme", "boosting"])
def test_attributions_of_ensembles_add_up(spark, data, kind):
    model = {"bagging": lambda: ensemble.BaggedTrees(3, 0.8, 0.7, max_depth=4), "regressor": lambda: ensemble.BaggedTrees(3, regression=True, max_depth=3),
             "samme": lambda: ensemble.SammeBoost(4, max_depth=2), "boosting": lambda: ensemble.SoftmaxBoost(4, max_depth=3)}[kind]().fit(data)
    base = treeshap.ensemble_base_values(model)
    phi = {(r["row_id"], r["class"]): r["s"] for r in treeshap.ensemble_attributions(model, data, "features", "id", list("abcd")).groupBy("row_id", "class").agg(F.sum("phi").alias("s")).collect()}
    x, _ = _rows()
    start, members = model.additive()
    want = np.array(start) + sum(values[nodes.leaves(x)] for nodes, values in members)
    assert max(abs(base[c] + s - want[i, int(c)]) for (i, c), s in phi.items()) < 1e-9
    assert math.isclose(sum(base.values()), float(want.mean(0).sum()), abs_tol=0.5)


@pytest.mark.parametrize("rows", [32_768, 40])
def test_value_tree_without_a_limit_gives_the_means_of_equal_rows(spark, rows):
    x, _ = _rows(400)
    r = np.random.default_rng(8)
    y, w = np.round(1e6 * x[:, 0] * x[:, 2] + r.normal(0, 1000, 400), 3), r.integers(1, 4, 400).astype(float)
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)], ["features", "label", "w"])
    table = histtrees.Table(df, weight="w", numeric=True, block_rows=rows)
    assert table.span == (y.min(), y.max()) and (table.blocks == 1) == (rows > 400)
    [tree] = histtrees.fit_trees(table, [histtrees.ValueTree(span=table.span)])
    nodes = tree.tree.grown(tree.value).nodes(table.cuts)
    got = nodes.predictions[nodes.leaves(x)]
    same = (x[:, None, :] == x[None, :, :]).all(-1)
    want = (same * w) @ y / (same * w).sum(1)
    assert np.abs(got - want).max() < 2e-3 * (y.max() - y.min())  # rows of a node without spread (a millionth of the span's square) stay together
    stump, = histtrees.fit_trees(table, [histtrees.ValueTree(depth=1, span=table.span)])
    f, cut = stump.tree.feature[0], stump.tree.cut[0]

    def left_over(f, at):
        low = x[:, f] <= at
        return sum((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum() for m in (low, ~low) if m.any())

    best = min(left_over(f, at) for f in range(4) for at in table.cuts.points[f])
    assert math.isclose(left_over(f, table.cuts.points[f][cut]), best, rel_tol=1e-6)
    table.release()


@pytest.mark.parametrize("rows", [32_768, 40])
def test_root_without_the_first_feature_is_split(data, rows):
    """The root's sums come from a feature that it may split at."""
    table = histtrees.Table(data, key="id", fold="fold", block_rows=rows)
    [forest] = histtrees.fit_forests(table, [histtrees.Forest(count=30, depth=3, subset=1)])
    assert all(t.feature[0] >= 0 for t in forest.trees) and len({int(t.feature[0]) for t in forest.trees}) > 2
    assert all(abs(t.cover[0] - t.cover[t.feature < 0].sum()) < 1e-6 for t in forest.trees)
    table.release()


def test_sums_of_blocks_do_not_reach_the_driver(data, monkeypatch):
    from pyspark import RDD

    def refused(self, *args, **kwargs):
        raise AssertionError("the sums of a block went to the driver")

    table = histtrees.Table(data, key="id", fold="fold", block_rows=40)
    monkeypatch.setattr(RDD, "reduce", refused)
    monkeypatch.setattr(RDD, "treeReduce", refused)
    sent = []
    collect = RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    [tree] = histtrees.fit_trees(table, [histtrees.ClassTree(depth=3)])
    assert len(tree.tree.feature) > 3
    assert all(len(stats) == 4 for got in sent for _, found in got for stats, _ in found)  # three classes and the weight


def test_slots_of_a_category_share_a_count():
    r = np.random.default_rng(5)
    n, slots = 500, 6
    x = np.column_stack([np.eye(slots)[r.integers(0, slots, n)], r.integers(0, 2, n), r.integers(0, 9, n)])
    cuts = histtrees.cuts_of(x)
    bins = cuts.bins(x)
    bundles = histtrees.bundled(bins, cuts)
    assert [m.tolist() for m, _ in bundles] == [list(range(slots)), [slots]]  # six slots in one count; the other flag has its own
    none = np.zeros(n, np.int64)
    block = histtrees.Block(bins, none, np.ones(n), none.astype(np.uint64), none, none, bundles)
    at = r.integers(0, 4, n)
    for w in (np.rint(r.random(n) * histtrees.SCALE), r.integers(1, 5, n) * histtrees.SCALE):  # the second kind is counted beside the curvature
        channels = [np.rint(r.normal(0, histtrees.SCALE, n)), np.rint(r.random(n) * histtrees.SCALE), w]
        assert (histtrees._paired(channels[1:]) is None) == (w % histtrees.SCALE).any()
        for rows in (np.arange(n), np.flatnonzero(r.random(n) < 0.5)):
            got = histtrees.sums(block, cuts, at, rows, channels, [1, 3], np.array([0, 2, 6, 7]))
            for j, node in enumerate((1, 3)):
                for f in (0, 2, 6, 7):
                    for v in range(cuts.sizes[f]):
                        own = rows[(at[rows] == node) & (bins[f][rows] == v)]
                        assert got[j, :, cuts.at[f] + v].tolist() == [int(c[own].sum()) for c in channels]


def test_a_stage_adds_its_trees_to_the_kept_scores(data, monkeypatch):
    counted = data.sparkSession.sparkContext.accumulator(0)
    add = histtrees.Boosting.add

    def noted(self, scores, b, stages):
        counted.add(len(stages))
        return add(self, scores, b, stages)

    table = histtrees.Table(data, key="id", block_rows=100)
    monkeypatch.setattr(histtrees.Boosting, "add", noted)
    [model] = histtrees.fit_boosted(table, [histtrees.Boosting(stages=6, depth=3)])
    assert len(model.trees) == 6
    assert counted.value <= 6 * table.blocks  # once for each block and stage, however many levels
    table.release()


@pytest.mark.parametrize("rows", [0, 60, 150])
def test_small_nodes_are_finished_where_their_rows_are(data, monkeypatch, rows):
    make = lambda: [histtrees.ClassTree(histtrees.Rows(fold=0)), histtrees.ClassTree(min_split=5, criterion="entropy"), histtrees.ClassTree(histtrees.Rows(fold=1), 6, draw=3)]
    one, many = histtrees.Table(data, key="id", fold="fold"), histtrees.Table(data, key="id", fold="fold", block_rows=100)
    whole = histtrees.fit_trees(one, make())
    passes = []
    picked = histtrees.picked
    monkeypatch.setattr(histtrees, "picked", lambda *args: passes.append(1) or picked(*args))
    monkeypatch.setattr(histtrees, "LOCAL_ROWS", rows)
    for a, b in zip(whole, histtrees.fit_trees(many, make()), strict=True):
        assert a.tree.feature == b.tree.feature and a.tree.cut == b.tree.cut and a.tree.left == b.tree.left and a.tree.depth == b.tree.depth
        assert all((s == t).all() for s, t in zip(a.tree.stats, b.tree.stats, strict=True))
    deepest = max(max(m.tree.depth) for m in whole)
    assert not rows or len(passes) < deepest  # no pass a level down to the leaves
    ways = [1, 3, None]
    want, got = histtrees.confusions(one, whole[:2], ways), histtrees.judged_trees(many, make()[:2], ways)
    assert want.keys() == got.keys() and all((want[k] == got[k]).all() for k in want)
    for t in (one, many):
        t.release()
