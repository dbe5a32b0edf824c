"""Tree ensembles: cuts against trying all, the same trees however dealt, scores against walking the nodes."""

import numpy as np
import pytest
from pixelquery.operators import ensembles, ml
from pixelquery.operators.ensembles import Boosting, Forest, TreeModel
from pixelquery.queries import learning
from pyspark.sql import functions as F

BANDS = ["a", "b", "c", "d"]


def made(n=600, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.random((n, 4)).round(3)
    label = np.where(x[:, 1] > 0.6, 2, np.where(x[:, 0] + 0.1 * x[:, 3] > 0.5, 1, 0))
    label = np.where(draw.random(n) < 0.05, (label + 1) % 3, label)
    return x, label


@pytest.fixture(scope="module")
def rows(spark):
    x, label = made()
    data = [(i, *map(float, v), float(k)) for i, (v, k) in enumerate(zip(x, label))]
    df = spark.createDataFrame(data, "key BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, label DOUBLE")
    return df.union(df.limit(1).select("key", F.lit(None), "b", "c", "d", "label")).repartition(4).cache()


def fit(rows, plan):
    return ensembles.fit(rows, plan, BANDS, "label", ["key"])


def trees_of(model):
    return sorted(map(tuple, model.trees.collect()))


def test_defaults_are_the_whole_ensembles():
    forest, boosting = ml.random_forest(), ml.gradient_boosting()
    assert (forest.trees, forest.depth, forest.least_rows) == (200, 20, 5)
    assert (boosting.rounds, boosting.depth, boosting.least_rows, boosting.rate) == (200, 6, 20, 0.1)


def test_root_of_a_forest_tree_is_the_best_of_all_cuts():
    x, label = made(300)
    codes = (x * 250).astype(np.uint8)
    weight = ensembles.balanced(label, 3)
    plan = Forest(trees=1, depth=1, least_rows=5)
    for seed in range(8):
        tree = ensembles.grow_forest_tree(codes, label, weight, 3, plan, np.random.default_rng(seed))
        draw = np.random.default_rng(seed)
        times = np.bincount(draw.integers(0, 300, 300), minlength=300)
        tried = np.argpartition(draw.random((1, 4)), 2, axis=1)[0, :2]
        held = times > 0

        def purity(part):
            sums = np.bincount(label[part], (times * weight)[part], 3)
            return (sums**2).sum() / sums.sum()

        options = [
            (purity(held & (codes[:, f] <= c)) + purity(held & (codes[:, f] > c)), f, c)
            for f in tried
            for c in range(256)
            if min((held & (codes[:, f] <= c)).sum(), (held & (codes[:, f] > c)).sum()) >= 5
        ]
        best = max(options)[0]
        chosen = [v for v, f, c in options if (f, c) == (tree.feature[0], tree.cut[0])]
        assert chosen and chosen[0] == pytest.approx(best)


def test_first_boosted_cut_is_the_best_of_all_cuts():
    x, label = made(300)
    codes = (x * 250).astype(np.uint8)
    slope, bend = 1 / 3 - (label == 1), np.full(300, 2 / 9)
    tree, leaf = ensembles.grow_boosted_tree(codes.T.copy(), np.arange(300), slope, bend, Boosting(depth=3))

    def gain(part):
        return slope[part].sum() ** 2 / bend[part].sum()

    options = {
        (f, c): gain(codes[:, f] <= c) + gain(codes[:, f] > c)
        for f in range(4) for c in range(256) if 20 <= (codes[:, f] <= c).sum() <= 280
    }
    assert options[tree.feature[0], tree.cut[0]] == pytest.approx(max(options.values()))
    assert np.array_equal(tree.leaves(codes, 4), leaf)
    for node in np.unique(leaf):
        held = leaf == node
        assert held.sum() >= 20
        assert tree.value[node] == pytest.approx(-0.1 * slope[held].sum() / bend[held].sum(), rel=1e-5)


@pytest.mark.parametrize("plan", [Forest(trees=7, depth=6), Boosting(rounds=3, depth=3)])
def test_trees_do_not_depend_on_partitions_or_tasks(rows, plan, monkeypatch):
    once = fit(rows, plan)
    monkeypatch.setattr(ensembles, "ALONE_ROWS", 0)  # boosting deals its classes over tasks that wait for each other
    again = fit(rows.repartition(3, "b"), plan)
    assert trees_of(once) == trees_of(again)


@pytest.mark.parametrize("plan", [Forest(trees=15, depth=8), Boosting(rounds=15)])
def test_scores(spark, rows, plan, monkeypatch, tmp_path):
    model = fit(rows, plan)
    scored = model.transform(rows.withColumn("prediction", F.lit("old")))
    assert set(scored.columns) == {*rows.columns, "prediction"}
    got = {(r.key, r.a): r for r in scored.collect()}
    assert len(got) == 601 and sum(r.prediction is None for r in got.values()) == 1
    hits = [r.prediction == r.label for r in got.values() if r.a is not None]
    assert np.mean(hits) > 0.85
    votes = {}
    edges = [np.array(e) for e in model.about["edges"]]
    for row in model.trees.collect():
        tree = ensembles._tree(row)
        for (key, a), r in got.items():
            if a is None:
                continue
            codes = [int(np.searchsorted(e, r[band])) for e, band in zip(edges, BANDS)]
            node = 0
            while tree.child[node] != node:
                node = tree.child[node] + (codes[tree.feature[node]] > tree.cut[node])
            held = votes.setdefault(key, np.zeros(3))
            if isinstance(plan, Forest):
                held += tree.value.reshape(-1, 3)[node]
            else:
                held[row["class"]] += tree.value[node]
    same = [np.sort(votes[k])[-2] > votes[k].max() - 1e-6 or votes[k].argmax() == r.prediction for (k, a), r in got.items() if a]
    assert all(same)
    model.save(str(tmp_path / "model"))
    monkeypatch.setattr(ensembles, "MODEL_BYTES", 2000)  # sent in several parts
    loaded = TreeModel.load(spark, str(tmp_path / "model"))
    assert {(r.key, r.a): r.prediction for r in loaded.transform(rows).collect()} == {k: r.prediction for k, r in got.items()}
    assert sum(model.importances().values()) == pytest.approx(1.0)
    assert min(model.importances(), key=model.importances().get) in ("c", "d")


@pytest.mark.parametrize("dense", [0, 10**9])
def test_forest_trees_do_not_depend_on_blocks_of_nodes(dense, monkeypatch):
    x, label = made(3000)
    codes = (x * 250).astype(np.uint8)
    weight = ensembles.balanced(label, 3)

    def grown(*order):
        rows = slice(None) if not order else order[0]
        return ensembles.grow_forest_tree(codes[rows], label[rows], weight[rows], 3, Forest(depth=12), np.random.default_rng(5))

    once = grown()
    assert len(once.child) > 100
    monkeypatch.setattr(ensembles, "NODE_ROWS", 50)
    monkeypatch.setattr(ensembles, "DENSE_ROWS", dense)
    again = grown()
    for name in ("feature", "cut", "child", "value", "importance"):
        assert np.array_equal(getattr(once, name), getattr(again, name)), name


def test_boosting_counts_bands_by_pairs_and_no_leaf_that_stays(monkeypatch):
    x, label = made(4000)
    codes = (x * 250).astype(np.uint8)
    codes = np.concatenate([codes, codes[:, ::-1], codes[:, :1]], 1)  # nine bands, so one is alone in its pair
    weight = ensembles.balanced(label, 3)
    plan = Boosting(rounds=2, depth=3)

    def grown():
        counted.clear()
        return ensembles.boost(codes, label, weight, 3, plan, range(3), lambda trees: trees)

    counted, bincount = [], np.bincount

    def noted(values, *rest, **more):
        counted.append(len(values))
        return bincount(values, *rest, **more)

    monkeypatch.setattr(np, "bincount", noted)
    apart = grown()
    # the root and, of each of up to three nodes of the two levels below it, the smaller half: none of the last level
    assert sum(counted) <= 6 * 3 * 9 * 4000 * 2 + 4000
    monkeypatch.setattr(ensembles, "PAIRED_ROWS", 0)
    together = grown()
    assert sum(counted) <= 6 * 3 * 5 * 4000 * 2 + 4000
    for one, two in zip(apart, together, strict=True):
        for k in one:
            for name in ("feature", "cut", "child", "value", "importance"):
                assert np.array_equal(getattr(one[k], name), getattr(two[k], name)), name


def test_leaves_by_columns_are_those_by_rows(monkeypatch):
    x, label = made(500)
    codes = (x * 250).astype(np.uint8)
    columns = codes.T.copy()
    monkeypatch.setattr(ensembles, "BLOCK_ROWS", 70)
    for k, leaves in ((0, 2), (1, 31), (2, 300)):
        plan = Boosting(depth=9, least_rows=1, leaves=leaves)
        tree, leaf = ensembles.grow_boosted_tree(columns, np.arange(500), 1 / 3 - (label == k), np.full(500, 2 / 9), plan)
        assert np.array_equal(tree.leaves_by_columns(columns), leaf) and np.array_equal(tree.leaves(codes, 10), leaf)


def test_sums_on_the_grid_are_exact():
    draw = np.random.default_rng(3)
    values = draw.normal(size=100_000) * 10.0 ** draw.integers(-6, 3, 100_000)
    near = ensembles.on_grid(values)
    assert np.abs(near - values).max() <= 2.0**-52 * np.abs(values).sum()
    assert len({draw.permutation(near).cumsum()[-1] for _ in range(20)}) == 1
    assert not ensembles.on_grid(np.zeros(3)).any() and len(ensembles.on_grid(np.zeros(0))) == 0


def test_a_held_out_tenth_ends_the_rounds():
    x, label = made(400)
    label = np.random.default_rng(0).integers(0, 3, 400)  # nothing to learn
    codes = (x * 250).astype(np.uint8)
    weight = ensembles.balanced(label, 3)
    plan = Boosting(rounds=100, stop_above=100, patience=3)
    rounds = ensembles.boost(codes, label, weight, 3, plan, range(3), lambda trees: trees)
    assert 3 <= len(rounds) < 60


def test_registered_models_fit_for_real(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.label: r for r in learning.QUERIES["ml3_random_forest"](spark, sf).collect()}
    assert len(rows) == 6 and sum(r.recalled for r in rows.values()) >= 4
    model = learning.forest(spark, sf)
    assert model.trees.count() == 200


def test_models_score_in_one_scan(spark):
    bands = ["a", "b"]
    rows = [(i // 10, i % 10, float(i % 7), None if i % 9 == 0 else float(i % 5), float(i % 7 > 3)) for i in range(100)]
    stack = spark.createDataFrame(rows, "row INT, col INT, a DOUBLE, b DOUBLE, label DOUBLE")
    models = {f"m{depth}": ml.fit(stack, ml.random_forest(2, depth), bands) for depth in (1, 3)}
    both = ml.scores(models, stack, bands, keep=["label"])
    assert both.columns == ["row", "col", "label", "m1", "m3"]
    assert "Join" not in both._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.row, r.col): (r.m1, r.m3) for r in both.collect()}
    one, three = ({(r.row, r.col): r.class_id for r in ml.score(m, stack, bands).collect()} for m in models.values())
    assert got == {k: (one[k], three[k]) for k in one} and len(got) == 100


@pytest.mark.parametrize("plan", [Forest(trees=2, depth=2), Boosting(rounds=2, depth=2)])
def test_all_labelled_rows_are_learned_from(spark, plan, monkeypatch):
    n, learned, grow = 4_100_000, [], ensembles.grow

    def noted(packed, *rest):
        learned.append(packed.agg(F.sum(F.octet_length("labels"))).first()[0] // 4)
        return grow(packed, *rest)

    monkeypatch.setattr(ensembles, "grow", noted)
    rows = spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 > 3).cast("double").alias("label"))
    model = ml.fit(rows, plan, ["a"], ["id"])
    assert learned == [n]
    got = model.transform(rows.limit(70)).collect()
    assert [r.prediction for r in got] == [r.label for r in got]


@pytest.mark.parametrize("plan", [Forest(trees=3, depth=6), Boosting(rounds=3, depth=3, stop_above=100)])
def test_trees_do_not_depend_on_files_or_blocks_of_rows(plan, monkeypatch):
    x, label = made(3000)
    codes, weight = (x * 250).astype(np.uint8), ensembles.balanced(label, 3)

    def grown():
        if isinstance(plan, Boosting):
            return [t[k] for t in ensembles.boost(codes, label, weight, 3, plan, range(3), lambda t: t) for k in range(3)]
        return [ensembles.grow_forest_tree(codes, label, weight, 3, plan, np.random.default_rng(k)) for k in range(plan.trees)]

    once = grown()
    monkeypatch.setattr(ensembles, "HELD_ROWS", 10)
    monkeypatch.setattr(ensembles, "COUNT_ROWS", 70)
    monkeypatch.setattr(ensembles, "PAIRED_ROWS", 100)
    assert np.array_equal(ensembles.balanced(label, 3), weight)
    for one, two in zip(once, grown(), strict=True):
        for name in ("feature", "cut", "child", "value", "importance"):
            assert np.array_equal(getattr(one, name), getattr(two, name)), name


@pytest.mark.parametrize("key", ["CAST(NULL AS BIGINT)", "key % 3"])
def test_rows_with_null_or_repeated_keys_are_all_packed_in_one_order(rows, key, monkeypatch):
    monkeypatch.setattr(ensembles, "PACKED_ROWS", 40)
    keyed = rows.withColumn("key", F.expr(key))
    every = keyed.unionByName(keyed)

    def packed(table):
        found, ends = ensembles.packed_rows(table, BANDS, "label", ["key"], [[k / 50 for k in range(50)]] * 4)
        batches = found.select("*", F.lit(0).alias("task")).toArrow().to_batches()
        _, codes, labels = ensembles._unpacked(batches, 4, ends, False)
        assert ends[-1] == len(labels) == 1200
        return codes.tobytes(), labels.tobytes()

    assert packed(every) == packed(every.repartition(7, "c"))
