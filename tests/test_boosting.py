"""Boosting from the margin: the stock learner's trees and errors, L2 leaves, bounded tables."""

import dataclasses
import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ovenplan.models import boosting, gbt
from ovenplan.plans import registry
from ovenplan.session import checkpoint_root, remove

from .conftest import SF_SMALL

PARAMS = dict(maxDepth=5, maxBins=64, seed=42)


@pytest.fixture(scope="module")
def split(spark):
    return registry._training(registry.Inputs(spark, SF_SMALL))


def vectors(df, fs):
    return VectorAssembler(inputCols=fs.features, outputCol="features", handleInvalid="keep").transform(gbt._labelled(df, fs))


def keep_all(errors, patience):
    return len(errors)


def folders(spark, name):
    root = checkpoint_root(spark).removeprefix("file:")
    return [f for f in os.listdir(root) if f.startswith(name)]


def test_equals_the_stock_learner(split):
    train, stop, test = split
    stock = GBTRegressor(labelCol="label", maxIter=8, stepSize=0.05, lossType="squared", **PARAMS).fit(vectors(train, gbt.V2))
    want = stock.evaluateEachIteration(vectors(stop, gbt.V2), "absolute")
    ensemble, errors = boosting.boost(vectors(train, gbt.V2), vectors(stop, gbt.V2), 8, 50, keep_all, checkpoint_interval=3, **PARAMS)
    assert errors == pytest.approx(want, abs=1e-9)
    rows = vectors(test, gbt.V2)
    for n in (8, 3):
        own = ensemble.first(n).model()
        assert own.getNumTrees == n
        got = own.transform(rows).agg(F.sum("prediction")).first()[0]
        if n == 8:
            assert got == pytest.approx(stock.transform(rows).agg(F.sum("prediction")).first()[0], rel=1e-12)
            assert own.featureImportances.toArray() == pytest.approx(stock.featureImportances.toArray()[: own.featureImportances.size])


def test_leaves_with_l2_equal_a_grouped_sum(spark, split):
    train, stop, test = split
    rows = vectors(train, gbt.V3)
    ensemble, _ = boosting.boost(rows, None, 3, 50, keep_all, l2=3.0, step_size=0.1, **PARAMS)
    margin = F.lit(0.0)
    table = rows.select("features", "label", F.monotonically_increasing_id().alias("id"))
    for t, (tree, weight, leaves) in enumerate(zip(ensemble.trees, ensemble.weights, ensemble.leaves, strict=True)):
        assert weight == (0.1 if t else 1.0)
        table = tree.setLeafCol(f"leaf_{t}").setPredictionCol(f"mean_{t}").transform(table)
        rest = F.col("label") if t == 0 else 2 * (F.col("label") - margin)
        table.withColumn("rest", rest).createOrReplaceTempView("boosted_rows")
        sql = f"SELECT leaf_{t} AS leaf, sum(rest) / (count(*) + 3) AS v, avg(rest) AS mean FROM boosted_rows GROUP BY 1"
        found = {int(r.leaf): r for r in spark.sql(sql).collect()}
        assert leaves == pytest.approx([found[i].v for i in range(len(leaves))], rel=1e-9)
        assert any(abs(r.v - r.mean) > 1e-6 for r in found.values())
        margin = margin + weight * F.get(F.lit(leaves), F.col(f"leaf_{t}").cast("int"))
    # Scoring looks the same values up, tree by tree.
    model = ensemble.model().setLeafCol("leaves")
    scored = model.transform(table)
    both = scored.select(margin.alias("a"), boosting.leaf_prediction(ensemble.weighted_leaves()).alias("b")).collect()
    assert all(r.a == pytest.approx(r.b, rel=1e-9) for r in both) and len(both) == rows.count()


def test_no_tree_beyond_the_patience(split):
    train, stop, _ = split
    quick = dataclasses.replace(gbt.V2, patience=3, depth=3, step_size=0.5, max_iter=40)
    fitted = gbt.fit(train, stop, quick)
    assert fitted.iterations == gbt.best_iteration(fitted.stop_errors, 3)
    assert len(fitted.stop_errors) <= min(40, fitted.iterations + 3)
    assert fitted.model.stages[-1].getNumTrees == fitted.iterations


def test_one_margin_table_at_a_time(spark, split, monkeypatch):
    train, stop, _ = split
    before, seen = set(folders(spark, "margins") + folders(spark, "stop-margins")), []
    monkeypatch.setattr(
        boosting._Rows, "error", lambda self: seen.append(len({*folders(spark, "margins"), *folders(spark, "stop-margins")} - before)) or 1.0
    )
    boosting.boost(vectors(train, gbt.BASELINE), vectors(stop, gbt.BASELINE), 5, 50, keep_all, checkpoint_interval=2, maxDepth=2)
    assert seen == [2] * 5
    assert set(folders(spark, "margins") + folders(spark, "stop-margins")) == before


def test_l2_model_is_saved_with_its_leaves(spark, split, tmp_dir):
    train, _, test = split
    fitted = gbt.fit(train, None, gbt.V3, max_iter=3)
    gbt.save(fitted, f"{tmp_dir}/model")
    again = gbt.load(f"{tmp_dir}/model")
    assert again.leaves == fitted.leaves and again.feature_set == gbt.V3 and again.iterations == 3
    total = [m.predict(test).agg(F.sum("prediction")).first()[0] for m in (fitted, again)]
    assert total[0] == total[1] and total[0] > 0


def test_remove_only_under_the_shared_folder(spark, tmp_dir):
    with pytest.raises(ValueError, match="not under"):
        remove(spark, tmp_dir)


def test_a_tree_takes_a_job_per_level_and_one_for_its_error(spark, split):
    train, stop, _ = split
    rows, held = vectors(train, gbt.BASELINE), vectors(stop, gbt.BASELINE)

    def jobs(trees):
        group = f"boost-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            boosting.boost(rows, held, trees, 50, keep_all, checkpoint_interval=100, maxDepth=2)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(5) - jobs(2) <= 3 * (2 + 1)


def test_missing_values_go_right_in_training_as_in_prediction(spark):
    nan = float("nan")
    data = [(nan if i % 3 == 0 else float(i % 5), float(i % 2), 50.0 if i % 3 == 0 else float(i % 5)) for i in range(300)]
    df = spark.createDataFrame(data, "a double, b double, label double")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(df)
    ensemble, errors = boosting.boost(rows, rows, 4, 50, keep_all, step_size=0.5, maxDepth=3, maxBins=32)
    got = ensemble.model().transform(rows).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert got == pytest.approx(errors[-1], abs=1e-9) and errors[-1] < 1e-9


def test_one_leaf_if_nothing_splits(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, label double")
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    ensemble, _ = boosting.boost(rows, None, 1, 50, keep_all, l2=1.0)
    assert ensemble.leaves == [[2.0]] and ensemble.trees[0].numNodes == 1
