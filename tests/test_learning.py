import bisect
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cartlake.operators import gold, learning, metrics, triggers
from cartlake.operators.running import range_totals
from cartlake.operators.scaler import PopulationScaler
from cartlake.operators.silver import silver_events
from cartlake.plans import learned
from cartlake.plans.layers import Layers
from cartlake.schemas import GOLD_COLUMNS, NUMERIC_FEATURES, TARGET, TRAINING
from cartlake.session import stage
from tests.test_gold import hot_log


@pytest.fixture(scope="module")
def carts(spark):
    from cartlake.schemas import BRONZE_WITH_ID

    rows = [
        (i, f"{t} UTC", k, p, 1, c, b, price, u, s)
        for i, (t, k, p, c, b, price, u, s) in enumerate(hot_log(2500, seed=21))
    ]
    return stage(gold.gold_carts(silver_events(spark.createDataFrame(rows, BRONZE_WITH_ID))), "test-gold")


def test_metrics_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(400)]
    scored = spark.createDataFrame(rows, "label int, score double").withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )
    matrix = metrics.confusion_matrix(scored)
    m = matrix.first()
    tp = sum(y == 1 and s >= 0.5 for y, s in rows)
    fp = sum(y == 0 and s >= 0.5 for y, s in rows)
    assert (m.tp, m.fp, m.tn + m.fn) == (tp, fp, len(rows) - tp - fp)
    q = metrics.classification_metrics(matrix).first()
    assert q.precision == pytest.approx(tp / (tp + fp), abs=1e-6)
    positives = [s for y, s in rows if y == 1]
    negatives = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    auc = metrics.roc_auc(scored).first()
    assert auc.roc_auc == pytest.approx(wins / len(positives) / len(negatives), abs=1e-6)
    for r in metrics.roc_curve(scored).collect():
        assert r.tpr == pytest.approx(sum(s >= r.threshold for s in positives) / len(positives), abs=1e-6)
        assert r.fpr == pytest.approx(sum(s >= r.threshold for s in negatives) / len(negatives), abs=1e-6)


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([(0, 0.1, 0)], "label int, score double, prediction int")
    q = metrics.classification_metrics(metrics.confusion_matrix(empty)).first()
    assert (q.accuracy, q.precision, q.recall, q.f1) == (1.0, 0.0, 0.0, 0.0)
    assert metrics.roc_auc(empty).first().roc_auc is None


def test_per_class_report(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    rows = metrics.per_class_report(spark.createDataFrame(pairs, "y string, p string"), "y", "p").collect()
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in rows}
    assert got["a"] == (0.5, 0.5, 0.5, 2)
    assert got["b"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert got["c"] == (0.0, 0.0, 0.0, 1)


def test_split_is_stable_and_stratified(carts):
    split = {r.user_session: r.split for r in learning.with_split(carts).collect()}
    again = {r.user_session: r.split for r in learning.with_split(carts.repartition(9)).collect()}
    assert split == again
    exact = learning.split_shares(learning.with_split(carts, exact=True)).collect()
    for row in exact:
        assert row.test_carts == pytest.approx(row.carts * 0.2, abs=1)


def test_scaled(carts):
    frame = learning.scaled(learning.feature_frame(carts.withColumn("is_weekend", F.lit(1)), keep=["user_session"]))
    stats = frame.agg(
        *[F.avg(c).alias(f"m_{c}") for c in NUMERIC_FEATURES],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in NUMERIC_FEATURES],
    ).first()
    for c in NUMERIC_FEATURES:
        assert stats[f"m_{c}"] == pytest.approx(0, abs=1e-9)
        assert stats[f"s_{c}"] == pytest.approx(0 if c == "is_weekend" else 1, abs=1e-9)


def test_fit_save_load_predict(spark, carts, tmp_path):
    frame = learning.feature_frame(carts, keep=["user_session", TARGET])
    model = learning.fit(frame, learning.random_forest(trees=5, depth=3))
    learning.save_model(model, str(tmp_path / "model"))
    loaded = learning.load_model(str(tmp_path / "model"))
    before = {r.user_session: r.p_abandonment for r in learning.predict(model, carts).collect()}
    after = {r.user_session: r.p_abandonment for r in learning.predict(loaded, carts).collect()}
    assert before == after and all(0 <= p <= 1 for p in after.values())
    # A table without history is scored with the defaults; unknown categories too.
    bare = carts.select("user_session", "total_cart_value").withColumn("main_category", F.lit("new"))
    assert learning.predict(loaded, bare).count() == carts.count()
    shares = learning.importances(model, NUMERIC_FEATURES, ["main_category"])
    assert len(shares) == 21 and sum(v for _, v in shares) == pytest.approx(1)


def test_compare_and_choose(carts, monkeypatch, tmp_path):
    monkeypatch.setattr(learning, "random_forest", lambda seed: learning.RandomForestClassifier(labelCol=TARGET, numTrees=3, seed=seed))
    monkeypatch.setattr(learning, "boosted_trees", lambda seed: learning.GBTClassifier(labelCol=TARGET, maxIter=2, seed=seed))
    trained = learning.train_models(carts, save_to=str(tmp_path / "best"))
    rows = trained.comparison.collect()
    assert len(rows) == 3 and sum(r.is_best for r in rows) == 1
    best = max(rows, key=lambda r: r.roc_auc)
    assert best.model == trained.best_name
    assert all(r.tn + r.fp + r.fn + r.tp == rows[0].tn + rows[0].fp + rows[0].fn + rows[0].tp for r in rows)
    learning.load_model(str(tmp_path / "best"))


def test_training_table_forests(carts):
    table = learning.training_table(carts).drop("view_to_cart_ratio")
    risk = learning.fit_risk_forest(table, trees=3, depth=3)
    assert risk.transform(learning.with_ratio(table)).count() == carts.count()
    profile = learning.fit_profile_forest(table, trees=5, depth=4)
    said = profile.transform(learning.with_ratio(table))
    names = {r.predicted_profile for r in said.select("predicted_profile").distinct().collect()}
    assert names <= {"high_intent", "bargain_hunter", "browser"}
    without = table.drop("user_prior_views", "user_prior_carts")
    assert len(learning.training_features(without)) == 7
    learning.fit_risk_forest(without, trees=2, depth=2)


def test_one_hot_columns_are_those_of_the_training_rows(spark):
    rows = [("a", "promo", "train"), ("b", "large", "train"), ("c", None, "train"), ("d", "new", "test")]
    carts = spark.createDataFrame(rows, "user_session string, main_category string, split string")
    known = learning.known_categories(carts.filter("split = 'train'"), "main_category")
    assert known == ["large", "promo"]
    got = {r[0]: tuple(r)[1:] for r in learning.one_hot(carts, "main_category", known, ["user_session"]).collect()}
    assert got == {"a": (0, 1), "b": (1, 0), "c": (0, 0), "d": (0, 0)}
    assert learning.known_categories(carts.limit(0), "main_category") == []
    with pytest.raises(ValueError):
        learning.known_categories(carts, "main_category", most=2)


class Recorded:
    """A classifier that keeps the rows it is fitted to."""

    def __init__(self):
        self.rows = []

    def getLabelCol(self):  # noqa: N802
        return TARGET

    def fit(self, rows):
        self.rows.append(rows)
        return None


def part_sizes(rows):
    return sorted(r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect())


def test_classifiers_get_one_table_in_equal_parts(spark, carts, monkeypatch):
    """Before, each classifier got the carts as they lay and prepared them again."""
    frame = learning.feature_frame(carts, keep=["user_session", TARGET]).coalesce(3)
    cores, n, prepared = spark.sparkContext.defaultParallelism, frame.count(), []
    once = learning.preprocessing
    monkeypatch.setattr(learning, "preprocessing", lambda *a: prepared.append(a) or once(*a))
    first, second = Recorded(), Recorded()
    models = learning.fit_each(frame, {"first": first, "second": second})
    assert len(prepared) == 1 and set(models) == {"first", "second"}
    rows = first.rows[0]
    assert second.rows == [rows] and rows.columns == [TARGET, "features"]
    sizes = part_sizes(rows)
    assert len(sizes) == cores and sum(sizes) == n and sizes[-1] - sizes[0] <= 3
    # The kind of each feature reaches the classifier.
    assert rows.schema["features"].metadata["ml_attr"]["num_attrs"] > len(NUMERIC_FEATURES)


def test_dealt_rows_give_the_models_of_a_plain_pipeline(carts):
    frame = stage(learning.feature_frame(carts, keep=["user_session", TARGET]), "frame")
    fitted = learning.fit_each(frame, {"line": learning.logistic_regression(1000), "trees": learning.boosted_trees(3, 3)})
    stages = learning.preprocessing(NUMERIC_FEATURES, ["main_category"])
    line = Pipeline(stages=[*stages, learning.logistic_regression(1000)]).fit(frame).stages[-1]
    got = fitted["line"].stages[-1]
    assert got.coefficients.toArray() == pytest.approx(line.coefficients.toArray(), abs=1e-3)
    assert got.intercept == pytest.approx(line.intercept, abs=1e-3)
    trees = Pipeline(stages=[*stages, learning.boosted_trees(3, 3)]).fit(frame)
    want = {r.user_session: r.p for r in trees.transform(frame).select("user_session", learning.probability().alias("p")).collect()}
    for r in fitted["trees"].transform(frame).select("user_session", learning.probability().alias("p")).collect():
        assert r.p == pytest.approx(want[r.user_session], abs=0.02)


def test_forest_of_kept_nodes_is_the_forest(carts):
    frame = learning.feature_frame(carts, keep=["user_session", TARGET])
    rows = learning.fit_each(frame, {"seen": (seen := Recorded())}) and seen.rows[0]
    forest = learning.random_forest(trees=4, depth=4)
    assert forest.getCacheNodeIds()
    plain = forest.copy()
    plain.setCacheNodeIds(False)
    assert forest.fit(rows).toDebugString.split("\n")[1:] == plain.fit(rows).toDebugString.split("\n")[1:]


def test_forest_decisions_read_the_log_once(spark, monkeypatch):
    """Before, gold was built from the raw log a second time."""
    log, staged = {}, {}

    def kept(df, label):
        log[label] = [f for f in df.inputFiles() if "events.parquet" in f]
        staged[label] = stage(df, label)
        return staged[label]

    monkeypatch.setattr(learned, "stage", kept)
    monkeypatch.setattr(
        learning, "random_forest",
        lambda trees, depth, label=TARGET: learning.RandomForestClassifier(labelCol=label, numTrees=2, maxDepth=2, seed=1),
    )
    layers = Layers(spark, "/root/testdata/sf0.001")
    rows = learned.forest_decisions(layers)
    assert log["silver"] and not log["gold"] and not log["training"] and not log["due"]
    want, got = layers.gold.select(*GOLD_COLUMNS), staged["gold"]
    assert got.count() > 0 and want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    due = triggers.fired(triggers.clocks(layers.silver), [triggers.ONE_HOUR], triggers.last_event_sec(layers.silver))
    assert rows.count() == due.count() > 0


def test_train_job_saves_both_forests(spark, carts, tmp_path, monkeypatch):
    from cartlake import __main__ as job

    monkeypatch.setattr(learning, "random_forest", lambda *_, **__: learning.RandomForestClassifier(labelCol=TARGET, numTrees=2, maxDepth=2))
    table, lake = str(tmp_path / "table"), str(tmp_path / "lake")
    rows = learning.training_table(carts).select(*TRAINING.names)
    rows.unionByName(rows.limit(1).withColumn("num_views_before_cart", F.lit(None).cast("int"))).write.option("header", True).csv(table)
    monkeypatch.setattr(learning, "fit_profile_forest", lambda t: learning.fit_risk_forest(t))
    job.main(["train", "--lake", lake, "--table", table])
    for name in ("risk", "profile"):
        learning.load_model(f"{lake}/models/{name}")


def test_pipeline_scales_as_the_scaled_features(spark, bronze, tmp_path):
    carts = gold.gold_carts(silver_events(bronze(hot_log(400))))
    frame = stage(learning.feature_frame(carts, keep=["user_session", TARGET]), "frame")
    pipeline = Pipeline(stages=learning.preprocessing(NUMERIC_FEATURES, ["main_category"])).fit(frame)
    learning.save_model(pipeline, str(tmp_path / "model"))
    again = learning.load_model(str(tmp_path / "model"))
    want = {r.user_session: r for r in learning.scaled(frame.drop("main_category")).collect()}
    for model in (pipeline, again):
        for r in model.transform(frame).collect():
            values = [r[f"scaled_{c}"] for c in NUMERIC_FEATURES]
            assert values == pytest.approx([want[r.user_session][c] for c in NUMERIC_FEATURES], rel=1e-9, abs=1e-9)
            assert list(r.features.toArray()[: len(values)]) == pytest.approx(values)


def test_scaler_centres_what_never_varies(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    model = PopulationScaler(["a", "b"], ["x", "y"]).fit(rows)
    assert [tuple(r) for r in model.transform(rows).select("x", "y").collect()] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_close_scores_are_ranked_in_many_tasks(spark):
    """All scores lie within 1/65,536, a third of the rows has one and the same."""
    rng = random.Random(9)
    rows = [(rng.randint(0, 1), 0.5 + (0 if i % 3 == 0 else rng.random()) / 70_000) for i in range(6000)]
    scored = spark.createDataFrame(rows, "label int, score double").repartition(4)
    curve = stage(metrics.roc_curve(scored), "curve").withColumn("task", F.spark_partition_id())
    ranges = metrics.ranked_scores(scored, "label", "score")
    plan = ranges._jdf.queryExecution().toString()
    assert "_range" in plan
    auc = metrics.roc_auc(scored).first()
    positives = sorted(s for y, s in rows if y == 1)
    negatives = sorted(s for y, s in rows if y == 0)
    wins = sum(bisect.bisect_left(negatives, p) + bisect.bisect_right(negatives, p) for p in positives) / 2
    assert auc.roc_auc == pytest.approx(wins / len(positives) / len(negatives), abs=1e-6)
    for r in curve.collect():
        assert r.tpr == pytest.approx(1 - bisect.bisect_left(positives, r.threshold) / len(positives), abs=1e-6)


def test_ranges_come_from_the_rows(spark):
    rng = random.Random(1)
    values = sorted({round(rng.random() ** 8, 12) for _ in range(3000)})
    rows = spark.createDataFrame([(v, 1) for v in values], "v double, n long").repartition(5)
    with_range = range_totals(rows, ["v"], {"before": "n"}, {"all": "before"})
    got = {r.v: (r.before, r.all) for r in with_range.collect()}
    assert got == {v: (i, len(values)) for i, v in enumerate(values)}
    dealt = rows.repartitionByRange(4, "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 0.4 * len(values)
