import json

import pytest
from pyspark.sql import functions as F

from cartlake.operators import explore, kpis, learning, scoring, serving
from cartlake.operators.silver import silver_events
from cartlake.operators.gold import session_base
from cartlake.plans import medallion
from cartlake.schemas import BRONZE, PRESCRIPTIONS, SESSION_FEATURES, TARGET
from cartlake.sources import files, sinks
from tests.conftest import by, event
from tests.test_gold import brute_force, hot_log


@pytest.fixture
def csv_folder(bronze, tmp_path):
    raw = bronze(hot_log(500)).select(*BRONZE.names)
    for i, name in enumerate(("2019-Nov", "2019-Oct")):
        part = raw.where(F.pmod(F.xxhash64("user_session"), F.lit(2)) == i)
        text = "\n".join([",".join(BRONZE.names), *map(line, part.collect())])
        (tmp_path / f"{name}.csv").write_text(text)
    return tmp_path


def line(row):
    return ",".join("" if v is None else str(v) for v in row)


def test_whole_pipeline(spark, csv_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    carts = medallion.medallion(spark, f"{csv_folder}/*.csv", lake)
    expected = brute_force(hot_log(500))
    got = by(carts, "user_session")
    assert set(got) == set(expected)
    assert {s: r.user_prior_carts for s, r in got.items()} == {s: e[8] for s, e in expected.items()}

    features, prescriptions = medallion.populate_serving(spark, lake, 0)
    features, prescriptions = medallion.populate_serving(spark, lake, 0)
    assert features.count() == prescriptions.count() == len(expected)
    types = {f.name: f.dataType.simpleString() for f in features.schema.fields}
    assert {c: types[c] for c in SESSION_FEATURES} == SESSION_FEATURES
    types = {f.name: f.dataType.simpleString() for f in prescriptions.schema.fields}
    assert {c: types[c] for c in PRESCRIPTIONS} == PRESCRIPTIONS

    frame = learning.feature_frame(carts, keep=["user_session", TARGET])
    learning.save_model(learning.fit(frame, learning.random_forest(3, 3)), str(tmp_path / "model"))
    _, by_model = medallion.populate_serving(spark, lake, 1, str(tmp_path / "model"))
    assert by_model.count() == len(expected)

    text = medallion.publish_dashboard(spark, lake, str(tmp_path / "dashboard")).first().document
    assert spark.read.text(str(tmp_path / "dashboard")).first().value == text
    payload = json.loads(text)
    assert payload["kpis"]["totalCarts"] == len(expected)
    assert payload["funnel"]["carts"] == sum(e[1] == "cart" for e in hot_log(500))
    assert sum(payload["couponDistribution"].values()) == len(expected)
    assert payload["abandonedCartsWithCoupons"][0]["coupon"]["urgency_level"] == "Alta"
    values = [(c["coupon"]["urgency_level"] != "Alta", -c["totalVal"]) for c in payload["abandonedCartsWithCoupons"]]
    assert values == sorted(values)


def test_loading_csv(spark, csv_folder):
    everything = files.load_events(spark, str(csv_folder), sample_n=None)
    assert everything.count() == 500
    october = files.load_events(spark, str(csv_folder), None, "Oct").count()
    november = files.load_events(spark, str(csv_folder), None, "Nov").count()
    assert october + november == 500
    with pytest.raises(FileNotFoundError):
        files.load_events(spark, str(csv_folder), None, "no such file")
    with pytest.raises(ValueError):
        files.load_events(spark, str(csv_folder), 1)
    sample = files.load_events(spark, str(csv_folder), 101)
    assert sample.count() == 100
    assert sorted(map(str, sample.collect())) == sorted(map(str, files.load_events(spark, str(csv_folder), 101).collect()))
    assert files.read_user_events(spark, f"{csv_folder}/*.csv", 1).count() == sum(e[6] == 1 for e in hot_log(500))
    with pytest.raises(FileNotFoundError):
        files.load_events(spark, f"{csv_folder}/nowhere")


def test_source_choice(spark, csv_folder, tmp_path):
    chosen = files.first_existing(spark, [f"{tmp_path}/no.csv", f"{csv_folder}/*.csv"])
    assert chosen == f"{csv_folder}/*.csv"
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [f"{tmp_path}/no.csv"])
    spark.range(3).write.parquet(str(tmp_path / "local"))
    assert files.read_layer(spark, str(tmp_path / "missing"), str(tmp_path / "local")).count() == 3
    sinks.ingest_csv(spark, f"{csv_folder}/2019-Oct.csv", str(tmp_path / "bronze"))
    assert files.read_layer(spark, str(tmp_path / "bronze")).columns == BRONZE.names


def test_a_second_ingest_repeats_no_row(spark, csv_folder, tmp_path):
    bronze = str(tmp_path / "bronze")
    for pattern in ("*.csv", "2019-Oct.csv", "*.csv"):
        sinks.ingest_csv(spark, f"{csv_folder}/{pattern}", bronze)
        assert files.read_layer(spark, bronze).count() == 500
    want = files.read_events_csv(spark, f"{csv_folder}/*.csv")
    assert files.read_layer(spark, bronze).exceptAll(want).count() == 0


def test_user_filter_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.createDataFrame([], BRONZE).write.parquet(str(tmp_path / "events"))
    plan = silver_events(explore.of_user(spark.read.parquet(str(tmp_path / "events")), 5))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,5)" in text and "GreaterThan(price,0.0)" in text


def test_month_partitions_are_pruned(spark, csv_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.build_silver(spark, files.load_events(spark, str(csv_folder), None), lake)
    january = spark.read.parquet(lake.silver).where("year = 2024 and month = 1").select("price")
    text = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<price:double>" in text


def test_paging_clamps(spark):
    listing = spark.createDataFrame([(i, "Ab"[i % 2]) for i in range(25)], "id int, name string")
    assert [r.id for r in explore.page(listing, "id", "id", 1).collect()] == list(range(10))
    assert [r.id for r in explore.page(listing, "id", "id", 99).collect()] == list(range(20, 25))
    assert [r.id for r in explore.page(listing, "id", "id", 0, descending=True).collect()] == list(range(24, 14, -1))
    first = explore.page(listing, "name", "id", 1).collect()
    assert [r.name for r in first] == ["A"] * 10


def test_search_and_filters(spark):
    rows = [("s1", 12, "Frete Grátis", 1, "Alta"), ("s2", 7, None, 0, "Baixa")]
    table = spark.createDataFrame(
        rows, "user_session string, user_id long, coupon_label string, is_abandoned int, urgency_level string"
    )
    names = lambda df: [r.user_session for r in df.collect()]
    assert names(explore.search(table, " FRETE ")) == ["s1"]
    assert names(explore.search(table, "  ")) == ["s1", "s2"]
    assert names(explore.filter_matrix(table, status="PURCHASED")) == ["s2"]
    assert names(explore.filter_matrix(table, urgency="Alta", term="12")) == ["s1"]
    assert names(explore.filter_matrix(table, coupon_label="Frete Grátis")) == ["s1"]
    assert names(explore.filter_carts(table, "0")) == ["s2"]
    assert names(explore.pin_users(table, [7], "user_session")) == ["s2", "s1"]
    assert names(explore.without_users(table, [7])) == ["s1"]
    assert explore.sample(table, "user_session", n=2).collect()[1].coupon_label == ""


def test_totals_agree(bronze):
    silver = silver_events(bronze(hot_log(500)))
    base = session_base(silver)
    funnel = kpis.funnel(silver).first()
    assert funnel.views + funnel.carts + funnel.purchases == silver.count()
    totals = kpis.cart_kpis(base).first()
    days = kpis.kpi_increment(scoring.score(base)).orderBy("day").collect()
    assert (days[-1].total_carts, days[-1].total_gmv, days[-1].gmv_lost) == (
        totals.total_carts,
        totals.total_gmv,
        totals.gmv_lost,
    )
    assert kpis.uniques(silver, approximate=True).first().events == silver.count()


def test_missing_session_gets_defaults(spark):
    prescriptions = spark.createDataFrame(
        [("a", 10, 5.0), ("b", 20, 6.0)], "session_id string, trigger_executed_sec long, total_cart_value double"
    )
    features = spark.createDataFrame(
        [("a", 4, 9)], "session_id string, num_cart_items int, num_views_before_cart int"
    )
    rows = by(serving.latest_prescriptions(prescriptions, features, n=2, last_batch=1), "session_id")
    assert (rows["a"].num_cart_items, rows["a"].num_views_before_cart, rows["a"].is_new) == (4, 9, False)
    assert (rows["b"].num_cart_items, rows["b"].num_views_before_cart, rows["b"].is_new) == (1, 3, True)


def test_dimensions(bronze):
    silver = silver_events(
        bronze(
            [
                event("2024-01-01 10:00:00", "view", "a", price=5.0, category=None),
                event("2024-01-03 10:00:00", "cart", "b", price=7.0, category="x.y"),
                event("2024-01-02 10:00:00", "view", "c", user=2, product=2, category=None, brand=None),
            ]
        )
    )
    users = by(serving.dim_users(silver, session_base(silver)), "user_id")
    assert (users[1].total_sessions, users[1].user_intent_profile) == (2, "high_intent")
    assert users[2].user_intent_profile == "browser"
    products = by(serving.dim_products(silver), "product_id")
    assert (float(products[1].price), products[1].main_category) == (7.0, "x")
    assert (products[2].main_category, products[2].brand) == ("other", "generico")
    assert [r.day for r in serving.dim_date(silver).collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_jobs_from_the_command_line(spark, csv_folder, tmp_path, monkeypatch, capsys):
    from cartlake import __main__ as jobs

    forest, boosted = learning.RandomForestClassifier, learning.GBTClassifier
    monkeypatch.setattr(learning, "random_forest", lambda seed: forest(labelCol=TARGET, numTrees=3, seed=seed))
    monkeypatch.setattr(learning, "boosted_trees", lambda seed: boosted(labelCol=TARGET, maxIter=2, seed=seed))
    lake, model = str(tmp_path / "lake"), str(tmp_path / "model")
    jobs.main(["medallion", "--lake", lake, "--csv", f"{csv_folder}/*.csv", "--normalize", "--dedup"])
    jobs.main(["campaign", "--lake", lake, "--model", model])
    assert "roc_auc" in capsys.readouterr().out
    jobs.main(["serving", "--lake", lake, "--model", model])
    assert spark.read.parquet(f"{lake}/serving/session_features").count() > 0
    jobs.main(["dashboard", "--lake", lake, "--out", str(tmp_path / "out")])
    assert json.loads(spark.read.text(str(tmp_path / "out")).first().value)["kpis"]["totalCarts"] > 0


def test_dim_products_sorts_no_raw_events(spark, bronze):
    rows = [
        event("2024-01-02 00:00:00", "view", price=5.0, brand="old"),
        event("2024-01-03 00:00:00", "view", price=7.0, brand="new"),
        event("2024-01-03 00:00:00", "view", price=6.0, brand="newer id"),
        event("2024-01-01 00:00:00", "view", price=9.0, brand="oldest"),
    ]
    products = serving.dim_products(silver_events(bronze(rows)))
    (row,) = products.collect()
    assert (row.brand, float(row.price)) == ("newer id", 6.0)
    plan = products._jdf.queryExecution().executedPlan().toString()
    merges = [line for line in plan.splitlines() if "Aggregate(key" in line and "category_code#" in line.split("functions")[0]]
    assert merges and not any("SortAggregate" in line for line in merges)
