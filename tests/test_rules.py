import itertools
import math

import pytest
from pyspark.sql import functions as F

from cartlake.functions import offers, profiles, risk
from cartlake.operators import scoring


def table(spark, rows):
    return spark.createDataFrame(
        rows,
        "user_session string, total_cart_value double, num_views_before_cart int, is_night int, "
        "hour_of_day int, session_duration_sec long, is_abandoned int",
    )


@pytest.fixture
def grid(spark):
    values = [40.0, 250.0, 250.01, 300.0, 399.99, 400.0, 400.01, 2000.0]
    hours = [0, 5, 6, 14, 21, 22]
    cells = itertools.product(values, range(8), hours, [30, 45, 89, 90])
    return table(
        spark,
        [
            (f"s{i}", v, n, int(h >= 22 or h < 6), h, d, i % 2)
            for i, (v, n, h, d) in enumerate(cells)
        ],
    )


def test_coupon_edges(spark):
    ps = [0.3999, 0.40, 0.6499, 0.65, 0.8499, 0.85]
    vs = [299.99, 300.0, 499.99, 500.0, 799.99, 800.0]
    rows = [(p, v) for p in ps for v in vs]
    df = spark.createDataFrame(rows, "p_abandonment double, total_cart_value double")
    got = {(r.p_abandonment, r.total_cart_value): r for r in scoring.with_recovery(scoring.with_coupon(df)).collect()}

    def expected(p, v):
        if p < 0.40:
            return "NENHUM"
        if p < 0.65:
            return "FRETE_GRATIS" if v >= 300 else "DESC5"
        if p < 0.85:
            return "DESC10" if v >= 500 else "DESC5_FRETE"
        return "RECUPE15" if v >= 800 else "DESC10_FRETE"

    assert {k: r.coupon_code for k, r in got.items()} == {k: expected(*k) for k in rows}
    assert {r.coupon_code for r in got.values()} == {o[0] for o in offers.COUPON_OFFERS}
    urgency = {r.p_abandonment: r.urgency_level for r in got.values()}
    assert urgency == {0.3999: "Baixa", 0.40: "Média", 0.6499: "Média", 0.65: "Alta", 0.8499: "Alta", 0.85: "Crítica"}
    for (p, v), r in got.items():
        wanted = 0.0 if p < 0.40 else v * 0.35 * (1 - r.discount_pct)
        assert r.estimated_recovered_gmv == pytest.approx(wanted)


def test_risks(grid):
    p = grid.select(
        "*",
        risk.heuristic_risk().alias("heuristic"),
        profiles.rule_a().alias("a"),
        profiles.rule_b().alias("b"),
        profiles.rule_c().alias("c"),
        risk.logistic_risk(profiles.rule_c()).alias("logistic"),
        risk.stream_risk().alias("stream"),
    )
    for r in p.collect():
        v, n, night = r.total_cart_value, r.num_views_before_cart, r.is_night
        h = 0.45 + (0.2 if v > 400 else 0) + (0.1 if night else 0) - (0.15 if n > 4 else 0)
        assert r.heuristic == pytest.approx(h)
        a = "high_intent" if n <= 3 else "bargain_hunter" if n >= 6 or night else "browser"
        b = "bargain_hunter" if n >= 6 else "high_intent" if n <= 3 else "browser"
        dear = night and v >= 400
        c = "high_intent" if n <= 3 and r.session_duration_sec < 90 else "bargain_hunter" if n >= 6 or dear else "browser"
        assert (r.a, r.b, r.c) == (a, b, c)
        odds = -0.3 + 1.2 * v / 1000 - 0.75 * n / 5 + 0.55 * (n <= 2) + 0.85 * night
        odds += 0.45 * (r.session_duration_sec < 45) + {"bargain_hunter": 0.65, "high_intent": -1.0}.get(c, 0)
        assert r.logistic == pytest.approx(min(0.95, max(0.05, 1 / (1 + math.exp(-odds)))), abs=0.00051)
        assert r.stream == (0.72 if n >= 5 or v > 250 else 0.42)


def test_prescription(spark):
    rows = [(p, v) for p in profiles.PROFILES for v in (299.99, 300.0, 399.99, 400.0)]
    df = spark.createDataFrame(rows, "profile string, total_cart_value double")
    got = {
        (r.profile, r.total_cart_value): (r.coupon_code, r.urgency_level)
        for r in scoring.with_prescription(df, F.col("profile")).collect()
    }
    assert got[("high_intent", 299.99)] == ("LEMBRETE_SEM_DESCONTO", "Média")
    assert got[("high_intent", 300.0)] == ("FRETE_GRATIS", "Média")
    assert got[("bargain_hunter", 399.99)] == ("DESC10_FRETE", "Alta")
    assert got[("bargain_hunter", 400.0)] == ("DESC15_VIP", "Alta")
    assert {got[("browser", v)] for v in (299.99, 400.0)} == {("DESC5_FRETE", "Média")}


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(0.1,), (100.1,), (35.3,)], "v double")
    got = df.select(
        offers.recovered_money(F.lit("FRETE_GRATIS"), F.col("v"), F.lit(0.0)).alias("m")
    ).collect()
    assert [str(r.m) for r in got] == ["0.04", "35.04", "12.36"]


def test_bands_and_prediction(spark):
    df = spark.createDataFrame([(0.39,), (0.4,), (0.5,), (0.649,), (0.65,)], "p double")
    got = df.select(risk.risk_band(F.col("p")), risk.predicted_abandoned(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("BAIXO RISCO", 0),
        ("RISCO MODERADO", 0),
        ("RISCO MODERADO", 1),
        ("RISCO MODERADO", 1),
        ("ALTO RISCO", 1),
    ]


def test_priority_queue_order(grid):
    scored = scoring.with_recovery(scoring.with_coupon(scoring.with_logistic_risk(grid)))
    rows = scoring.priority_queue(scored).collect()
    keys = [(r.urgency_rank, -r.total_cart_value, r.user_session) for r in rows]
    assert keys == sorted(keys) and rows
    assert all(r.is_abandoned == 1 and r.coupon_code != "NENHUM" for r in rows)


def test_model_probability_replaces_the_rule(grid):
    rows = scoring.score(grid, F.lit(0.9)).select("coupon_code").distinct().collect()
    assert {r.coupon_code for r in rows} == {"RECUPE15", "DESC10_FRETE"}
