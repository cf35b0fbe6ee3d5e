import random

import pytest

from cartlake.operators import gold, scoring
from cartlake.operators.silver import silver_events
from tests.conftest import GOLDEN_SESSION, by, event, golden_events


def carts(bronze, events):
    return gold.gold_carts(silver_events(bronze(events)))


def test_golden_session(bronze):
    row = carts(bronze, golden_events()).first().asDict()
    expected = {
        "user_session": GOLDEN_SESSION,
        "user_id": 386070015,
        "num_cart_items": 1,
        "total_cart_value": 197.52,
        "max_item_price": 197.52,
        "min_item_price": 197.52,
        "avg_item_price": 197.52,
        "num_distinct_brands": 1,
        "num_distinct_categories": 1,
        "main_category": "electronics",
        "num_views_before_cart": 4,
        "view_to_cart_ratio": 4.0,
        "session_duration_sec": 108,
        "hour_of_day": 5,
        "day_of_week": 1,
        "is_weekend": 0,
        "is_night": 1,
        "user_prior_views": 0,
        "user_prior_carts": 0,
        "user_prior_abandoned_carts": 0,
        "user_total_cumulative_views": 4,
        "user_lifetime_hours": 0.0,
        "user_prior_abandon_rate": 0.5,
        "is_abandoned": 1,
    }
    assert {k: row[k] for k in expected} == expected


def test_golden_score(bronze):
    row = scoring.score(carts(bronze, golden_events())).first()
    assert row.p_abandonment == pytest.approx(0.55)
    assert row.coupon_code == "DESC5"
    assert row.estimated_recovered_gmv == pytest.approx(65.6754)
    assert float(row.recovered_money) == 65.68


@pytest.mark.parametrize(("hour", "night"), [(5, 1), (6, 0), (21, 0), (22, 1)])
def test_night_follows_the_last_cart(bronze, hour, night):
    row = carts(
        bronze,
        [event("2024-01-06 00:00:00", "cart"), event(f"2024-01-06 {hour:02d}:59:59", "cart")],
    ).first()
    assert (row.hour_of_day, row.is_night, row.day_of_week, row.is_weekend) == (hour, night, 5, 1)


def test_main_category(bronze):
    day = "2024-01-01 10:00:00"
    rows = by(
        carts(
            bronze,
            [
                event(day, "cart", "tie", category="b.x"),
                event(day, "cart", "tie", category="a.y"),
                event(day, "cart", "none", category=None, brand=None),
                event(day, "cart", "flat", category="plain"),
                event(day, "cart", "most", category="z.z"),
                event(day, "cart", "most", category="z.z"),
                event(day, "cart", "most", category="a.a"),
                event(day, "cart", "most", category=None),
                event(day, "cart", "most", category=None),
                event(day, "cart", "most", category=None),
                event(day, "view", "most", category="v.v", brand="other"),
            ],
        ),
        "user_session",
    )
    assert {s: r.main_category for s, r in rows.items()} == {
        "tie": "a",
        "none": "other",
        "flat": "plain",
        "most": "z",
    }
    assert (rows["none"].num_distinct_brands, rows["none"].num_distinct_categories) == (0, 0)
    assert (rows["most"].num_distinct_brands, rows["most"].num_distinct_categories) == (1, 2)


def test_one_session_of_two_users_is_one_cart(bronze):
    rows = carts(
        bronze,
        [
            event("2024-01-01 10:00:05", "cart", user=1),
            event("2024-01-01 10:00:00", "view", user=2),
            event("2024-01-01 10:00:00", "view", user=3),
        ],
    ).collect()
    assert [(r.user_id, r.num_cart_items, r.num_views_before_cart) for r in rows] == [(2, 1, 2)]


def test_history(bronze):
    rows = by(
        carts(
            bronze,
            [
                event("2024-01-01 10:00:00", "view", "a"),
                event("2024-01-01 10:01:00", "cart", "a"),
                event("2024-01-02 10:00:00", "view", "no cart"),
                event("2024-01-03 10:00:00", "purchase", "b"),
                event("2024-01-03 10:01:00", "cart", "b"),
                event("2024-01-03 22:00:00", "cart", "c"),
                event("2024-01-03 22:00:00", "view", "c"),
                event("2024-02-01 10:00:00", "cart", "d"),
                event("2024-01-15 10:00:00", "cart", "someone else", user=2),
            ],
        ),
        "user_session",
    )
    history = {
        s: (
            r.user_prior_views,
            r.user_prior_carts,
            r.user_prior_abandoned_carts,
            r.user_total_cumulative_views,
            r.user_lifetime_hours,
            r.user_prior_abandon_rate,
            r.is_abandoned,
        )
        for s, r in rows.items()
    }
    assert history == {
        "a": (0, 0, 0, 1, 0.0, 0.5, 1),
        "b": (1, 1, 1, 1, 48.0, 1.0, 0),
        "c": (1, 2, 1, 2, 60.0, 0.5, 1),
        "d": (2, 3, 2, 2, 31 * 24.0, pytest.approx(2 / 3), 1),
        "someone else": (0, 0, 0, 0, 0.0, 0.5, 1),
    }


def hot_log(n=1500, seed=5):
    """A third of all events belong to one buyer, half of these to one session."""
    rng = random.Random(seed)
    events = []
    for i in range(n):
        user = 1 if rng.random() < 1 / 3 else rng.randint(2, 40)
        session = f"{user}-hot" if user == 1 and rng.random() < 0.5 else f"{user}-{rng.randint(0, 30)}"
        when = f"2024-01-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00"
        kind = rng.choice(["view", "view", "cart", "purchase"])
        category = rng.choice([None, "a.b", "a.c", "d", "e.f"])
        brand = rng.choice([None, "x", "y", "z"])
        events.append((when, kind, i % 50, category, brand, round(rng.uniform(1, 900), 2), user, session))
    return events


def brute_force(events):
    """Gold by plain loops."""
    numbered = sorted(((e[0], i, e) for i, e in enumerate(events)))
    sessions = {}
    for when, i, e in numbered:
        sessions.setdefault(e[7], []).append((when, i, e))
    rows, seen = {}, {}
    ordered = sorted(sessions.items(), key=lambda item: (item[1][0][0], item[0]))
    for name, items in ordered:
        cart = [e for _, _, e in items if e[1] == "cart"]
        if not cart:
            continue
        user = items[0][2][6]
        views = sum(e[1] == "view" for _, _, e in items)
        abandoned = int(all(e[1] != "purchase" for _, _, e in items))
        prior = seen.setdefault(user, [0, 0, 0])
        names = [e[3] for e in cart if e[3]]
        top = min(set(names), key=lambda c: (-names.count(c), c)).split(".")[0] if names else "other"
        rows[name] = (
            user, len(cart), round(sum(e[5] for e in cart), 2), len({e[4] for e in cart} - {None}),
            len(set(names)), top, views, *prior, abandoned,
        )
        seen[user] = [prior[0] + views, prior[1] + 1, prior[2] + abandoned]
    return rows


def test_hot_keys_against_brute_force(bronze):
    events = hot_log()
    got = {
        r.user_session: (
            r.user_id, r.num_cart_items, r.total_cart_value, r.num_distinct_brands,
            r.num_distinct_categories, r.main_category, r.num_views_before_cart, r.user_prior_views,
            r.user_prior_carts, r.user_prior_abandoned_carts, r.is_abandoned,
        )
        for r in carts(bronze, events).collect()
    }
    assert got == brute_force(events)


def test_order_and_partitions_do_not_matter(bronze):
    raw = bronze(hot_log(400))
    once = sorted(gold.gold_carts(silver_events(raw.coalesce(1))).collect())
    again = sorted(gold.gold_carts(silver_events(raw.orderBy("price").repartition(7))).collect())
    assert once == again


def test_sessions_without_cart_on_request(bronze):
    events = silver_events(bronze([event("2024-01-01 10:00:00", "view")]))
    assert gold.session_base(events).count() == 0
    row = gold.session_base(events, carts_only=False).first()
    assert (row.num_cart_items, row.total_cart_value, row.session_duration_sec) == (0, None, None)
    filled = scoring.fill_defaults(gold.session_base(events, carts_only=False), scoring.MATRIX_DEFAULTS).first()
    assert (filled.total_cart_value, filled.session_duration_sec, filled.hour_of_day) == (100.0, 60, 0)


def test_cart_session_events(bronze):
    events = silver_events(
        bronze(
            [
                event("2024-01-01 10:00:00", "view", "a"),
                event("2024-01-01 10:00:01", "cart", "a"),
                event("2024-01-01 10:00:02", "cart", "a"),
                event("2024-01-01 10:00:00", "view", "b"),
            ]
        )
    )
    assert gold.cart_session_events(events).count() == 3
