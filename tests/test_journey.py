import pytest

from cartlake.operators import journey
from cartlake.operators.silver import silver_events
from tests.conftest import by, event
from tests.test_gold import hot_log


def brute_force(events):
    numbered = sorted((e[0], i, e) for i, e in enumerate(events))
    rows = {}
    for user in {e[6] for _, _, e in numbered}:
        own = [(when, e) for when, _, e in numbered if e[6] == user]
        bought = [(when, e[7]) for when, e in own if e[1] == "purchase"]
        if not bought:
            continue
        first, session = bought[0]
        before = [e for when, e in own if when < first]
        other = [e for e in before if e[7] != session]
        carts = [e for e in other if e[1] == "cart"]
        rows[user] = (
            session,
            len({e[7] for e in carts}),
            len(carts),
            sum(e[1] == "view" for e in other),
            sum(e[1] == "view" and e[7] == session for e in before),
            len({e[7] for e in other}),
        )
    return rows


def test_hot_buyer_against_brute_force(bronze):
    events = hot_log(900, seed=8)
    # Purchases are rare, so that there is a way to the first one.
    events = [e for i, e in enumerate(events) if e[1] != "purchase" or i % 9 == 0]
    got = {
        r.user_id: (
            r.purchase_session,
            r.prior_cart_sessions,
            r.prior_cart_items,
            r.views_in_prior_sessions,
            r.views_in_final_session,
            r.total_prior_sessions,
        )
        for r in journey.buyer_journey(silver_events(bronze(events)), rows_per_task=60).collect()
    }
    assert got == brute_force(events)


@pytest.fixture
def small(bronze):
    return journey.buyer_journey(
        silver_events(
            bronze(
                [
                    event("2024-01-01 10:00:00", "view", "a"),
                    event("2024-01-01 10:01:00", "cart", "a"),
                    event("2024-01-01 10:02:00", "cart", "a"),
                    event("2024-01-02 09:00:00", "view", "b"),
                    event("2024-01-02 10:00:00", "purchase", "b"),
                    event("2024-01-02 10:00:00", "view", "b"),
                    event("2024-01-02 11:00:00", "view", "b"),
                    event("2024-01-05 10:00:00", "purchase", "c"),
                    event("2024-01-05 10:00:00", "purchase", "d", user=2),
                    event("2024-01-05 10:00:00", "cart", "e", user=3),
                ]
            )
        )
    )


def test_first_purchase_counts(small):
    rows = by(small, "user_id")
    assert set(rows) == {1, 2}
    first = rows[1]
    assert first.purchase_session == "b"
    assert (first.prior_cart_sessions, first.prior_cart_items) == (1, 2)
    assert (first.views_in_prior_sessions, first.views_in_final_session) == (1, 1)
    assert (first.total_views_before_purchase, first.total_prior_sessions) == (2, 1)
    assert first.journey_duration_hours == 24.0
    assert (rows[2].journey_duration_hours, rows[2].total_views_before_purchase) == (0.0, 0)


def test_statistics(small):
    rows = by(journey.journey_stats(small), "metric")
    hours = rows["journey_duration_hours"]
    assert (hours.buyers, hours.mean, hours.p50, hours.p90, hours.max) == (2, 12.0, 12.0, 21.6, 24.0)
    assert hours["std"] == pytest.approx(16.9706)
    shares = {r.prior_carts: (r.buyers, r.share_pct) for r in journey.prior_cart_distribution(small).collect()}
    assert shares == {0: (1, 50.0), 1: (1, 50.0)}
    direct = journey.direct_conversion(small).first()
    assert (direct.buyers, direct.direct_buyers, direct.direct_share) == (2, 1, 0.5)
    assert journey.approximate_journey_stats(small).count() == 3
