from datetime import UTC, datetime

from pyspark.sql import functions as F

from cartlake.operators import triggers
from cartlake.operators.silver import silver_events
from tests.conftest import by, event
from tests.test_gold import hot_log

EARLY = "2024-01-01 10:00:00"


def edges():
    """Sessions named by what they buy and when, with a cart at 10:00:00."""
    bought = {
        "never": None,
        "before": "2024-01-01 09:59:59",
        "at t0": "2024-01-01 10:00:00",
        "at 5 min": "2024-01-01 10:05:00",
        "after 5 min": "2024-01-01 10:05:01",
        "at 1 h": "2024-01-01 11:00:00",
        "after 1 h": "2024-01-01 11:00:01",
    }
    events = []
    for name, when in bought.items():
        events.append(event(EARLY, "cart", name, price=100.0))
        if when:
            events.append(event(when, "purchase", name))
    events.append(event("2024-01-01 10:30:00", "cart", "never", price=50.0))
    events.append(event("2024-01-01 11:30:00", "cart", "never", price=999.0))
    events.append(event("2024-01-01 09:00:00", "view", "only views"))
    events.append(event("2024-01-02 00:00:00", "view", "end of log"))
    return events


FIVE = {"never", "before", "after 5 min", "at 1 h", "after 1 h"}
HOUR = {"never", "before", "after 1 h"}


def test_edges(bronze):
    silver = silver_events(bronze(edges()))
    five = by(triggers.trigger_5min(silver), "user_session")
    hour = by(triggers.trigger_1hour(silver), "user_session")
    assert set(five) == FIVE
    assert set(hour) == HOUR
    t0 = 1704103200
    assert {r.fires_at_sec for r in five.values()} == {t0 + 300}
    assert {r.fires_at_sec for r in hour.values()} == {t0 + 3600}
    assert five["never"].action_type == "PUSH_REMINDER"


def test_decision_uses_the_cart_at_one_hour(bronze):
    row = by(triggers.trigger_1hour(silver_events(bronze(edges()))), "user_session")["never"]
    assert (row.total_cart_value, row.num_cart_items, row.session_duration_sec) == (150.0, 2, 1800)
    assert (row.p_abandonment, row.predicted_abandoned) == (0.42, 0)
    assert (row.user_profile, row.coupon_code) == ("high_intent", "LEMBRETE_SEM_DESCONTO")
    assert row.estimated_recovered_gmv == 150.0
    before = by(triggers.trigger_1hour(silver_events(bronze(edges()))), "user_session")["before"]
    assert before.session_duration_sec == 1


def test_as_of(bronze):
    silver = silver_events(bronze(edges()))
    t0 = 1704103200
    assert triggers.trigger_5min(silver, F.lit(t0 + 299)).count() == 0
    assert triggers.trigger_5min(silver, F.lit(t0 + 300)).count() == len(FIVE)
    assert triggers.trigger_1hour(silver, F.lit(t0 + 3599)).count() == 0


def test_chain_is_both(bronze):
    silver = silver_events(bronze(edges()))
    rows = triggers.trigger_chain(silver).collect()
    assert len(rows) == len(FIVE) + len(HOUR)
    assert {r.trigger for r in rows} == {"CART_PLUS_5_MINUTES", "CART_PLUS_1_HOUR"}


def test_sample_trigger_input(spark):
    """A night cart with four views is a bargain hunter's."""
    fired = spark.createDataFrame(
        [("s", 386070015, "CART_PLUS_1_HOUR", 0, 19752, 1, 4, 5 * 3600 + 153, 5 * 3600)],
        "user_session string, user_id long, trigger string, fires_at_sec long, "
        "cents long, items long, views long, last_cart_sec long, first_sec long",
    )
    row = triggers.decisions(fired).first()
    assert (row.user_profile, row.coupon_code, row.total_cart_value) == ("bargain_hunter", "DESC10_FRETE", 197.52)
    assert (row.session_duration_sec, row.hour_of_day, row.is_night) == (153, 5, 1)


def seconds(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp())


def brute_force(events):
    """(session, trigger, time) and the cart of the one-hour decision, by loops."""
    sessions = {}
    for e in events:
        sessions.setdefault(e[7], []).append((seconds(e[0]), e))
    as_of = max(seconds(e[0]) for e in events)
    found = {}
    for name, rows in sessions.items():
        carts = [sec for sec, e in rows if e[1] == "cart"]
        if not carts:
            continue
        t0 = min(carts)
        bought = [sec for sec, e in rows if e[1] == "purchase"]
        for delay, trigger in triggers.TRIGGERS.items():
            due = t0 + delay
            if due > as_of or any(t0 <= sec <= due for sec in bought):
                continue
            kept = [e for sec, e in rows if sec <= t0 + 3600]
            value = round(sum(e[5] for e in kept if e[1] == "cart"), 2)
            items = sum(e[1] == "cart" for e in kept)
            views = sum(e[1] == "view" for e in kept)
            cart = (value, items, views) if delay == triggers.ONE_HOUR else None
            found[(name, trigger, due)] = cart
    return found


def test_hot_session_against_brute_force(bronze):
    events = hot_log(1200, seed=3)
    silver = silver_events(bronze(events))
    got = {(r.user_session, r.trigger, r.fires_at_sec): None for r in triggers.trigger_5min(silver).collect()}
    for r in triggers.trigger_1hour(silver).collect():
        cart = (r.total_cart_value, r.num_cart_items, r.num_views_before_cart)
        got[(r.user_session, r.trigger, r.fires_at_sec)] = cart
    assert got == brute_force(events)
