"""The two reminders after a cart event, over a finished log.

A session's clock starts at its first cart event, t0. After a delay the reminder
fires unless the session bought something between t0 and the deadline, both
included. A purchase before t0 does not count.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import offers, profiles, risk
from cartlake.functions.events import CART, PURCHASE, VIEW, event_order, from_cents, night_flag, to_cents
from cartlake.operators import learning
from cartlake.operators.learning import Forests
from cartlake.operators.running import running_totals
from cartlake.operators.scoring import with_prescription
from cartlake.operators.skew import salted_join
from cartlake.session import stage

# Delays and texts of the two triggers.
FIVE_MINUTES = 300
ONE_HOUR = 3600
TRIGGERS = {FIVE_MINUTES: "CART_PLUS_5_MINUTES", ONE_HOUR: "CART_PLUS_1_HOUR"}
TIME_WINDOWS = {FIVE_MINUTES: "5 minutos após cart", ONE_HOUR: "1 hora após cart"}
REMINDER_ACTION = "PUSH_REMINDER"
REMINDER_TITLE = "🛒 Seu carrinho está te esperando na Shopee!"
REMINDER_BODY = (
    "Olá! Notei que você deixou produtos incríveis no carrinho. "
    "Realize sua compra! Olha o seu produto aqui te esperando!"
)
REMINDER_STATUS = "DISPARADO"
DECISION_STATUS = "DISPARADO_COM_ML"


def session_seconds(silver: DataFrame) -> DataFrame:
    """Events summed per session and second: a session of any size shrinks to at
    most one row per second of the log before its rows are ordered together."""
    sec = F.unix_seconds("event_time_ts")
    kind = F.col("event_type")
    order = event_order(sec, F.col("event_id"))
    return silver.groupBy("user_session", sec.alias("sec")).agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("items"),
        F.count_if(kind == PURCHASE).alias("purchases"),
        F.sum(F.when(kind == CART, to_cents(F.col("price")))).alias("cents"),
        F.min(order).alias("first_order"),
        F.min_by("user_id", order).alias("owner"),
    )


def clocks(silver: DataFrame) -> DataFrame:
    """Per cart session: t0, the first purchase since, and the cart as it stood
    one hour after t0 - later events would leak into the decision. The salted join
    keeps a session with very many seconds out of a single task."""
    sec = F.unix_seconds("event_time_ts")
    starts = silver.where(F.col("event_type") == CART).groupBy("user_session").agg(F.min(sec).alias("t0"))
    started = salted_join(session_seconds(silver), starts, "user_session", F.col("sec"))
    in_time = F.col("sec") <= F.col("t0") + ONE_HOUR
    return started.groupBy("user_session").agg(
        F.min_by("owner", "first_order").alias("user_id"),
        F.min("t0").alias("t0"),
        F.min(F.when((F.col("purchases") > 0) & (F.col("sec") >= F.col("t0")), F.col("sec"))).alias("bought_sec"),
        F.min("sec").alias("first_sec"),
        F.max(F.when(in_time & (F.col("items") > 0), F.col("sec"))).alias("last_cart_sec"),
        F.sum(F.when(in_time, F.col("items")).otherwise(0)).alias("items"),
        F.sum(F.when(in_time, F.col("cents"))).alias("cents"),
        F.sum(F.when(in_time, F.col("views")).otherwise(0)).alias("views"),
    )


def last_event_sec(silver: DataFrame) -> Column:
    return silver.agg(F.max(F.unix_seconds("event_time_ts"))).scalar()


def fired(clock_rows: DataFrame, delays: list[int], as_of: Column) -> DataFrame:
    """One row per clock and delay whose trigger has fired."""
    timers = clock_rows.withColumn("delay", F.explode(F.array(*map(F.lit, delays))))
    deadline = F.col("t0") + F.col("delay")
    unsold = F.col("bought_sec").isNull() | (F.col("bought_sec") > deadline)
    return timers.where(unsold & (deadline <= as_of)).withColumns(
        {
            "trigger": F.when(F.col("delay") == FIVE_MINUTES, TRIGGERS[FIVE_MINUTES]).otherwise(
                TRIGGERS[ONE_HOUR]
            ),
            "fires_at_sec": deadline,
        }
    )


def reminders(fired_rows: DataFrame) -> DataFrame:
    """The five-minute message: a friendly reminder without a discount."""
    return fired_rows.select(
        "user_session",
        "user_id",
        "trigger",
        F.lit(TIME_WINDOWS[FIVE_MINUTES]).alias("time_window"),
        "fires_at_sec",
        F.lit(REMINDER_ACTION).alias("action_type"),
        F.lit(REMINDER_TITLE).alias("message_title"),
        F.lit(REMINDER_BODY).alias("message_body"),
        F.lit(REMINDER_STATUS).alias("status"),
    )


def buyer_seconds(silver: DataFrame) -> DataFrame:
    """Each buyer's own views and cart events per session and second."""
    kind = F.col("event_type")
    rows = silver.groupBy("user_id", "user_session", F.unix_seconds("event_time_ts").alias("sec"))
    counted = rows.agg(F.count_if(kind == VIEW).alias("views"), F.count_if(kind == CART).alias("carts"))
    return counted.where((F.col("views") > 0) | (F.col("carts") > 0))


def with_buyer_history(carts: DataFrame, seconds: DataFrame) -> DataFrame:
    """Add ``user_prior_carts`` and ``user_prior_views`` as they stood at each deadline.

    Of the buyer's other sessions those count in which the buyer had filled a cart by then, and
    their views up to then: an as-of join of ``carts`` (user_id, user_session, fires_at_sec) with
    the buyer's running totals. No event after the deadline counts, whenever it arrived. A view
    counts from the second in which its session has a cart. The totals are built per buyer and
    hour, so no task orders all seconds of one buyer.
    """
    key = ["user_id", "user_session"]
    begun = seconds.where(F.col("carts") > 0).groupBy(*key).agg(F.min("sec").alias("begun"))
    known = stage(
        seconds.join(begun, key).select(
            *key,
            F.greatest("sec", "begun").alias("at"),
            "views",
            F.when(F.col("sec") == F.col("begun"), 1).otherwise(0).cast("long").alias("begins"),
        ),
        "buyer-facts",
    )
    asked = stage(carts.select(*key, F.col("fires_at_sec").alias("at")).distinct(), "deadlines")
    facts = known.groupBy("user_id", "at").agg(F.sum("views").alias("views"), F.sum("begins").alias("begins"))
    nothing = F.lit(0).cast("long")
    # At one second facts come first: the deadline itself counts.
    line = facts.select("user_id", "at", "views", "begins", F.lit(0).alias("asks"), F.lit("").alias("user_session"))
    line = line.unionByName(
        asked.select("user_id", "at", nothing.alias("views"), nothing.alias("begins"), F.lit(1).alias("asks"), "user_session")
    )
    totals = running_totals(
        line, ["user_id"], F.floor(F.col("at") / ONE_HOUR), ["at", "asks", "user_session"],
        sums={"all_views": "views", "all_carts": "begins"},
    ).where(F.col("asks") == 1)
    own = known.withColumnRenamed("at", "sec").join(asked, key).where(F.col("sec") <= F.col("at"))
    own = own.groupBy(*key, "at").agg(F.sum("views").alias("own_views"), F.sum("begins").alias("own_carts"))
    history = totals.join(own, [*key, "at"], "left").select(
        *key,
        F.col("at").alias("fires_at_sec"),
        (F.col("all_views") - F.coalesce("own_views", nothing)).alias("user_prior_views"),
        (F.col("all_carts") - F.coalesce("own_carts", nothing)).alias("user_prior_carts"),
    )
    return carts.join(history, [*key, "fires_at_sec"])


def decision_carts(fired_rows: DataFrame) -> DataFrame:
    """The cart of each fired one-hour trigger as it stood at the deadline."""
    last_cart = F.timestamp_seconds("last_cart_sec")
    return fired_rows.select(
        "user_session",
        "user_id",
        "trigger",
        F.lit(TIME_WINDOWS[ONE_HOUR]).alias("time_window"),
        "fires_at_sec",
        from_cents(F.col("cents")).alias("total_cart_value"),
        F.col("items").cast("int").alias("num_cart_items"),
        F.col("views").cast("int").alias("num_views_before_cart"),
        F.round(F.col("views") / F.greatest(F.col("items"), F.lit(1)), 2).alias("view_to_cart_ratio"),
        (F.col("last_cart_sec") - F.col("first_sec")).alias("session_duration_sec"),
        F.hour(last_cart).alias("hour_of_day"),
        night_flag(F.hour(last_cart)).alias("is_night"),
    )


def decisions(
    fired_rows: DataFrame, p: Column | None = None, profile: Column | None = None
) -> DataFrame:
    """The one-hour decision: features of the cart, risk, profile and offer. The
    rules stand in where no model's risk or profile is given."""
    p = risk.stream_risk() if p is None else p
    return decided(decision_carts(fired_rows).withColumn("p_abandonment", p), profile)


def forest_decisions(fired_rows: DataFrame, seconds: DataFrame, forests: Forests) -> DataFrame:
    """The one-hour decision by the two trained forests, from all nine features."""
    carts = with_buyer_history(decision_carts(fired_rows), seconds)
    return decided(learning.judged_by(forests, carts), F.col("predicted_profile")).drop("predicted_profile")


def decided(carts: DataFrame, profile: Column | None = None) -> DataFrame:
    """Profile and offer of carts with ``p_abandonment``."""
    offered = with_prescription(carts, profiles.rule_a() if profile is None else profile)
    p = F.col("p_abandonment")
    return offered.withColumns(
        {
            "ml_abandonment_risk_pct": F.round(p * 100, 1),
            "predicted_abandoned": risk.predicted_abandoned(p),
            "estimated_recovered_gmv": offers.stream_recovered_gmv(p, F.col("total_cart_value")),
            "status": F.lit(DECISION_STATUS),
        }
    )


def trigger_5min(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    as_of = last_event_sec(silver) if as_of is None else as_of
    return reminders(fired(clocks(silver), [FIVE_MINUTES], as_of))


def trigger_1hour(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    as_of = last_event_sec(silver) if as_of is None else as_of
    return decisions(fired(clocks(silver), [ONE_HOUR], as_of))


def actions(fired_rows: DataFrame, seconds: DataFrame | None = None, forests: Forests | None = None) -> DataFrame:
    """Fired triggers of either kind as one list of actions, from one pass. With ``forests``
    they decide after an hour, and ``seconds`` gives the buyers' history."""
    decided_rows = decisions(fired_rows) if forests is None else forest_decisions(fired_rows, seconds, forests)
    reminder = F.col("trigger") == TRIGGERS[FIVE_MINUTES]
    return decided_rows.select(
        "user_session",
        "user_id",
        "trigger",
        "fires_at_sec",
        F.when(reminder, REMINDER_ACTION).otherwise(F.col("coupon_code")).alias("action"),
        F.when(reminder, REMINDER_BODY).otherwise(F.col("coupon_label")).alias("shown"),
        F.when(reminder, REMINDER_STATUS).otherwise(DECISION_STATUS).alias("status"),
    )


def trigger_chain(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Both triggers of each session."""
    as_of = last_event_sec(silver) if as_of is None else as_of
    return actions(fired(clocks(silver), [FIVE_MINUTES, ONE_HOUR], as_of))


def decision_features(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The nine features of the training table for each fired one-hour trigger."""
    as_of = last_event_sec(silver) if as_of is None else as_of
    carts = decision_carts(fired(clocks(silver), [ONE_HOUR], as_of))
    rows = with_buyer_history(stage(carts, "decision-carts"), buyer_seconds(silver))
    return rows.select("user_session", "user_id", "fires_at_sec", *learning.TRAINING_FEATURES)
