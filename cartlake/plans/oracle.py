"""The registered queries as DuckDB SQL over the given tables."""

from cartlake.functions.offers import COUPON_OFFERS, PROFILE_OFFERS
from cartlake.operators.triggers import (
    DECISION_STATUS,
    REMINDER_ACTION,
    REMINDER_BODY,
    REMINDER_STATUS,
    REMINDER_TITLE,
)
from cartlake.plans.oracle_parts import FROM_BASE, FROM_BRONZE, FROM_GOLD, FROM_SILVER
from cartlake.schemas import GOLD_COLUMNS, NUMERIC_FEATURES

ONE_USER = 7
TWO_USERS = "(3, 7)"


def literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, bool):
        return str(value).lower()
    return f"{value}::double"


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name} as (select * from (values {body}) as t({columns}))"


SILVER_OUTPUT = (
    "event_id, event_time, event_type, product_id, category_id, category_code, brand, price, "
    "user_id, user_session, hour_of_day, is_night"
)
CART_KEYS = "user_session, user_id, total_cart_value, num_views_before_cart, hour_of_day, is_night"
OFFER_COLUMNS = "coupon_code, coupon_label, discount_pct, free_shipping, urgency_level, rationale"
MATRIX = (
    "user_session, user_id, total_cart_value, is_abandoned, p_abandonment, coupon_code, "
    "coupon_label, urgency_level"
)
GOLD_OUTPUT = ", ".join(GOLD_COLUMNS)
BASE_NAMES = [c for c in GOLD_COLUMNS if not c.startswith("user_") or c in ("user_session", "user_id")]
BASE_OUTPUT = ", ".join(BASE_NAMES)

OFFERS = values(
    "offer_list",
    "coupon_code, coupon_label, discount_pct, free_shipping, urgency_level, rationale",
    COUPON_OFFERS,
)
PROFILE_OFFER_LIST = values(
    "profile_offer_list",
    "user_profile, profile_name_pt, coupon_code, coupon_label, discount_pct, free_shipping, "
    "urgency_level, rationale",
    PROFILE_OFFERS,
)

RULE_A = """case when num_views_before_cart <= 3 then 'high_intent'
  when num_views_before_cart >= 6 or is_night = 1 then 'bargain_hunter' else 'browser' end"""
RULE_B = """case when num_views_before_cart >= 6 then 'bargain_hunter'
  when num_views_before_cart <= 3 then 'high_intent' else 'browser' end"""
RULE_C = """case when num_views_before_cart <= 3 and session_duration_sec < 90 then 'high_intent'
  when num_views_before_cart >= 6 or (is_night = 1 and total_cart_value >= 400)
  then 'bargain_hunter' else 'browser' end"""
HEURISTIC = """least(0.95::double, greatest(0.1::double,
  0.45::double + case when total_cart_value > 400 then 0.2::double else 0::double end
  + case when is_night = 1 then 0.1::double else 0::double end
  - case when num_views_before_cart > 4 then 0.15::double else 0::double end))"""
LOG_ODDS = """(-0.3::double + total_cart_value / 1000::double * 1.2::double
  - num_views_before_cart / 5::double * 0.75::double
  + case when num_views_before_cart <= 2 then 0.55::double else 0::double end
  + case when hour_of_day >= 22 or hour_of_day < 6 then 0.85::double else 0::double end
  + case when session_duration_sec < 45 then 0.45::double else 0::double end
  + case user_profile when 'bargain_hunter' then 0.65::double
      when 'high_intent' then -1::double else 0::double end)"""
STREAM_RISK = """case when num_views_before_cart >= 5 or total_cart_value > 250
  then 0.72::double else 0.42::double end"""
COUPON_CODE = """case when p_abandonment < 0.4::double then 'NENHUM'
  when p_abandonment < 0.65::double then
    case when total_cart_value >= 300 then 'FRETE_GRATIS' else 'DESC5' end
  when p_abandonment < 0.85::double then
    case when total_cart_value >= 500 then 'DESC10' else 'DESC5_FRETE' end
  else case when total_cart_value >= 800 then 'RECUPE15' else 'DESC10_FRETE' end end"""
PROFILE_CODE = """case user_profile
  when 'high_intent' then case when total_cart_value >= 300 then 'FRETE_GRATIS'
    else 'LEMBRETE_SEM_DESCONTO' end
  when 'bargain_hunter' then case when total_cart_value >= 400 then 'DESC15_VIP'
    else 'DESC10_FRETE' end
  else 'DESC5_FRETE' end"""
DECIMAL_VALUE = "cast(total_cart_value as decimal(18,2))"
STREAM_RECOVERED = f"""cast(round({DECIMAL_VALUE}
  * case when p_abandonment >= 0.5::double then 0.85 else 1.00 end, 2) as double)"""

LOGISTIC = f"""
labelled as (select *, {RULE_C} as user_profile from base),
risky as (
  select *, greatest(0.05::double, least(0.95::double,
    round(1::double / (1::double + exp(-{LOG_ODDS})), 3))) as p_abandonment
  from labelled)"""


def offered(source: str, name: str) -> str:
    """The offer of each cart in ``source``, which has p_abandonment."""
    return f"""
{OFFERS},
coded_{name} as (select *, {COUPON_CODE} as coupon_code from {source}),
{name} as (
  select c.*, o.coupon_label, o.discount_pct, o.free_shipping, o.urgency_level, o.rationale,
    case when c.coupon_code <> 'NENHUM'
      then total_cart_value * 0.35::double * (1::double - discount_pct)
      else 0::double end as estimated_recovered_gmv,
    case when c.coupon_code <> 'NENHUM'
      then cast(round({DECIMAL_VALUE} * 0.35 * (1 - cast(discount_pct as decimal(4,2))), 2)
        as decimal(18,2)) else 0 end as recovered_money,
    total_cart_value * discount_pct as discount_value
  from coded_{name} c join offer_list o on o.coupon_code = c.coupon_code)"""


FROM_LOGISTIC = FROM_BASE + "," + LOGISTIC + "," + offered("risky", "scored")
FROM_HEURISTIC_GOLD = (
    FROM_GOLD + f", judged as (select *, {HEURISTIC} as p_abandonment from gold)," + offered("judged", "scored")
)

SQL: dict[str, str] = {}

# --- layers -----------------------------------------------------------------

SQL["bronze_events"] = f"{FROM_BRONZE} select * from bronze"
SQL["silver_events"] = (
    f"{FROM_SILVER} select {SILVER_OUTPUT}, event_time_clean, sec as event_time_sec from silver"
)
SQL["silver_quality_report"] = f"""{FROM_BRONZE}
select case
    when try_strptime(substr(event_time, 1, 19), '%Y-%m-%d %H:%M:%S') is null then 'bad_time'
    when product_id is null or user_id is null or user_session is null then 'missing_key'
    when price is null or price <= 0 or not isfinite(price) then 'bad_price'
    when event_type is null or event_type not in ('view', 'cart', 'purchase') then 'bad_type'
    else 'accepted' end as outcome,
  count(*) as events
from bronze group by 1"""
# Every event arrives twice; content that occurs more than once keeps its lowest id.
SQL["silver_dedup"] = f"""{FROM_SILVER}
select min(event_id) as event_id, event_time, event_type, product_id, category_id, category_code,
  brand, price, user_id, user_session, hour_of_day, is_night
from silver group by all"""
SQL["sampled_load"] = f"""{FROM_BRONZE}
select * from bronze
qualify row_number() over (partition by event_id % 3 order by event_time, event_id) <= 100"""
SQL["partitioned_silver"] = f"""{FROM_SILVER}
select cast(year(t) as integer) as year, cast(month(t) as integer) as month, count(*) as events,
  cast(sum(cast(price as decimal(18,2))) as double) as amount
from silver group by 1, 2"""
SQL["fact_events"] = f"""{FROM_SILVER}
select event_id, event_time_clean as event_time, event_type, product_id, user_id, user_session,
  cast(cast(price as decimal(10,2)) as double) as price, hour_of_day, is_night
from silver"""
SQL["user_events"] = f"{FROM_BRONZE} select * from bronze where user_id = {ONE_USER}"
SQL["events_excluding_users"] = (
    f"{FROM_SILVER} select {SILVER_OUTPUT} from silver where user_id not in {TWO_USERS}"
)
SQL["cart_session_events"] = f"""{FROM_SILVER} select {SILVER_OUTPUT} from silver
where user_session in (select user_session from silver where event_type = 'cart')"""
SQL["gold_cart_base"] = f"{FROM_BASE} select {BASE_OUTPUT} from base"
SQL["main_category"] = f"{FROM_BASE} select user_session, main_category from base"
SQL["gold_cart"] = f"{FROM_GOLD} select {GOLD_OUTPUT} from gold"

# --- exploring the layers ---------------------------------------------------

SQL["layer_sample_bronze"] = f"""{FROM_BRONZE}
select event_id, event_time, event_type, product_id, category_id,
  coalesce(category_code, '') as category_code, coalesce(brand, '') as brand, price, user_id,
  user_session
from bronze order by event_time, event_id limit 100"""
SQL["layer_sample_silver"] = f"""{FROM_SILVER}
select event_id, event_time, event_type, product_id, category_code, brand, price, user_id,
  user_session, hour_of_day
from silver order by event_time, event_id limit 100"""
SQL["layer_sample_gold"] = (
    f"{FROM_GOLD} select {GOLD_OUTPUT} from gold order by first_event_sec, user_session limit 100"
)
SQL["layer_filter"] = f"{FROM_SILVER} select {SILVER_OUTPUT} from silver where event_type = 'cart'"
SQL["layer_search"] = f"""{FROM_SILVER} select {SILVER_OUTPUT} from silver
where contains(lower(concat_ws('|', {SILVER_OUTPUT})), 'economy.gear')"""
SQL["layer_sort_page"] = f"""{FROM_BASE},
listing as (select {BASE_OUTPUT} from base where is_abandoned = 1),
third as (select * from listing order by main_category desc, user_session limit 10 offset 20),
final as (select * from listing order by total_cart_value, user_session
  limit 25 offset (select greatest((count(*) - 1) // 25, 0) * 25 from listing))
select * from third union all select * from final"""
SQL["matrix_filter"] = f"""{FROM_LOGISTIC} select {MATRIX} from scored
where is_abandoned = 1 and urgency_level = 'Crítica'
  and (contains(lower(user_session), 'frete') or contains(cast(user_id as varchar), 'frete')
    or contains(lower(coupon_label), 'frete'))"""
SQL["priority_pinned_carts"] = f"""{FROM_LOGISTIC}
select case when user_id in {TWO_USERS} then 0 else 1 end as priority, {MATRIX} from scored"""
SQL["user_360"] = f"""{FROM_HEURISTIC_GOLD}
select {GOLD_OUTPUT}, p_abandonment, {OFFER_COLUMNS},
  cast(recovered_money as double) as recovered_gmv
from scored where user_id = {ONE_USER}"""

# --- defaults ---------------------------------------------------------------

SQL["conform_features"] = (
    f"{FROM_BASE} select user_session, user_id, main_category, "
    + ", ".join(f"cast({c} as double) as {c}" for c in NUMERIC_FEATURES if c in BASE_NAMES)
    + ", "
    + ", ".join(f"0::double as {c}" for c in NUMERIC_FEATURES if c not in BASE_NAMES)
    + " from base"
)
FILLED = {
    "total_cart_value": "100::double",
    "num_cart_items": "1",
    "num_views_before_cart": "1",
    "view_to_cart_ratio": "1::double",
    "session_duration_sec": "60",
    "is_night": "0",
    "is_abandoned": "1",
}
TEXTS = ("user_session", "main_category")
FILLED_COLUMNS = ", ".join(
    c if c in TEXTS else f"coalesce({c}, {FILLED.get(c, '0')}) as {c}" for c in BASE_NAMES
)
SQL["fill_defaults"] = f"{FROM_BASE} select {FILLED_COLUMNS} from sessions"
SQL["validated_matrix"] = f"""{FROM_BASE},
filled as (select {FILLED_COLUMNS} from sessions),
judged as (select *, {HEURISTIC} as p_abandonment from filled),
{offered("judged", "scored")}
select user_session as session_id, user_id, round(total_cart_value, 2) as total_val,
  num_cart_items, num_views_before_cart, hour_of_day, round(p_abandonment, 4) as p_abandonment,
  is_abandoned, coupon_code, cast(recovered_money as double) as recovered_gmv
from scored"""

# --- counts and rates -------------------------------------------------------

LOST = "filter (is_abandoned = 1)"
GMV = f"cast(sum({DECIMAL_VALUE}) as double)"
SQL["cart_kpis"] = f"""{FROM_BASE}
select count(*) as total_carts, count(*) {LOST} as abandoned_carts,
  round(count(*) {LOST} / count(*), 4) as abandonment_rate,
  {GMV} as total_gmv,
  cast(sum({DECIMAL_VALUE}) {LOST} as double) as gmv_lost
from base"""
SQL["recovery_kpis"] = f"""{FROM_LOGISTIC}
select count(*) filter (is_abandoned = 1 and coupon_code <> 'NENHUM') as coupon_eligible,
  cast(sum({DECIMAL_VALUE}) {LOST} as double) as gmv_abandoned,
  cast(sum(recovered_money) filter (is_abandoned = 1 and coupon_code <> 'NENHUM') as double)
    as gmv_recovered
from scored"""
SQL["gmv_at_risk"] = f"""{FROM_LOGISTIC},
totals as (
  select {GMV} as gmv_total,
    cast(coalesce(sum({DECIMAL_VALUE}) filter (p_abandonment >= 0.5::double), 0) as double)
      as gmv_at_risk,
    cast(sum(recovered_money) as double) as gmv_recovered
  from scored)
select *, round(gmv_recovered / greatest(1, gmv_at_risk), 4) as recovery_rate from totals"""
COUNTS = """count(*) filter (event_type = 'view') as views,
  count(*) filter (event_type = 'cart') as carts,
  count(*) filter (event_type = 'purchase') as purchases"""
SQL["funnel"] = f"{FROM_SILVER} select {COUNTS} from silver"
SQL["funnel_from_gold"] = f"""{FROM_BASE}
select cast(floor(sum(num_views_before_cart) * 3.5) as bigint) as views, count(*) as carts,
  count(*) filter (is_abandoned = 0) as purchases
from base"""
SQL["funnel_metrics_daily"] = f"""{FROM_SILVER},
days as (select strftime(t, '%Y-%m-%d') as day, {COUNTS} from silver group by 1)
select *, round(carts / nullif(views, 0), 4) as view_to_cart_rate,
  round(purchases / nullif(carts, 0), 4) as cart_to_purchase_rate
from days"""
SQL["hourly_abandonment"] = f"""{FROM_BASE}
select hour_of_day, count(*) as carts, round(count(*) {LOST} / count(*), 3) as abandonment_rate
from base group by hour_of_day"""
SQL["top_abandoned_categories"] = f"""{FROM_BASE}
select main_category, count(*) as carts from base where is_abandoned = 1
group by main_category order by carts desc, main_category limit 5"""
RATES = f"""count(*) as carts, count(*) {LOST} as abandoned,
  round(count(*) {LOST} / count(*), 4) as abandonment_rate,
  round(count(*) filter (is_abandoned = 0) / count(*), 4) as conversion_rate"""
SQL["conversion_by_category"] = (
    f"{FROM_BASE} select main_category, {RATES} from base group by main_category"
)
SQL["conversion_by_brand"] = f"""{FROM_SILVER},
brands as (
  select brand, {COUNTS},
    cast(coalesce(sum(cast(price as decimal(18,2))) filter (event_type = 'purchase'), 0) as double)
      as revenue
  from silver group by brand)
select *, round(purchases / nullif(carts, 0), 4) as cart_to_purchase_rate from brands"""
SQL["price_band_abandonment"] = f"""{FROM_BASE}
select case when total_cart_value >= 800 then 800 when total_cart_value >= 500 then 500
    when total_cart_value >= 400 then 400 when total_cart_value >= 300 then 300
    when total_cart_value >= 100 then 100 else 0 end as value_from, {RATES}
from base group by 1"""
SQL["abandonment_by_prior_carts"] = f"""{FROM_GOLD}
select cast(least(user_prior_carts, 3) as integer) as prior_carts, {RATES} from gold group by 1"""
SQL["prior_activity_stats"] = f"""{FROM_GOLD}
select round(avg(user_prior_views), 4) as prior_views_mean,
  round(avg(user_prior_carts), 4) as prior_carts_mean,
  quantile_cont(user_prior_views, 0.5) as prior_views_median,
  quantile_cont(user_prior_carts, 0.5) as prior_carts_median
from gold"""
SQL["uniques"] = f"""{FROM_SILVER}
select count(distinct user_id) as buyers, count(distinct user_session) as sessions,
  count(*) as events
from silver"""
DAYS = f"""{FROM_LOGISTIC},
daily as (
  select strftime(make_timestamp(last_cart_sec * 1000000), '%Y-%m-%d') as day,
    count(*) as carts, count(*) {LOST} as abandoned, sum(num_views_before_cart) as views,
    sum({DECIMAL_VALUE}) as gmv, coalesce(sum({DECIMAL_VALUE}) {LOST}, 0) as lost,
    coalesce(sum(recovered_money) {LOST}, 0) as recovered
  from scored group by 1)"""
SQL["sketched_uniques"] = f"""{FROM_SILVER},
days as (select distinct cast(t as date) as until from silver)
select strftime(until, '%Y-%m-%d') as day, count(*) as events, count(distinct user_id) as buyers,
  count(distinct user_session) as sessions, true as buyers_near, true as sessions_near, true as median_near
from days join silver on cast(t as date) between until - 6 and until
group by until"""
SQL["kpi_increment"] = f"""{DAYS},
running as (
  select day, cast(sum(carts) over w as bigint) as total_carts,
    cast(sum(abandoned) over w as bigint) as abandoned_carts,
    cast(sum(gmv) over w as double) as total_gmv, cast(sum(lost) over w as double) as gmv_lost,
    cast(sum(recovered) over w as double) as gmv_recovered
  from daily window w as (order by day))
select *, round(abandoned_carts / total_carts, 4) as abandonment_rate from running"""
SQL["running_mean"] = f"""{DAYS}
select day, cast(sum(carts) over w as bigint) as carts,
  round(cast(sum(views) over w as double) / cast(sum(carts) over w as double), 2) as mean_views
from daily window w as (order by day)"""

# --- journey ----------------------------------------------------------------

JOURNEY = """
firsts as (
  select user_id, sec as purchase_sec, user_session as purchase_session,
    row_number() over (partition by user_id order by sec, event_id) as place
  from silver where event_type = 'purchase'),
touch as (select user_id, min(sec) as first_sec from silver group by user_id),
before_purchase as (
  select f.user_id, s.user_session, s.event_type,
    s.user_session <> f.purchase_session as other
  from firsts f join silver s on s.user_id = f.user_id and s.sec < f.purchase_sec
  where f.place = 1),
counted as (
  select user_id,
    count(distinct user_session) filter (other and event_type = 'cart') as prior_cart_sessions,
    count(*) filter (other and event_type = 'cart') as prior_cart_items,
    count(*) filter (other and event_type = 'view') as views_in_prior_sessions,
    count(*) filter (not other and event_type = 'view') as views_in_final_session,
    count(distinct user_session) filter (other) as total_prior_sessions
  from before_purchase group by user_id),
journey as (
  select f.user_id, purchase_session,
    coalesce(prior_cart_sessions, 0) as prior_cart_sessions,
    coalesce(prior_cart_items, 0) as prior_cart_items,
    coalesce(views_in_prior_sessions, 0) as views_in_prior_sessions,
    coalesce(views_in_final_session, 0) as views_in_final_session,
    coalesce(total_prior_sessions, 0) as total_prior_sessions,
    ((purchase_sec - first_sec) * 100 + 1800) // 3600 / 100 as journey_duration_hours,
    coalesce(views_in_prior_sessions, 0) + coalesce(views_in_final_session, 0)
      as total_views_before_purchase
  from firsts f join touch t on t.user_id = f.user_id
  left join counted c on c.user_id = f.user_id
  where f.place = 1)"""
FROM_JOURNEY = f"{FROM_SILVER}, {JOURNEY}"
SQL["buyer_journey"] = f"{FROM_JOURNEY} select * from journey"


def statistics(metric: str) -> str:
    quantiles = ", ".join(
        f"round(cast(quantile_cont({metric}, {share}) as double), 4) as p{round(share * 100)}"
        for share in (0.25, 0.5, 0.75, 0.9)
    )
    return f"""select '{metric}' as metric, count(*) as buyers, round(avg({metric}), 4) as mean,
  round(stddev_samp({metric}), 4) as std, round(cast(min({metric}) as double), 4) as min,
  round(cast(max({metric}) as double), 4) as max, {quantiles} from journey"""


SQL["journey_stats"] = f"{FROM_JOURNEY} " + " union all ".join(
    statistics(m)
    for m in ("total_views_before_purchase", "prior_cart_sessions", "journey_duration_hours")
)
SQL["prior_cart_distribution"] = f"""{FROM_JOURNEY}
select cast(least(prior_cart_sessions, 4) as integer) as prior_carts, count(*) as buyers,
  round(count(*) * 100 / (select count(*) from journey), 1) as share_pct
from journey group by 1"""
SQL["direct_conversion"] = f"""{FROM_JOURNEY}
select count(*) as buyers, count(*) filter (prior_cart_sessions = 0) as direct_buyers,
  round(count(*) filter (prior_cart_sessions = 0) / count(*), 4) as direct_share
from journey"""



def figures(section: str, sql: str, **columns: str) -> str:
    parts = " union all ".join(
        f"select '{section}' as section, '{name}' as name, cast({column} as double) as value from found"
        for name, column in columns.items()
    )
    return f"(with found as ({sql}) {parts})"


def by_name(section: str, sql: str, name: str, value: str) -> str:
    return f"(select '{section}' as section, cast({name} as varchar) as name, cast({value} as double) as value from ({sql}))"


CARDS = f"""{FROM_HEURISTIC_GOLD},
cards as (
  select user_session, total_cart_value, row_number() over (order by
    case urgency_level when 'Crítica' then 0 when 'Alta' then 1 when 'Média' then 2 when 'Baixa' then 3 else 4 end,
    total_cart_value desc, user_session) as place
  from scored where is_abandoned = 1 and coupon_code <> 'NENHUM')
select place || ' ' || user_session as name, round(total_cart_value, 2) as value from cards where place <= 50"""
RECOVERY = f"""{FROM_HEURISTIC_GOLD}
select count(*) filter (is_abandoned = 1 and coupon_code <> 'NENHUM') as eligible,
  sum(recovered_money) filter (is_abandoned = 1 and coupon_code <> 'NENHUM') as recovered from scored"""
COUPONS = f"{FROM_HEURISTIC_GOLD} select coupon_label, count(*) as carts from scored group by 1"
SQL["dashboard_figures"] = " union all ".join(
    [
        figures(
            "kpis", SQL["cart_kpis"], totalCarts="total_carts", abandonedCarts="abandoned_carts",
            abandonmentRate="abandonment_rate", totalGMV="total_gmv", gmvLost="gmv_lost",
        ),
        figures("kpis", RECOVERY, gmvRecovered="recovered", couponEligibleCount="eligible"),
        figures("funnel", SQL["funnel"], views="views", carts="carts", purchases="purchases"),
        figures("buyerJourneyStats", SQL["prior_activity_stats"], **{
            c: c for c in ("prior_views_mean", "prior_carts_mean", "prior_views_median", "prior_carts_median")
        }),
        by_name("categories", SQL["top_abandoned_categories"], "main_category", "carts"),
        by_name("hourlyAbandonment", SQL["hourly_abandonment"], "hour_of_day", "abandonment_rate"),
        by_name("couponDistribution", COUPONS, "coupon_label", "carts"),
        *[
            by_name("purchaseJourney", f"{FROM_JOURNEY} {statistics(metric)}", f"'{name}.{shown}'", column)
            for metric, name in (
                ("total_views_before_purchase", "viewsBeforePurchase"),
                ("prior_cart_sessions", "priorCartsBeforePurchase"),
                ("journey_duration_hours", "journeyDurationHours"),
            )
            for shown, column in (("buyers", "buyers"), ("mean", "mean"), ("median", "p50"))
        ],
        by_name("abandonedCartsWithCoupons", CARDS, "name", "value"),
    ]
)

# --- rules ------------------------------------------------------------------

SQL["heuristic_risk"] = f"{FROM_BASE} select {CART_KEYS}, {HEURISTIC} as p_abandonment from base"
SQL["logistic_risk"] = f"""{FROM_BASE}, {LOGISTIC}
select {CART_KEYS}, session_duration_sec, user_profile, p_abandonment from risky"""
SQL["stream_risk"] = f"""{FROM_BASE},
judged as (select *, {STREAM_RISK} as p_abandonment from base)
select {CART_KEYS}, p_abandonment,
  case when p_abandonment >= 0.5::double then 1 else 0 end as predicted_abandoned
from judged"""
SQL["risk_bands"] = f"""{FROM_BASE}, {LOGISTIC}
select user_session, p_abandonment, case when p_abandonment < 0.4::double then 'BAIXO RISCO'
  when p_abandonment < 0.65::double then 'RISCO MODERADO' else 'ALTO RISCO' end as risk_band
from risky"""
SQL["profile_rule_a"] = f"{FROM_BASE} select {CART_KEYS}, {RULE_A} as user_profile from base"
SQL["profile_rule_b"] = f"{FROM_BASE} select {CART_KEYS}, {RULE_B} as user_profile from base"
SQL["profile_rule_c"] = (
    f"{FROM_BASE} select {CART_KEYS}, session_duration_sec, {RULE_C} as user_profile from base"
)
SQL["coupon_matrix"] = (
    f"{FROM_LOGISTIC} select {CART_KEYS}, p_abandonment, {OFFER_COLUMNS} from scored"
)
SQL["profile_prescription"] = f"""{FROM_BASE}, {LOGISTIC}, {PROFILE_OFFER_LIST},
coded as (select *, {PROFILE_CODE} as code from labelled)
select {CART_KEYS}, c.user_profile, profile_name_pt, {OFFER_COLUMNS}
from coded c join profile_offer_list o
  on o.user_profile = c.user_profile and o.coupon_code = c.code"""
SQL["recovered_gmv"] = f"""{FROM_LOGISTIC}
select user_session, total_cart_value, coupon_code, discount_pct, estimated_recovered_gmv
from scored"""
SQL["stream_recovered_gmv"] = f"""{FROM_BASE},
judged as (select *, {STREAM_RISK} as p_abandonment from base)
select user_session, total_cart_value, p_abandonment, {STREAM_RECOVERED} as recovered_gmv
from judged"""
SQL["scored_carts"] = f"""{FROM_HEURISTIC_GOLD}
select {GOLD_OUTPUT}, p_abandonment, {OFFER_COLUMNS}, estimated_recovered_gmv, discount_value
from scored"""
SQL["abandoned_carts"] = f"{FROM_BASE} select {BASE_OUTPUT} from base where is_abandoned = 1"
SQL["coupon_eligible"] = f"{FROM_LOGISTIC} select {MATRIX} from scored where coupon_code <> 'NENHUM'"
SQL["coupon_distribution"] = f"""{FROM_LOGISTIC}
select coupon_code, coupon_label, count(*) as carts,
  round(count(*) / (select count(*) from scored), 4) as share
from scored group by coupon_code, coupon_label"""
SQL["priority_queue"] = f"""{FROM_LOGISTIC}
select case urgency_level when 'Crítica' then 0 when 'Alta' then 1 when 'Média' then 2
  when 'Baixa' then 3 else 4 end as urgency_rank, {MATRIX}
from scored where is_abandoned = 1 and coupon_code <> 'NENHUM'"""

# --- serving ----------------------------------------------------------------

SQL["dim_users"] = f"""{FROM_BASE}, {LOGISTIC},
latest as (
  select user_id, user_profile, row_number() over (partition by user_id
    order by first_event_sec desc, user_session desc) as place
  from labelled)
select s.user_id, min(sec) as first_interaction_sec,
  coalesce(min(user_profile), 'browser') as user_intent_profile,
  cast(count(distinct s.user_session) as integer) as total_sessions
from silver s left join latest l on l.user_id = s.user_id and l.place = 1
group by s.user_id"""
SQL["dim_products"] = f"""{FROM_SILVER},
ranked as (select *, row_number() over (partition by product_id order by sec desc, event_id desc)
  as place from silver)
select product_id, category_id, category_code,
  case when category_code = 'outros.desconhecido' then 'other'
    else split_part(category_code, '.', 1) end as main_category,
  brand, price
from ranked where place = 1"""
SQL["dim_categories"] = f"""{FROM_SILVER}
select category_code, count(*) as events, split_part(category_code, '.', 1) as main_category
from silver where category_code <> 'outros.desconhecido' group by category_code"""
SQL["dim_date"] = f"""{FROM_SILVER},
span as (select min(cast(t as date)) as a, max(cast(t as date)) as b from silver),
days as (select unnest(generate_series(a, b, interval 1 day)) as d from span)
select strftime(d, '%Y-%m-%d') as day, cast(year(d) as integer) as year,
  cast(month(d) as integer) as month, cast(day(d) as integer) as day_of_month,
  cast(isodow(d) - 1 as integer) as day_of_week,
  case when isodow(d) >= 6 then 1 else 0 end as is_weekend
from days"""
SQL["serving_session_features"] = f"""{FROM_GOLD}
select user_session as session_id, user_id, total_cart_value, num_cart_items,
  num_views_before_cart, view_to_cart_ratio,
  cast(session_duration_sec as double) as session_duration_sec, hour_of_day, day_of_week,
  is_weekend, is_night, main_category, cast(user_prior_views as integer) as user_prior_views,
  cast(user_prior_carts as integer) as user_prior_carts,
  cast(user_prior_abandoned_carts as integer) as user_prior_abandoned_carts,
  cast(user_total_cumulative_views as integer) as user_total_cumulative_views,
  (cast(round(user_lifetime_hours * 3600) as bigint) * 100 + 1800) // 3600 / 100
    as user_lifetime_hours,
  case when user_prior_carts = 0 then 0.5::double
    else (user_prior_abandoned_carts * 20000 + user_prior_carts) // (2 * user_prior_carts)
      / 10000 end as user_prior_abandon_rate,
  is_abandoned
from gold"""
PRESCRIPTIONS = f"""{FROM_LOGISTIC},
prescriptions as (
  select md5(user_session) as prescription_id, first_cart_sec + 3600 as trigger_executed_sec,
    user_session as session_id, user_id, total_cart_value, p_abandonment, urgency_level,
    coupon_code, coupon_label, discount_pct,
    cast(recovered_money as double) as estimated_recovered_gmv
  from scored)"""
SQL["serving_prescriptions"] = f"{PRESCRIPTIONS} select * from prescriptions"
LATEST = f"""{PRESCRIPTIONS},
latest as (
  select p.*, coalesce(num_cart_items, 1) as num_cart_items,
    coalesce(num_views_before_cart, 3) as num_views_before_cart,
    cast(row_number() over (order by trigger_executed_sec desc, session_id) as integer) as position
  from prescriptions p left join base b on b.user_session = p.session_id
  order by trigger_executed_sec desc, session_id limit 50)"""
SQL["latest_prescriptions"] = f"{LATEST} select *, position <= 10 as is_new from latest"
SQL["formatted_prescriptions"] = f"""{LATEST}
select position,
  case when position <= 10 then '🟢 NOVO (Streaming)' else '✓ Processado' end as status,
  strftime(make_timestamp(trigger_executed_sec * 1000000), '%H:%M:%S') as executed_at,
  substr(session_id, 1, 12) || '...' as session, user_id,
  'R$ ' || format('{{:,.2f}}', total_cart_value) as cart_value,
  num_cart_items as items, num_views_before_cart as views,
  printf('%.1f%%', round(p_abandonment * 100, 1)) as risk, coupon_label as coupon,
  urgency_level as urgency, 'R$ ' || format('{{:,.2f}}', estimated_recovered_gmv) as recovered
from latest"""
SQL["recent_carts"] = f"""{FROM_LOGISTIC},
newest as (select * from scored order by last_cart_sec desc, user_session limit 60)
select {MATRIX}, last_cart_sec,
  last_cart_sec // 86400 = (select max(last_cart_sec) // 86400 from newest) as is_new
from newest"""

# --- triggers ---------------------------------------------------------------

# t0 is the first cart event; a purchase from t0 to the deadline silences a trigger.
CLOCKS = """
starts as (
  select user_session, arg_min(user_id, sec * 10000000000::hugeint + event_id) as user_id,
    min(sec) filter (event_type = 'cart') as t0, min(sec) as first_sec
  from silver group by user_session
  having count(*) filter (event_type = 'cart') > 0),
last_event as (select max(sec) as as_of from silver),
delays as (select * from (values (300, 'CART_PLUS_5_MINUTES', '5 minutos após cart'),
  (3600, 'CART_PLUS_1_HOUR', '1 hora após cart')) as v(delay, trigger, time_window)),
fired as (
  select s.*, d.delay, d.trigger, d.time_window, cast(t0 + delay as bigint) as fires_at_sec
  from starts s, delays d
  where t0 + delay <= (select as_of from last_event)
    and not exists (select 1 from silver p where p.user_session = s.user_session
      and p.event_type = 'purchase' and p.sec between s.t0 and s.t0 + delay)),
at_one_hour as (
  select f.user_session, f.user_id, f.trigger, f.time_window, f.fires_at_sec,
    cast(sum(cast(price as decimal(18,2))) filter (event_type = 'cart') as double)
      as total_cart_value,
    cast(count(*) filter (event_type = 'cart') as integer) as num_cart_items,
    cast(count(*) filter (event_type = 'view') as integer) as num_views_before_cart,
    max(sec) filter (event_type = 'cart') as last_cart_sec, any_value(f.first_sec) as first_sec
  from fired f join silver s on s.user_session = f.user_session and s.sec <= f.fires_at_sec
  where f.delay = 3600
  group by f.user_session, f.user_id, f.trigger, f.time_window, f.fires_at_sec),
carts as (
  select user_session, user_id, trigger, time_window, fires_at_sec, total_cart_value,
    num_cart_items, num_views_before_cart,
    round(cast(num_views_before_cart as double) / num_cart_items, 2) as view_to_cart_ratio,
    last_cart_sec - first_sec as session_duration_sec,
    cast(hour(make_timestamp(last_cart_sec * 1000000)) as integer) as hour_of_day,
    case when hour(make_timestamp(last_cart_sec * 1000000)) >= 22
      or hour(make_timestamp(last_cart_sec * 1000000)) < 6 then 1 else 0 end as is_night
  from at_one_hour)"""
REMINDERS = f"""
reminders as (
  select user_session, user_id, trigger, time_window, fires_at_sec,
    {literal(REMINDER_ACTION)} as action_type, {literal(REMINDER_TITLE)} as message_title,
    {literal(REMINDER_BODY)} as message_body, {literal(REMINDER_STATUS)} as status
  from fired where delay = 300)"""
DECISIONS = f"""
profiled as (
  select *, {STREAM_RISK} as p_abandonment, {RULE_A} as user_profile from carts),
prescribed as (select *, {PROFILE_CODE} as code from profiled),
decisions as (
  select p.* exclude (code), o.* exclude (user_profile),
    round(p_abandonment * 100, 1) as ml_abandonment_risk_pct,
    case when p_abandonment >= 0.5::double then 1 else 0 end as predicted_abandoned,
    {STREAM_RECOVERED} as estimated_recovered_gmv, {literal(DECISION_STATUS)} as status
  from prescribed p join profile_offer_list o
    on o.user_profile = p.user_profile and o.coupon_code = p.code)"""
FROM_TRIGGERS = ", ".join([FROM_SILVER, CLOCKS, REMINDERS, PROFILE_OFFER_LIST, DECISIONS])
CHAIN = """
chain as (
  select user_session, user_id, trigger, fires_at_sec, action_type as action,
    message_body as shown, status from reminders
  union all
  select user_session, user_id, trigger, fires_at_sec, coupon_code, coupon_label, status
  from decisions)"""
# As of the deadline: the buyer's own carts and views in other sessions, nothing later.
SQL["decision_features"] = f"""{FROM_TRIGGERS},
begun as (
  select user_id, user_session, min(sec) as sec from silver
  where event_type = 'cart' group by 1, 2)
select user_session, user_id, fires_at_sec, total_cart_value, num_cart_items, num_views_before_cart,
  view_to_cart_ratio, session_duration_sec, hour_of_day, is_night,
  (select count(*) from begun b where b.user_id = c.user_id and b.user_session <> c.user_session
    and b.sec <= c.fires_at_sec) as user_prior_carts,
  (select count(*) from begun b join silver v on v.user_id = b.user_id and v.user_session = b.user_session
    where b.user_id = c.user_id and b.user_session <> c.user_session and b.sec <= c.fires_at_sec
      and v.event_type = 'view' and v.sec <= c.fires_at_sec) as user_prior_views
from carts c"""
SQL["trigger_5min"] = f"{FROM_TRIGGERS} select * from reminders"
SQL["trigger_1hour"] = f"{FROM_TRIGGERS} select * from decisions"
SQL["trigger_chain"] = f"{FROM_TRIGGERS}, {CHAIN} select * from chain"
# The stream has seen all events up to its watermark, ten minutes before the last.
SQL["stream_trigger_chain"] = f"""{FROM_TRIGGERS}, {CHAIN}
select * from chain where fires_at_sec < (select as_of from last_event) - 600"""
SQL["stream_gold"] = f"{FROM_GOLD} select {GOLD_OUTPUT} from gold"
SQL["stream_funnel_daily"] = f"""{FROM_SILVER}
select strftime(t, '%Y-%m-%d') as day, {COUNTS} from silver group by 1"""
SQL["stream_kpis"] = f"""{FROM_LOGISTIC}
select count(*) as total_carts, count(*) {LOST} as abandoned_carts,
  round(count(*) {LOST} / count(*), 4) as abandonment_rate, {GMV} as total_gmv,
  cast(sum({DECIMAL_VALUE}) {LOST} as double) as gmv_lost,
  cast(sum(recovered_money) {LOST} as double) as gmv_recovered,
  round(cast(sum(num_views_before_cart) as double) / count(*), 2) as mean_views
from scored"""

# --- learning ---------------------------------------------------------------

SQL["profile_training_set"] = f"""{FROM_GOLD}
select user_session as session_id, user_id, total_cart_value, num_cart_items,
  num_views_before_cart, user_prior_views, user_prior_carts, session_duration_sec, hour_of_day,
  is_night, {RULE_C} as user_profile, is_abandoned
from gold"""
FEATURES = ", ".join(f"cast({c} as double) as {c}" for c in NUMERIC_FEATURES)
SQL["feature_frame"] = (
    f"{FROM_GOLD} select user_session, is_abandoned, {FEATURES}, main_category from gold"
)
SQL["scaled_features"] = f"""{FROM_GOLD},
frame as (select user_session, {FEATURES} from gold),
fitted as (select {", ".join(
    f"avg({c}) as m_{c}, case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end as s_{c}"
    for c in NUMERIC_FEATURES)} from frame)
select user_session, {", ".join(
    f"round(({c} - m_{c}) / s_{c}, 4) + 0::double as {c}" for c in NUMERIC_FEATURES)}
from frame, fitted"""
SQL["one_hot_category"] = f"{FROM_BASE} select user_session, " + ", ".join(
    f"case when main_category = '{c}' then 1 else 0 end as main_category_{c}"
    for c in ("economy", "large", "medium", "other", "promo", "small", "standard")
) + " from base"
HASHED = f"""{FROM_BASE},
hashed as (select *, ('0x' || substr(md5(user_session), 1, 8))::ubigint as number from base)"""
SQL["stratified_split"] = f"""{HASHED}
select user_session, is_abandoned,
  case when number < 858993459 then 'test' else 'train' end as split
from hashed"""
SQL["split_shares"] = f"""{HASHED}
select is_abandoned, count(*) as carts, count(*) filter (number < 858993459) as test_carts,
  round(count(*) filter (number < 858993459) / count(*), 4) as test_share
from hashed group by is_abandoned"""
SQL["exact_stratified_split"] = f"""{HASHED},
cuts as (select is_abandoned, quantile_cont(number, 0.2) as cut from hashed group by 1)
select user_session, h.is_abandoned, case when number <= cut then 'test' else 'train' end as split
from hashed h join cuts c on c.is_abandoned = h.is_abandoned"""
JUDGED = f"""{FROM_BASE}, {LOGISTIC},
judged as (select is_abandoned = 1 as positive, p_abandonment as score,
  p_abandonment >= 0.5::double as said from risky)"""
MATRIX_COUNTS = """count(*) filter (not positive and not said) as tn,
  count(*) filter (not positive and said) as fp,
  count(*) filter (positive and not said) as fn,
  count(*) filter (positive and said) as tp"""
SQL["confusion_matrix"] = f"{JUDGED} select {MATRIX_COUNTS} from judged"
SQL["classification_metrics"] = f"""{JUDGED},
m as (select {MATRIX_COUNTS} from judged)
select round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1
from m"""
# The pairwise definition over distinct scores.
SQL["roc_auc"] = f"""{JUDGED},
c as (select score, count(*) filter (positive) as p, count(*) filter (not positive) as n
  from judged group by score),
pairs as (
  select sum(a.p * b.n * case when a.score > b.score then 2 when a.score = b.score then 1 else 0 end)
    as doubled
  from c a, c b)
select cast((select sum(p) from c) as bigint) as positives,
  cast((select sum(n) from c) as bigint) as negatives,
  round(doubled / (2::double * (select sum(p) from c) * (select sum(n) from c)), 6) as roc_auc
from pairs"""
SQL["roc_curve"] = f"""{JUDGED},
c as (select score, count(*) filter (positive) as p, count(*) filter (not positive) as n
  from judged group by score)
select score as threshold,
  round(sum(p) over w / (select sum(p) from c), 6) as tpr,
  round(sum(n) over w / (select sum(n) from c), 6) as fpr
from c window w as (order by score desc)"""


def all_sql() -> dict[str, str]:
    return dict(SQL)
