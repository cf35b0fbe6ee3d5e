"""The layers as DuckDB common table expressions, written independently of the
Spark code: plain windows and rankings, no chunks, no partial sums."""

BRONZE = r"""
marked as (
  select event_id, ts, user_id, event_type, value,
    cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k,
    case when ts - lag(ts) over (partition by user_id order by ts, event_id)
         > interval '12' hour then 1 else 0 end as starts
  from events),
numbered as (
  select *, sum(starts) over (partition by user_id order by ts, event_id
    rows between unbounded preceding and current row) as session_no
  from marked),
bronze as (
  select n.event_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' as event_time,
    case when event_type = 'click' then 'cart' else event_type end as event_type,
    k as product_id,
    cast(p_size as bigint) as category_id,
    case when k % 7 <> 0
      then concat(lower(p_type), '.', split_part(p_name, ' ', 2)) end as category_code,
    case when k % 11 <> 0 then lower(p_brand) end as brand,
    round(value * 10, 2) as price,
    user_id,
    concat(cast(user_id as varchar), '-', cast(session_no as varchar)) as user_session
  from numbered n left join part on p_partkey = k)"""

SILVER = """
timed as (
  select *, substr(event_time, 1, 19) as event_time_clean,
    try_strptime(substr(event_time, 1, 19), '%Y-%m-%d %H:%M:%S') as t
  from bronze),
silver as (
  select event_id, event_time, event_type, product_id, category_id,
    coalesce(category_code, 'outros.desconhecido') as category_code,
    coalesce(brand, 'generico') as brand, price, user_id, user_session,
    event_time_clean, t, cast(epoch(t) as bigint) as sec,
    cast(hour(t) as integer) as hour_of_day,
    case when hour(t) >= 22 or hour(t) < 6 then 1 else 0 end as is_night
  from timed
  where t is not null and product_id is not null and user_id is not null
    and user_session is not null and price > 0 and isfinite(price)
    and event_type in ('view', 'cart', 'purchase'))"""

SESSIONS = """
category_ranks as (
  select user_session, category_code,
    row_number() over (partition by user_session
      order by count(*) desc, category_code) as place
  from silver
  where event_type = 'cart' and category_code <> 'outros.desconhecido'
  group by user_session, category_code),
sums as (
  select user_session,
    arg_min(user_id, sec * 10000000000::hugeint + event_id) as user_id,
    count(*) filter (event_type = 'cart') as items,
    sum(cast(price as decimal(18,2))) filter (event_type = 'cart') as total,
    max(price) filter (event_type = 'cart') as max_item_price,
    min(price) filter (event_type = 'cart') as min_item_price,
    count(distinct brand) filter (event_type = 'cart' and brand <> 'generico') as brands,
    count(distinct category_code) filter (event_type = 'cart'
      and category_code <> 'outros.desconhecido') as categories,
    count(*) filter (event_type = 'view') as views,
    count(*) filter (event_type = 'purchase') as purchases,
    min(sec) as first_event_sec,
    min(sec) filter (event_type = 'cart') as first_cart_sec,
    max(sec) filter (event_type = 'cart') as last_cart_sec,
    max(t) filter (event_type = 'cart') as last_cart
  from silver group by user_session),
sessions as (
  select s.user_session, s.user_id,
    cast(items as integer) as num_cart_items,
    cast(total as double) as total_cart_value,
    max_item_price, min_item_price,
    case when items > 0 then cast(total * 100 as double) / (items * 100.0::double) end as avg_item_price,
    cast(brands as integer) as num_distinct_brands,
    cast(categories as integer) as num_distinct_categories,
    coalesce(split_part(c.category_code, '.', 1), 'other') as main_category,
    cast(views as integer) as num_views_before_cart,
    round(cast(views as double) / greatest(items, 1), 2) as view_to_cart_ratio,
    case when items > 0 then greatest(last_cart_sec - first_event_sec, 0) end as session_duration_sec,
    cast(hour(last_cart) as integer) as hour_of_day,
    cast(isodow(last_cart) - 1 as integer) as day_of_week,
    case when isodow(last_cart) >= 6 then 1 else 0 end as is_weekend,
    case when hour(last_cart) >= 22 or hour(last_cart) < 6 then 1 else 0 end as is_night,
    case when purchases = 0 then 1 else 0 end as is_abandoned,
    first_event_sec, first_cart_sec, last_cart_sec
  from sums s left join category_ranks c
    on c.user_session = s.user_session and c.place = 1),
base as (select * from sessions where num_cart_items > 0)"""

GOLD = """
prior as (
  select *,
    coalesce(cast(sum(num_views_before_cart) over w as bigint), 0) as user_prior_views,
    count(*) over w as user_prior_carts,
    coalesce(cast(sum(is_abandoned) over w as bigint), 0) as user_prior_abandoned_carts,
    min(first_event_sec) over (partition by user_id) as first_seen_sec
  from base
  window w as (partition by user_id order by first_event_sec, user_session
    rows between unbounded preceding and 1 preceding)),
gold as (
  select user_session, user_id, num_cart_items, total_cart_value, max_item_price,
    min_item_price, avg_item_price, num_distinct_brands, num_distinct_categories,
    main_category, num_views_before_cart, view_to_cart_ratio, session_duration_sec,
    hour_of_day, day_of_week, is_weekend, is_night,
    user_prior_views, user_prior_carts, user_prior_abandoned_carts,
    user_prior_views + num_views_before_cart as user_total_cumulative_views,
    cast(first_event_sec - first_seen_sec as double) / 3600.0::double as user_lifetime_hours,
    case when user_prior_carts > 0
      then cast(user_prior_abandoned_carts as double) / user_prior_carts
      else 0.5::double end as user_prior_abandon_rate,
    is_abandoned, first_event_sec, first_cart_sec, last_cart_sec
  from prior)"""


def with_layers(*layers: str) -> str:
    return "with " + ",".join(layers)


FROM_BRONZE = with_layers(BRONZE)
FROM_SILVER = with_layers(BRONZE, SILVER)
FROM_BASE = with_layers(BRONZE, SILVER, SESSIONS)
FROM_GOLD = with_layers(BRONZE, SILVER, SESSIONS, GOLD)
