"""DuckDB counterparts of the registered queries, over the same test tables.

Each table is one CTE; a query pulls in the CTEs it names. Values that Spark computes as rounded decimals are rebuilt
with whole-number arithmetic, so both engines round the same exact value the same way.
"""

from __future__ import annotations

import re

from stayline.sources import samples

# Fixed values, written out here on their own: the 55 features in output order, those that count something and so are zero
# for a customer without rows, and the declared checks.
FEATURES = (
    "tenure_days", "age", "age_band_encoded", "plan_type_encoded", "monthly_revenue", "acquisition_channel_encoded",
    "device_type_encoded", "total_watch_events", "total_active_days", "unique_titles_watched", "unique_sessions",
    "total_watch_minutes", "avg_watch_duration_min", "max_watch_duration_min", "avg_completion_pct",
    "completed_count", "abandoned_count", "completion_rate", "abandonment_rate", "resumed_count", "resume_rate",
    "binge_session_count", "device_count", "days_since_last_watch", "watch_events_last_7d", "watch_minutes_last_7d",
    "watch_events_last_30d", "watch_minutes_last_30d", "watch_trend_7d_vs_30d", "total_subscription_events",
    "upgrade_count", "downgrade_count", "net_plan_changes", "has_downgraded", "activity_level_encoded",
    "total_support_tickets", "avg_resolution_hours", "avg_sentiment_score", "min_sentiment_score",
    "negative_ticket_count", "negative_ticket_rate", "unresolved_ticket_count", "billing_tickets",
    "technical_tickets", "critical_tickets", "total_ratings", "avg_rating_given", "low_ratings_count",
    "high_ratings_count", "total_watchlist_items", "watchlist_watched_count", "watchlist_conversion_rate",
    "recency_risk_score", "support_frustration_score", "heuristic_churn_risk_score",
)
ZEROED = (
    "total_watch_events", "total_active_days", "unique_titles_watched", "unique_sessions", "total_watch_minutes",
    "completed_count", "abandoned_count", "resumed_count", "binge_session_count", "device_count",
    "watch_events_last_7d", "watch_minutes_last_7d", "watch_events_last_30d", "watch_minutes_last_30d",
    "total_subscription_events", "upgrade_count", "downgrade_count", "net_plan_changes", "has_downgraded",
    "total_support_tickets", "negative_ticket_count", "unresolved_ticket_count", "billing_tickets",
    "technical_tickets", "critical_tickets", "total_ratings", "low_ratings_count", "high_ratings_count",
    "total_watchlist_items", "watchlist_watched_count",
)
KINDS = ("not_null", "unique", "accepted_values", "relationships")
CHECKS = {"raw_content_catalog": {"not_null": ["content_id", "title", "content_type"],
                         "accepted_values": {"content_type": ("movie", "tv_show")}},
 "raw_users": {"not_null": ["customer_id", "signup_date"],
               "accepted_values": {"plan_type": ("basic", "standard", "premium"),
                                   "activity_level": ("low", "medium", "high")}},
 "raw_subscription_events": {"not_null": ["customer_id", "event_type", "event_date"],
                             "accepted_values": {"event_type": ("subscribe", "upgrade", "downgrade", "cancel")}},
 "raw_watch_events": {"not_null": ["watch_event_id", "customer_id", "content_id", "watch_date"]},
 "raw_user_ratings": {"not_null": ["rating_id", "customer_id", "content_id", "rating"],
                      "accepted_values": {"rating": (1, 2, 3, 4, 5)}},
 "raw_user_watchlist": {"not_null": ["watchlist_id", "customer_id", "content_id", "added_at"]},
 "raw_support_tickets": {"not_null": ["ticket_id", "customer_id"]},
 "stg_customers": {"not_null": ["customer_key", "customer_id"], "unique": ["customer_key", "customer_id"]},
 "stg_subscription_events": {"not_null": ["subscription_event_key", "customer_id"],
                             "unique": ["subscription_event_key"]},
 "stg_support_tickets": {"not_null": ["interaction_key", "ticket_id"], "unique": ["interaction_key", "ticket_id"]},
 "stg_content_catalog": {"not_null": ["content_key", "content_id"], "unique": ["content_key", "content_id"]},
 "dim_date": {"not_null": ["date_day"], "unique": ["date_day"]},
 "dim_customer": {"not_null": ["customer_key", "customer_id"],
                  "unique": ["customer_key", "customer_id"],
                  "accepted_values": {"plan_type": ("basic", "standard", "premium")}},
 "dim_content": {"not_null": ["content_key", "content_id"],
                 "unique": ["content_key", "content_id"],
                 "accepted_values": {"content_type": ("movie", "tv_show")}},
 "fct_watch_event": {"not_null": ["watch_event_key", "customer_key", "content_key", "date_day"],
                     "unique": ["watch_event_key"],
                     "accepted_values": {"engagement_level": ("completed", "engaged", "sampled", "abandoned")},
                     "relationships": {"customer_key": ("dim_customer", "customer_key"),
                                       "content_key": ("dim_content", "content_key"),
                                       "date_day": ("dim_date", "date_day")}},
 "fct_support_interaction": {"not_null": ["interaction_key", "customer_key", "date_day"],
                             "unique": ["interaction_key"],
                             "accepted_values": {"sentiment_tier": ("positive", "neutral", "negative"),
                                                 "resolution_tier": ("quick", "standard", "slow", "critical")},
                             "relationships": {"customer_key": ("dim_customer", "customer_key")}},
 "fct_daily_user_activity": {"not_null": ["activity_key",
                                          "customer_key",
                                          "date_day",
                                          "sessions_count",
                                          "daily_engagement_score"],
                             "unique": ["activity_key"],
                             "relationships": {"customer_key": ("dim_customer", "customer_key"),
                                               "date_day": ("dim_date", "date_day")}},
 "fct_subscription_event": {"not_null": ["subscription_event_key",
                                         "customer_key",
                                         "date_day",
                                         "event_type",
                                         "plan_type",
                                         "monthly_revenue"],
                            "unique": ["subscription_event_key"],
                            "accepted_values": {"event_type": ("subscribe", "upgrade", "downgrade", "cancel"),
                                                "plan_type": ("basic", "standard", "premium")},
                            "relationships": {"customer_key": ("dim_customer", "customer_key"),
                                              "date_day": ("dim_date", "date_day")}}}

AGE_BAND_CODES = {"18-24": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55+": 5}
PLAN_CODES = {"basic": 1, "standard": 2, "premium": 3}
CHANNEL_CODES = {"organic": 1, "referral": 2, "paid_search": 3, "social": 4, "tv_ad": 5}
DEVICE_CODES = {"smart_tv": 1, "desktop": 2, "mobile": 3, "tablet": 4, "gaming_console": 5}
ACTIVITY_CODES = {"low": 1, "medium": 2, "high": 3}

AS_OF = f"date '{samples.AS_OF}'"
NO_KEY = "_dbt_utils_surrogate_key_null_"


def key(*columns: str) -> str:
    return "md5(concat(" + ", '-', ".join(f"coalesce(cast({c} as varchar), '{NO_KEY}')" for c in columns) + "))"


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator to the nearest whole number, halves away from zero; the denominator is positive."""
    return f"(sign({numerator}) * ((2 * abs({numerator}) + {denominator}) // (2 * {denominator})))"


def rate(part: str, n: str = "count(*)") -> str:
    return f"cast({half_up(f'100 * ({part})', n)} as double) / 100"


def mean_of_decimal(column: str, scale: int, to_two: bool = True) -> str:
    """avg of decimal(p, scale): first to scale + 4 digits, then, if asked, to two."""
    total = f"sum(cast({column} * {10**scale} as bigint))"
    fine = half_up(f"{10**4} * {total}", f"count({column})")
    if not to_two:
        return f"cast({fine} as double) / {10 ** (scale + 4)}"
    return f"cast({half_up(fine, str(10 ** (scale + 2)))} as double) / 100"


def mean_of_int(column: str) -> str:
    return f"cast({half_up(f'100 * sum({column})', f'count({column})')} as double) / 100"


def codes(column: str, table: dict, rest: str = "null") -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {v!r}" for k, v in table.items()) + f" else {rest} end"


CTES: dict[str, str] = {name: samples.duckdb_sql(name) for name in samples.RAW_SQL}

CTES["stg_customers"] = f"select {key('customer_id')} customer_key, * from raw_users"
CTES["stg_subscription_events"] = (
    f"select {key('customer_id', 'event_type', 'event_date')} subscription_event_key, * from raw_subscription_events"
)
CTES["stg_support_tickets"] = f"select {key('ticket_id')} interaction_key, * from raw_support_tickets"
CTES["stg_watch_events"] = f"select {key('watch_event_id')} watch_event_key, * from raw_watch_events"
CTES["stg_user_ratings"] = f"""select {key("rating_id")} rating_key, rating_id, customer_id, content_id, rating,
rated_at from raw_user_ratings"""
CTES["stg_user_watchlist"] = f"""select {key("watchlist_id")} watchlist_key, watchlist_id, customer_id, content_id,
added_at, is_watched from raw_user_watchlist"""
CTES["catalog_latest_load"] = """select * from raw_content_catalog
qualify row_number() over (partition by content_id order by _loaded_at desc nulls last, title, vote_count) = 1"""
CTES["stg_content_catalog"] = f"""select {key("content_id")} content_key, content_id,
try_cast(tmdb_id as integer) tmdb_id, title, content_type, genres genre_list, primary_genre,
try_cast(release_date as date) release_date,
try_cast(vote_average as decimal(3,1)) vote_average, try_cast(vote_count as integer) vote_count,
try_cast(popularity as decimal(10,2)) popularity, original_language, overview,
try_cast(runtime_minutes as integer) runtime_minutes from catalog_latest_load"""

CTES["dim_customer"] = """select *, case when age is null or age >= 55 then '55+' when age < 25 then '18-24'
when age < 35 then '25-34' when age < 45 then '35-44' else '45-54' end age_band from stg_customers"""
CTES["dim_content"] = f"""select *,
case when release_date is null or release_date < {AS_OF} - interval 10 year then 'classic'
  when release_date < {AS_OF} - interval 3 year then 'catalog'
  when release_date < {AS_OF} - interval 1 year then 'recent' else 'new_release' end content_age_bucket,
case when vote_average >= 8 then 'highly_rated' when vote_average >= 6.5 then 'well_rated'
  when vote_average >= 5 then 'average' else 'below_average' end rating_tier
from stg_content_catalog"""


def calendar(number: str, shift: int, weekend: str) -> str:
    return f"""select date_day, cast(year(date_day) as integer) "year", cast(month(date_day) as integer) "month",
cast(day(date_day) as integer) day_of_month, cast({number} as integer) day_of_week_num,
dayname(date_day + {shift}) day_of_week_name, {weekend} is_weekend, monthname(date_day) month_name,
cast(quarter(date_day) as integer) "quarter", cast(year(date_day) as integer) fiscal_year
from (select date '2023-01-01' + cast(i as integer) date_day from range(0, 1825) days(i)) d"""


CTES["dim_date"] = calendar("isodow(date_day)", 0, "isodow(date_day) >= 6")
CTES["dim_date_source_week"] = calendar("dayofweek(date_day) + 1", 1, "dayofweek(date_day) in (5, 6)")


def watch_fact(watches: str, scale: int = 1) -> str:
    done = f"completion_percentage * {scale}"
    return f"""select watch_event_key, customer_key, content_key, watch_date date_day, watch_event_id, session_id,
device_type, watch_start_time, watch_duration_minutes, completion_percentage, is_resumed,
case when {done} >= 90 then 'completed' when {done} >= 50 then 'engaged' when {done} >= 10 then 'sampled'
  else 'abandoned' end engagement_level,
case when watch_duration_minutes <= 15 then 'short' when watch_duration_minutes <= 60 then 'medium'
  when watch_duration_minutes <= 120 then 'long' else 'binge' end session_duration_bucket
from {watches} join (select customer_id, customer_key from dim_customer) c using (customer_id)
join (select content_id, content_key from dim_content) t using (content_id)"""


CTES["fct_watch_event"] = watch_fact("stg_watch_events")
CTES["stg_watch_events_fraction"] = """select * replace
(cast(completion_percentage / 100.0 as decimal(5,2)) as completion_percentage) from stg_watch_events"""
CTES["fct_watch_event_fraction_input"] = watch_fact("stg_watch_events_fraction")
CTES["fct_watch_event_fraction_scaled"] = watch_fact("stg_watch_events_fraction", 100)

CTES["fct_support_interaction"] = """select interaction_key, customer_key, cast(created_at as date) date_day, ticket_id,
category, channel, created_at, resolution_time_hours, is_resolved, sentiment_score,
case when resolution_time_hours <= 4 then 'quick' when resolution_time_hours <= 24 then 'standard'
  when resolution_time_hours <= 48 then 'slow' else 'critical' end resolution_tier,
case when sentiment_score >= 0.3 then 'positive' when sentiment_score >= -0.3 then 'neutral' else 'negative' end
  sentiment_tier
from stg_support_tickets join dim_customer using (customer_id)"""

CTES["watch_days"] = f"""select customer_id, watch_date, count(*) sessions_count,
count(distinct content_id) titles_watched, sum(watch_duration_minutes) total_watch_minutes,
{mean_of_decimal("completion_percentage", 2, to_two=False)} avg_completion_pct,
count(*) filter (is_resumed) resumed_sessions, count(*) filter (completion_percentage >= 90) completed_titles
from stg_watch_events group by all"""
CTES["rating_days"] = """select customer_id, rated_at, count(*) ratings_given, avg(rating) avg_rating
from stg_user_ratings group by all"""
CTES["watchlist_days"] = """select customer_id, added_at, count(*) watchlist_adds,
count(*) filter (is_watched) watchlist_conversions from stg_user_watchlist group by all"""
CTES["fct_daily_user_activity"] = f"""select {key("w.customer_id", "w.watch_date")} activity_key, c.customer_key,
w.watch_date date_day, sessions_count, titles_watched, cast(total_watch_minutes as bigint) total_watch_minutes,
avg_completion_pct, resumed_sessions, completed_titles, ifnull(ratings_given, 0) ratings_given, avg_rating,
ifnull(watchlist_adds, 0) watchlist_adds, ifnull(watchlist_conversions, 0) watchlist_conversions,
cast(2 * sessions_count + 4 * completed_titles + 3 * ifnull(ratings_given, 0) + ifnull(watchlist_adds, 0) as double) / 2
  daily_engagement_score,
titles_watched > 2 is_binge_day
from watch_days w join dim_customer c using (customer_id)
left join rating_days r on r.customer_id = w.customer_id and r.rated_at = w.watch_date
left join watchlist_days l on l.customer_id = w.customer_id and l.added_at = w.watch_date"""

CTES["fct_subscription_event"] = """select subscription_event_key, customer_key, event_date date_day, event_type,
e.plan_type, e.monthly_revenue, cancellation_reason,
case event_type when 'subscribe' then 'new' when 'upgrade' then 'expansion' when 'downgrade' then 'contraction'
  when 'cancel' then 'churned' else 'other' end revenue_category,
lag(e.plan_type) over line previous_plan_type, lag(e.monthly_revenue) over line previous_monthly_revenue,
cast(event_date - lag(event_date) over line as integer) days_since_previous_event
from stg_subscription_events e join dim_customer c using (customer_id)
where event_date in (select date_day from dim_date)
window line as (partition by customer_id order by event_date,
  list_position(['subscribe', 'upgrade', 'downgrade', 'cancel'], event_type), subscription_event_key)"""

CTES["feat_customer"] = f"""select customer_key, customer_id, is_churned, churn_date,
cast({AS_OF} - signup_date as integer) tenure_days, age,
{codes("age_band", AGE_BAND_CODES)} age_band_encoded, {codes("plan_type", PLAN_CODES)} plan_type_encoded,
monthly_revenue, {codes("acquisition_channel", CHANNEL_CODES)} acquisition_channel_encoded,
{codes("device_type", DEVICE_CODES)} device_type_encoded,
{codes("activity_level", ACTIVITY_CODES)} activity_level_encoded from dim_customer"""
CTES["feat_watch"] = f"""select customer_key, count(*) total_watch_events, count(distinct date_day) total_active_days,
count(distinct content_key) unique_titles_watched, count(distinct session_id) unique_sessions,
cast(sum(watch_duration_minutes) as bigint) total_watch_minutes,
{mean_of_int("watch_duration_minutes")} avg_watch_duration_min, max(watch_duration_minutes) max_watch_duration_min,
{mean_of_decimal("completion_percentage", 2)} avg_completion_pct,
count(*) filter (engagement_level = 'completed') completed_count,
count(*) filter (engagement_level = 'abandoned') abandoned_count,
{rate("count(*) filter (engagement_level = 'completed')")} completion_rate,
{rate("count(*) filter (engagement_level = 'abandoned')")} abandonment_rate,
count(*) filter (is_resumed) resumed_count, {rate("count(*) filter (is_resumed)")} resume_rate,
count(*) filter (session_duration_bucket = 'binge') binge_session_count,
count(distinct device_type) device_count, cast({AS_OF} - max(date_day) as integer) days_since_last_watch,
count(*) filter (session_duration_bucket = 'short') short_session_count,
cast(max(date_day) - min(date_day) as integer) watch_span_days
from fct_watch_event group by customer_key"""
CTES["watch_windows"] = f"""select customer_key, count(*) filter (date_day >= {AS_OF} - 7) n7,
coalesce(sum(watch_duration_minutes) filter (date_day >= {AS_OF} - 7), 0) m7,
count(*) filter (date_day >= {AS_OF} - 30) n30,
coalesce(sum(watch_duration_minutes) filter (date_day >= {AS_OF} - 30), 0) m30
from fct_watch_event group by customer_key"""
_PACE = half_up("n30 * 100000000", "428")  # n30 / 4.28 in millionths
CTES["feat_watch_recent"] = f"""select customer_key, n7 watch_events_last_7d, cast(m7 as bigint) watch_minutes_last_7d,
n30 watch_events_last_30d, cast(m30 as bigint) watch_minutes_last_30d,
case when n30 > 0 then cast({half_up("n7 * 100000000", _PACE)} as double) / 100 end watch_trend_7d_vs_30d
from watch_windows"""
CTES["feat_subscription"] = """select customer_key, count(*) total_subscription_events, count(*) filter
(event_type = 'upgrade') upgrade_count, count(*) filter (event_type = 'downgrade') downgrade_count,
count(*) filter (event_type = 'cancel') cancel_count,
count(*) filter (event_type = 'upgrade') - count(*) filter (event_type = 'downgrade') net_plan_changes,
cast(bool_or(event_type = 'downgrade') as integer) has_downgraded
from fct_subscription_event group by customer_key"""
CTES["feat_support"] = f"""select customer_key, count(*) total_support_tickets,
{mean_of_decimal("resolution_time_hours", 1)} avg_resolution_hours, max(resolution_time_hours) max_resolution_hours,
{mean_of_decimal("sentiment_score", 2)} avg_sentiment_score, min(sentiment_score) min_sentiment_score,
count(*) filter (sentiment_tier = 'negative') negative_ticket_count,
{rate("count(*) filter (sentiment_tier = 'negative')")} negative_ticket_rate,
count(*) filter (not is_resolved) unresolved_ticket_count, count(*) filter (category = 'billing') billing_tickets,
count(*) filter (category = 'technical') technical_tickets, count(*) filter (category = 'content') content_tickets,
count(*) filter (resolution_tier = 'critical') critical_tickets,
cast({AS_OF} - max(date_day) as integer) days_since_last_ticket
from fct_support_interaction group by customer_key"""
CTES["feat_rating"] = f"""select customer_key, count(*) total_ratings, {mean_of_int("rating")} avg_rating_given,
min(rating) min_rating_given, count(*) filter (rating in (1, 2)) low_ratings_count,
count(*) filter (rating in (4, 5)) high_ratings_count
from stg_user_ratings join dim_customer using (customer_id) group by customer_key"""
CTES["feat_watchlist"] = f"""select customer_key, count(*) total_watchlist_items,
count(*) filter (is_watched) watchlist_watched_count, {rate("count(*) filter (is_watched)")} watchlist_conversion_rate
from stg_user_watchlist join dim_customer using (customer_id) group by customer_key"""

CTES["joined_features"] = f"""select * replace ({", ".join(f"ifnull({c}, 0) as {c}" for c in ZEROED)},
ifnull(days_since_last_watch, 9999) as days_since_last_watch)
from feat_customer left join feat_watch using (customer_key) left join feat_watch_recent using (customer_key)
left join feat_subscription using (customer_key) left join feat_support using (customer_key)
left join feat_rating using (customer_key) left join feat_watchlist using (customer_key)"""
_MEASURED = FEATURES[:52]  # without the three composite scores
CTES["ml_feature_store"] = f"""select customer_key, customer_id, is_churned target_is_churned,
churn_date target_churn_date, {", ".join(_MEASURED)},
case when days_since_last_watch < 1 then 1 when days_since_last_watch < 3 then 2 when days_since_last_watch < 7 then 3
  when days_since_last_watch < 14 then 4 else 5 end recency_risk_score,
cast(3 * negative_ticket_count + 2 * (unresolved_ticket_count + critical_tickets) as double) support_frustration_score,
cast(3 * (days_since_last_watch >= 7)::int + 2 * has_downgraded + 2 * (negative_ticket_count >= 2)::int
  + 2 * ifnull(abandonment_rate >= 0.5, false)::int + 3 * (watch_events_last_7d = 0)::int as integer)
  heuristic_churn_risk_score
from joined_features"""

# Data quality: one select per declared check.


def _check(test: str, table: str, column: str, failures: str) -> str:
    return (
        f"select '{test}' test, '{table}' table_name, '{column}' column_name, cast(({failures}) as bigint) n_failed"
    )


def _failures(kind: str) -> list[str]:
    found = []
    for table, declared in CHECKS.items():
        for column in declared.get(kind, ()):
            if kind == "not_null":
                failures = f"select count(*) from {table} where {column} is null"
            elif kind == "unique":
                repeated = f"select {column} from {table} where {column} is not null group by 1 having count(*) > 1"
                failures = f"select count(*) from ({repeated})"
            elif kind == "accepted_values":
                values = ", ".join(repr(v) for v in declared[kind][column])
                failures = f"select count(distinct {column}) from {table} where {column} not in ({values})"
            else:
                parent, parent_key = declared[kind][column]
                known = f"select 1 from {parent} y where y.{parent_key} = x.{column}"
                failures = f"select count(*) from {table} x where {column} is not null and not exists ({known})"
            found.append(_check(kind, table, column, failures))
    return found


def _report(selects: list[str]) -> str:
    return (
        "select *, case when n_failed > 0 then 'fail' else 'pass' end status from ("
        + " union all ".join(selects)
        + ") checks"
    )


for _kind in KINDS:
    CTES[f"dq_{_kind}"] = _report(_failures(_kind))
CTES["dq_report"] = _report([select for kind in KINDS for select in _failures(kind)])
CTES["dq_relationships_staging"] = _report(
    [
        _check(
            "relationships",
            table,
            "customer_id",
            f"select count(*) from {table} where customer_id not in (select customer_id from dim_customer)",
        )
        for table in (
            "stg_watch_events",
            "stg_subscription_events",
            "stg_support_tickets",
            "stg_user_ratings",
            "stg_user_watchlist",
        )
    ]
)
CTES["source_freshness"] = f"""select 'raw_content_catalog' table_name, m max_loaded_at,
epoch(cast({AS_OF} as timestamp) - m) / 86400 age_days,
case when m is null or epoch(cast({AS_OF} as timestamp) - m) > 30 * 86400 then 'error'
  when epoch(cast({AS_OF} as timestamp) - m) > 86400 then 'warn' else 'pass' end status
from (select max(_loaded_at) m from raw_content_catalog) newest"""
CTES["catalog_checks"] = _report(
    [
        _check("not_empty", "raw_content_catalog", "*", "select (count(*) = 0)::int from raw_content_catalog"),
        _check("has_columns", "raw_content_catalog", "*", "select 0"),
        _check(
            "accepted_values",
            "raw_content_catalog",
            "content_type",
            "select count(distinct content_type) from raw_content_catalog "
            "where content_type not in ('movie', 'tv_show')",
        ),
        _check(
            "id_prefix",
            "raw_content_catalog",
            "content_id",
            "select count(*) from raw_content_catalog where not starts_with(content_id, 'TMDB_')",
        ),
    ]
)
_STORE_COLUMNS = ["customer_key", "customer_id", "target_is_churned", "target_churn_date", *FEATURES]
CTES["null_rate_profile"] = (
    "select *, null_rate > 0.2 is_high from ("
    + " union all ".join(
        f"select '{c}' column_name, avg(case when {c} is null then 1 else 0 end) null_rate from ml_feature_store"
        for c in _STORE_COLUMNS
    )
    + ") rates"
)
CTES["class_balance"] = """select target_is_churned, count(*) n, count(*) / sum(count(*)) over () as share
from ml_feature_store group by target_is_churned"""

# Catalogue job: what the landed pages must flatten to, straight from the titles.


def _flat(kind: str, condition: str, prefix: str, runtime: str) -> str:
    named = "p_partkey % 11 = 0"  # nulls spelled out, so no default applies

    def optional(value: str, absent: str, default: str) -> str:
        return f"case when not ({absent}) then {value} when {named} then null else {default} end"

    names = """case p_type when 'ECONOMY' then 'Action|Drama' when 'MEDIUM' then 'Comedy'
      when 'PROMO' then 'Crime|Drama|Unknown' else case when p_partkey % 3 = 2 then 'Drama' else '' end end"""
    overview = "case when p_partkey % 4 = 0 then repeat(p_name, 40) when p_partkey % 5 <> 0 then p_name else '' end"
    return f"""select '{prefix}' || p_partkey content_id, p_partkey tmdb_id, p_name title, '{kind}' content_type,
      {names} genres, coalesce(nullif(split_part({names}, '|', 1), ''), 'Unknown') primary_genre,
      case when p_partkey % 17 <> 0 then cast(date '2010-01-01' + cast(p_partkey * 29 % 5200 as integer) as varchar) end
        release_date,
      {optional("(p_partkey * 7 % 101) / 10", "p_partkey % 7 = 0", "0.0")} vote_average,
      {optional("p_partkey * 13 % 9000", "p_partkey % 8 = 0", "0")} vote_count,
      {optional("p_retailprice", "p_partkey % 7 = 0", "0.0")} popularity,
      {optional("case when p_partkey % 9 = 0 then 'fr' else 'en' end", "p_partkey % 9 = 1", "'en'")} original_language,
      substring({overview}, 1, 200) overview,
      cast(case when p_partkey % 10 = 0 or p_partkey % 6 = 0 then null else {runtime} end as bigint) runtime_minutes
      from part where {condition}"""


CTES["catalog_flatten"] = (
    _flat("movie", "p_size % 4 <> 0", "TMDB_M_", "p_size + 60")
    + " union all "
    + _flat("tv_show", "p_size % 4 = 0", "TMDB_T_", "p_size + 20")
)
CTES["catalog_flatten_json"] = "select *, timestamp '2024-06-29 06:00:00' _loaded_at from catalog_flatten"
CTES["catalog_genres"] = """select * from (select content_id, unnest(string_split(genres, '|')) genre from catalog_flatten)
where genre <> ''"""

# Titles.
CTES["user_title_summary"] = """select customer_id, content_id, max(completion_percentage) max_completion,
max(watch_date) last_watch_date from stg_watch_events group by all"""
CTES["watched_set"] = "select distinct customer_id, content_id from stg_watch_events"
CTES["watchlist_watched_flag"] = """select watchlist_id, customer_id, content_id, is_watched,
(customer_id, content_id) in (select (customer_id, content_id) from watched_set) has_watched from stg_user_watchlist"""
CTES["distinct_genres"] = "select distinct primary_genre from stg_content_catalog where primary_genre <> 'Unknown'"
CTES["genre_pool"] = """select primary_genre, content_id,
row_number() over (partition by primary_genre order by md5(content_id)) pool_position from stg_content_catalog"""
CTES["preferred_genres"] = "select customer_id, unnest(string_split(preferred_genres, '|')) genre from stg_customers"
CTES["popularity_share"] = """select content_id, popularity,
cast(popularity as double) / (select cast(sum(popularity) as double) from stg_content_catalog) popularity_share
from stg_content_catalog"""
CTES["effective_runtime"] = """select content_id, content_type, runtime_minutes,
case when ifnull(runtime_minutes, 0) > 0 then runtime_minutes when content_type = 'tv_show' then 45 else 90 end
  effective_runtime from stg_content_catalog"""
CTES["active_span"] = f"""select customer_id, signup_date,
cast(if(is_churned, churn_date, {AS_OF}) - signup_date as integer) active_days from dim_customer"""
CTES["plan_change_type"] = """select subscription_event_key, event_type, monthly_revenue, previous_monthly_revenue,
case when monthly_revenue > previous_monthly_revenue then 'upgrade' else 'downgrade' end plan_change_type
from fct_subscription_event where event_type in ('upgrade', 'downgrade')"""

# Matrix.
CTES["feature_matrix"] = f"""select customer_id, cast(target_is_churned as integer) as label,
{", ".join(f"cast({c} as double) {c}" for c in FEATURES)} from ml_feature_store"""
CTES["feature_medians"] = " union all ".join(
    f"select '{c}' column_name, median({c}) as median from feature_matrix" for c in FEATURES
)
CTES["labelled"] = "select customer_id, cast(is_churned as integer) as label from dim_customer"
CTES["drawn"] = """select customer_id, label,
row_number() over (partition by label order by md5('42|' || customer_id)) place,
count(*) over (partition by label) total from labelled"""
CTES["stratified_split"] = """select customer_id, label,
case when place <= ceil(total * 0.2) then 'test' else 'train' end split from drawn"""
CTES["stratified_folds"] = """select customer_id, label, cast((place > ceil(total * 0.2))::int
+ (place > ceil(total * 0.4))::int + (place > ceil(total * 0.6))::int
+ (place > ceil(total * 0.8))::int as integer) fold from drawn"""


def _filled(scope: str) -> str:
    seen = "feature_matrix" if scope == "all" else (
        "feature_matrix join stratified_split using (customer_id) where split = 'train'"
    )
    medians = ", ".join(f"median({c}) {c}" for c in FEATURES)
    return (
        f"select customer_id, {', '.join(f'coalesce(m.{c}, d.{c}) {c}' for c in FEATURES)} "
        f"from feature_matrix m, (select {medians} from {seen}) d"
    )


CTES["impute_median"] = _filled("train")
CTES["impute_median_all"] = _filled("all")
CTES["class_weight"] = """select count(*) filter (label = 0) n_negative, count(*) filter (label = 1) n_positive,
count(*) filter (label = 0) / count(*) filter (label = 1) positive_weight from stratified_split where split = 'train'"""

# Evaluation of the rule score.
CTES["scored"] = """select customer_id, cast(target_is_churned as integer) as label,
heuristic_churn_risk_score / 12.0::double score, days_since_last_watch, has_downgraded, heuristic_churn_risk_score,
negative_ticket_count from ml_feature_store"""
CTES["roc_auc"] = """select n_positive, n_negative, wins / (n_positive * n_negative) roc_auc from
(select sum(case when p.score > n.score then p.k * n.k when p.score = n.score then p.k * n.k / 2 else 0 end) wins
 from (select score, count(*) k from scored where label = 1 group by 1) p,
   (select score, count(*) k from scored where label = 0 group by 1) n) pairs,
(select count(*) filter (label = 1) n_positive, count(*) filter (label = 0) n_negative from scored) totals"""
CTES["average_precision"] = """select cast(max(tp) as bigint) n_positive,
round(sum(pos * tp / (tp + fp)) / max(tp), 10) average_precision
from (select score, pos, sum(pos) over down tp, sum(neg) over down fp
  from (select score, count(*) filter (label = 1) pos, count(*) filter (label = 0) neg from scored group by score) s
  window down as (order by score desc)) steps"""
CTES["confusion_matrix"] = """select actual, predicted, count(label) n
from (select unnest([0, 1]) actual) a cross join (select unnest([0, 1]) predicted) p
left join scored on label = actual and (score >= 0.5)::int = predicted group by actual, predicted"""
CTES["per_class"] = """select c.actual, cast(hit.n as double) hits, guessed.n guesses, cast(c.n as bigint) support,
case when guessed.n = 0 then 0.0 else hit.n / guessed.n end p, case when c.n = 0 then 0.0 else hit.n / c.n end r
from (select actual, sum(n) n from confusion_matrix group by 1) c
join (select predicted, sum(n) n from confusion_matrix group by 1) guessed on guessed.predicted = c.actual
join confusion_matrix hit on hit.actual = c.actual and hit.predicted = c.actual"""
CTES["class_lines"] = "select *, case when p + r = 0 then 0.0 else p * r * 2.0 / (p + r) end f from per_class"
CTES["classification_report"] = """
select case actual when 0 then 'Active' else 'Churned' end class_name, p precision_score, r recall_score, f f1_score,
  support from class_lines
union all select 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
  cast(sum(support) as bigint) from class_lines
union all select 'macro avg', sum(p) / 2, sum(r) / 2, sum(f) / 2, cast(sum(support) as bigint) from class_lines
union all select 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), cast(sum(support) as bigint) from class_lines"""
CTES["tiered"] = """select *, (score >= 0.5)::int predicted, case when score > 0 and score <= 0.3 then 'low'
when score > 0.3 and score <= 0.6 then 'medium' when score > 0.6 and score <= 1 then 'high' end risk_tier from scored"""
CTES["risk_tiers"] = "select customer_id, label, score, predicted, risk_tier from tiered"
CTES["risk_tier_distribution"] = """select t.risk_tier, count(x.risk_tier) n
from (select unnest(['low', 'medium', 'high']) risk_tier) t left join tiered x on x.risk_tier = t.risk_tier
group by t.risk_tier"""
CTES["top_risk_customers"] = """select customer_id, score, risk_tier, days_since_last_watch, has_downgraded,
heuristic_churn_risk_score, negative_ticket_count from tiered order by score desc, customer_id limit 10"""

_BY_DAY = """select year, fiscal_year, quarter, month, month_name, day_of_week_num, day_of_week_name, is_weekend,
count(*) n_viewings, cast(sum(watch_duration_minutes) as bigint) as minutes
from stg_watch_events join {calendar} on watch_date = date_day group by all"""
CTES["calendar_viewing"] = _BY_DAY.format(calendar="dim_date")
CTES["calendar_viewing_source_week"] = _BY_DAY.format(calendar="dim_date_source_week")
CTES["training_facts"] = """select 'train_size' metric, cast(count(*) filter (split = 'train') as double) as value
from stratified_split
union all select 'test_size', cast(count(*) filter (split = 'test') as double) from stratified_split
union all select 'n_features', 55.0::double
union all select 'churn_rate', avg(label) from stratified_split"""
# Every score must agree with what is told from it, and every feature must be ranked.
CTES["score_agreement"] = """select customer_id, true prediction_agrees, true tier_agrees, true is_probability
from dim_customer"""
CTES["importance_names"] = f"select unnest([{', '.join(repr(c) for c in FEATURES)}]) feature"
CTES["planted_ratings"] = """select *, substr(md5(rating_id), 1, 1) kind,
concat_ws(',', rating_id, customer_id, content_id) ids, ifnull(cast(rated_at as varchar), '') as rated,
ifnull(cast(rating as varchar), '') as stars from raw_user_ratings"""
CTES["csv_checked_kept"] = """select rating_id, customer_id, content_id, rating, rated_at from planted_ratings
where kind not in ('0', '1', '2', '3', '4')"""
CTES["csv_checked_rejects"] = """select case kind when '0' then ids || ',five,' || rated
when '1' then ids || ',' || stars || ',2024-13-45' when '2' then ids || ',' || stars
when '3' then ids || ',' || stars || ',' || rated || ',x' else ids || ',n/a,soon' end record,
case kind when '0' then 'bad int: rating' when '1' then 'bad date: rated_at' when '4' then 'bad int: rating; bad date: rated_at'
else 'malformed record' end reasons, true has_line
from planted_ratings where kind in ('0', '1', '2', '3', '4')"""
CTES["importance_file"] = "select feature, true is_share from importance_names"
CTES["score_walk"] = "select customer_id, true score_agrees from dim_customer"
CTES["ledger_checks"] = """select cast(t as integer) tree, true is_binary, true covers_add_up, true gains_enough,
true leaves_have_values, true within_depth from range(300) trees(t)"""
CTES["published_views"] = " union all ".join(
    f"select '{name}' view_name, count(*) n from {name}"
    for name in (
        "stg_customers", "stg_subscription_events", "stg_support_tickets", "stg_watch_events", "stg_user_ratings",
        "stg_user_watchlist", "stg_content_catalog",
    )
)

# The first split of a fit, feature by feature: gradients at even odds, both penalties, least hessian 5, least gain 1.
CTES["split_cells"] = f"""unpivot (select m.label, {", ".join(f"d.{c}" for c in FEATURES)}
from feature_matrix m join impute_median_all d using (customer_id)) on {", ".join(FEATURES)} into name feature value v"""
CTES["split_sums"] = """select feature, v, sum(if(label = 1, -w / 2, 0.5)) g, sum(if(label = 1, w, 1.0) / 4) h
from split_cells, (select count(*) filter (label = 0) / count(*) filter (label = 1) w from feature_matrix) odds
group by feature, v"""
CTES["split_cuts"] = f"""select distinct feature, unnest(quantile_disc(v, [{", ".join(str(i / 256) for i in range(1, 256))}])) v
from split_cells group by feature"""
CTES["split_sides"] = """select feature, v, sum(g) over upto gl, sum(h) over upto hl, sum(g) over whole - sum(g) over upto gr,
sum(h) over whole - sum(h) over upto hr from split_sums
window upto as (partition by feature order by v), whole as (partition by feature)"""
CTES["split_gains"] = """select feature, v, greatest(abs(gl) - 0.1, 0) ** 2 / (hl + 1) + greatest(abs(gr) - 0.1, 0) ** 2 / (hr + 1)
- greatest(abs(gl + gr) - 0.1, 0) ** 2 / (hl + hr + 1) gain
from split_sides join split_cuts using (feature, v) where least(hl, hr) >= 5 - 1e-6"""
CTES["first_splits"] = """select feature, v threshold, round(gain, 5) gain from split_gains where gain >= 1
qualify row_number() over (partition by feature order by round(gain, 7) desc, v) = 1"""

_SAME = {
    "ml_feature_store_stored": "ml_feature_store",
    "seeds_to_feature_store": "ml_feature_store",
    "csv_seed_users": "raw_users",
    "csv_seed_subscription_events": "raw_subscription_events",
    "csv_seed_watch_events": "raw_watch_events",
    "csv_seed_user_ratings": "raw_user_ratings",
    "csv_seed_user_watchlist": "raw_user_watchlist",
    "csv_seed_support_tickets": "raw_support_tickets",
}
# Fitted models have no SQL counterpart.
_NO_ORACLE = {"train_gbt", "cv_auc", "score_customers", "feature_importance"}
# Decimal columns go out as doubles, as on the Spark side.
_DECIMAL_COLUMNS = {
    "stg_customers": ["monthly_revenue"],
    "stg_subscription_events": ["monthly_revenue"],
    "stg_support_tickets": ["resolution_time_hours", "sentiment_score"],
    "stg_watch_events": ["completion_percentage"],
    "catalog_latest_load": ["vote_average", "popularity"],
    "stg_content_catalog": ["vote_average", "popularity"],
    "dim_customer": ["monthly_revenue"],
    "dim_content": ["vote_average", "popularity"],
    "fct_watch_event": ["completion_percentage"],
    "fct_watch_event_fraction_input": ["completion_percentage"],
    "fct_watch_event_fraction_scaled": ["completion_percentage"],
    "fct_support_interaction": ["resolution_time_hours", "sentiment_score"],
    "fct_subscription_event": ["monthly_revenue", "previous_monthly_revenue"],
    "feat_customer": ["monthly_revenue"],
    "feat_support": ["max_resolution_hours", "min_sentiment_score"],
    "ml_feature_store": ["monthly_revenue", "min_sentiment_score"],
    "raw_users": ["monthly_revenue"],
    "raw_subscription_events": ["monthly_revenue"],
    "raw_watch_events": ["completion_percentage"],
    "raw_support_tickets": ["resolution_time_hours", "sentiment_score"],
    "user_title_summary": ["max_completion"],
    "popularity_share": ["popularity"],
    "plan_change_type": ["monthly_revenue", "previous_monthly_revenue"],
}

_NAMED = re.compile(r"\b(?:from|join)\s+(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needed(name: str, done: dict[str, None]) -> dict[str, None]:
    for other in dict.fromkeys(_NAMED.findall(re.sub(r"'[^']*'", "", CTES[name]))):
        if other != name and other not in done:
            _needed(other, done)
    done[name] = None
    return done


def oracle(query: str) -> str:
    name = _SAME.get(query, query)
    ctes = ",\n".join(f"{cte} as ({CTES[cte]})" for cte in _needed(name, {}))
    doubles = ", ".join(f"cast({c} as double) as {c}" for c in _DECIMAL_COLUMNS.get(name, ()))
    chosen = f"* replace ({doubles})" if doubles else "*"
    return f"with {ctes}\nselect {chosen} from {name}"


def _build() -> dict[str, str]:
    from stayline.plans.queries import QUERIES

    return {name: oracle(name) for name in QUERIES if name not in _NO_ORACLE}


ORACLES = _build()
