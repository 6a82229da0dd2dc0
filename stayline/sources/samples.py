"""The raw tables derived from the generic test tables, as SQL that Spark and DuckDB both run.

A name in braces is a table: DuckDB gets the plain name, Spark gets the DataFrame. The texts are fixtures for the checks
and the bench; a production job reads its own raw tables with ``stayline.sources.tables``.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2024, 6, 30)

_CUSTOMER = "concat('CUST_', lpad(cast({} as string), 6, '0'))"
_TITLE = "concat(case when p_size % 4 = 0 then 'TMDB_T_' else 'TMDB_M_' end, cast(p_partkey as string))"
_SIGNUP = "date '2023-01-15' + cast(c_custkey * 37 % 330 as int)"
_NEW_PLAN = "(c_custkey + 1 + c_custkey % 2) % 3"


def _device(value: str) -> str:
    return (
        f"case {value} % 5 when 0 then 'smart_tv' when 1 then 'mobile' when 2 then 'tablet' "
        "when 3 then 'desktop' else 'gaming_console' end"
    )


def _plan(value: str) -> str:
    return f"case {value} when 0 then 'basic' when 1 then 'standard' else 'premium' end"


def _price(value: str) -> str:
    return f"cast(case {value} when 0 then 9.99 when 1 then 15.49 else 22.99 end as decimal(10,2))"


RAW_SQL: dict[str, str] = {}

RAW_SQL["raw_users"] = f"""
select {_CUSTOMER.format("c_custkey")} customer_id,
  concat('u', cast(c_custkey as string), '@example.com') email, n_name country,
  cast(18 + c_custkey % 53 as int) age, {_SIGNUP} signup_date,
  {_plan("c_custkey % 3")} plan_type, {_price("c_custkey % 3")} monthly_revenue,
  c_custkey % 20 < 3 is_churned,
  case when c_custkey % 20 < 3 then {_SIGNUP} + cast(30 + c_custkey * 11 % 336 as int) end churn_date,
  case c_mktsegment when 'AUTOMOBILE' then 'organic' when 'BUILDING' then 'paid_search' when 'FURNITURE' then 'social'
    when 'HOUSEHOLD' then 'referral' else 'tv_ad' end acquisition_channel,
  {_device("c_nationkey")} device_type,
  case c_custkey % 2 when 0 then 'Action|Drama' else 'Comedy|Crime|Drama' end preferred_genres,
  case when c_custkey % 5 = 0 then 'low' when c_custkey % 5 < 3 then 'medium' else 'high' end activity_level
from {{customer}} join {{nation}} on c_nationkey = n_nationkey
"""

# Every 50th title was loaded twice; the second load is a day later.
RAW_SQL["raw_content_catalog"] = f"""
select {_TITLE} content_id, cast(p_partkey as string) tmdb_id, p_name title,
  case when p_size % 4 = 0 then 'tv_show' else 'movie' end content_type,
  case p_type when 'ECONOMY' then 'Action|Drama' when 'MEDIUM' then 'Comedy' when 'PROMO' then 'Crime|Drama'
    else 'Drama' end genres,
  case p_type when 'ECONOMY' then 'Action' when 'MEDIUM' then 'Comedy' when 'PROMO' then 'Crime'
    else 'Drama' end primary_genre,
  case when p_partkey % 17 = 0 then ''
    else cast(date '2010-01-01' + cast(p_partkey * 29 % 5200 as int) as string) end release_date,
  cast(p_partkey * 7 % 101 as decimal(10,1)) / 10 vote_average, p_partkey * 13 % 9000 vote_count,
  cast(p_retailprice as decimal(10,2)) popularity, 'en' original_language, p_name overview,
  case when p_partkey % 13 <> 0 then 20 + p_size * 2 end runtime_minutes,
  loaded_at _loaded_at
from (
  select p_partkey, p_size, p_type, p_name, p_retailprice, timestamp '2024-06-28 06:00:00' loaded_at from {{part}}
  union all
  select p_partkey, p_size, p_type, p_name, p_retailprice, timestamp '2024-06-29 06:00:00' from {{part}}
  where p_partkey % 50 = 0
) loads
"""

RAW_SQL["raw_watch_events"] = f"""
select concat('WE_', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', cast(l_partkey as string), '_',
    cast(l_suppkey as string), '_', cast(cast(l_shipdate as date) as string)) watch_event_id,
  {_CUSTOMER.format("o_custkey")} customer_id, {_TITLE} content_id,
  date '2024-01-01' + cast((l_orderkey * 13 + l_linenumber * 7) % 182 as int) watch_date,
  '20:00:00' watch_start_time, cast(l_quantity * 3 as int) watch_duration_minutes,
  cast(round(l_discount * 1000) as decimal(5,2)) completion_percentage,
  {_device("l_suppkey")} device_type, concat('SESS_', cast(l_orderkey as string)) session_id,
  l_returnflag = 'R' is_resumed
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey
where o_custkey % 11 <> 0
"""

RAW_SQL["raw_subscription_events"] = f"""
select {_CUSTOMER.format("c_custkey")} customer_id, 'subscribe' event_type, {_SIGNUP} event_date,
  {_plan("c_custkey % 3")} plan_type, {_price("c_custkey % 3")} monthly_revenue,
  cast(null as string) cancellation_reason
from {{customer}} join {{nation}} on c_nationkey = n_nationkey
union all
select {_CUSTOMER.format("c_custkey")},
  case when {_NEW_PLAN} > c_custkey % 3 then 'upgrade' else 'downgrade' end,
  {_SIGNUP} + cast(30 + c_custkey * 7 % 151 as int), {_plan(_NEW_PLAN)}, {_price(_NEW_PLAN)}, cast(null as string)
from {{customer}} where c_custkey % 10 < 3
union all
select {_CUSTOMER.format("c_custkey")}, 'cancel', {_SIGNUP} + cast(30 + c_custkey * 11 % 336 as int),
  {_plan("c_custkey % 3")}, cast(0 as decimal(10,2)),
  case when (18 + c_custkey % 53) % 2 = 0 then 'too_expensive' else 'technical_issues' end
from {{customer}} join {{nation}} on c_nationkey = n_nationkey where c_custkey % 20 < 3
"""

RAW_SQL["raw_support_tickets"] = f"""
select concat('TKT_', cast(event_id as string)) ticket_id,
  case when event_id % 97 = 0 then 'CUST_UNKNOWN' else {_CUSTOMER.format("user_id")} end customer_id,
  case event_id % 4 when 0 then 'billing' when 1 then 'technical' when 2 then 'content' else 'account' end category,
  case event_id % 3 when 0 then 'chat' when 1 then 'email' else 'phone' end channel, ts created_at,
  cast(cast(5 + event_id * 7 % 715 as decimal(10,1)) / 10 as decimal(10,1)) resolution_time_hours,
  event_id % 20 >= 3 is_resolved,
  cast(cast(event_id * 13 % 201 - 100 as decimal(10,2)) / 100 as decimal(5,2)) sentiment_score
from {{events}} where event_type in ('error', 'signup')
"""

RAW_SQL["raw_user_ratings"] = f"""
select concat('RAT_', cast(event_id as string)) rating_id, {_CUSTOMER.format("user_id")} customer_id,
  {_TITLE} content_id, cast(1 + event_id % 5 as int) rating, cast(ts as date) rated_at
from {{events}} join {{part}} on p_partkey = event_id % 200 where event_type in ('purchase', 'click')
"""

RAW_SQL["raw_user_watchlist"] = f"""
select concat('WL_', cast(event_id as string)) watchlist_id, {_CUSTOMER.format("user_id")} customer_id,
  {_TITLE} content_id, cast(ts as date) added_at, event_id % 5 < 2 is_watched
from {{events}} join {{part}} on p_partkey = event_id % 200 where event_type = 'view'
"""

BASE_TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")

class RawTables(Mapping):
    """The seven raw tables as lazy DataFrames over the parquet files of a folder, each set up when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._base: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}

    def _base_table(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._base[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._raw:
            used = {table: self._base_table(table) for table in BASE_TABLES if f"{{{table}}}" in RAW_SQL[name]}
            self._raw[name] = self._spark.sql(RAW_SQL[name], **used)
        return self._raw[name]

    def __iter__(self):
        return iter(RAW_SQL)

    def __len__(self) -> int:
        return len(RAW_SQL)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def duckdb_sql(name: str) -> str:
    """The same raw table as a DuckDB query over the plain table names."""
    return RAW_SQL[name].format(**{table: table for table in BASE_TABLES})
