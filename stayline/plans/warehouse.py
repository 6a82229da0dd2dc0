"""The warehouse as a graph of named tables, each a function of the ones it reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from stayline.operators import dims, facts, features, staging
from stayline.session import cut_lineage

Store = Callable[[str, str, DataFrame], DataFrame]

STAGING = {
    "stg_customers": lambda w: staging.stg_customers(w["raw_users"]),
    "stg_subscription_events": lambda w: staging.stg_subscription_events(w["raw_subscription_events"]),
    "stg_support_tickets": lambda w: staging.stg_support_tickets(w["raw_support_tickets"]),
    "stg_watch_events": lambda w: staging.stg_watch_events(w["raw_watch_events"]),
    "stg_user_ratings": lambda w: staging.stg_user_ratings(w["raw_user_ratings"]),
    "stg_user_watchlist": lambda w: staging.stg_user_watchlist(w["raw_user_watchlist"]),
    "stg_content_catalog": lambda w: staging.stg_content_catalog(w["raw_content_catalog"]),
}
MARTS = {
    "dim_customer": lambda w: dims.dim_customer(w["stg_customers"]),
    "dim_content": lambda w: dims.dim_content(w["stg_content_catalog"], w.as_of),
    "dim_date": lambda w: dims.dim_date(w.spark, week=w.week),
    "fct_watch_event": lambda w: facts.fct_watch_event(
        w["stg_watch_events"],
        w["dim_customer"],
        w["dim_content"],
        completion_scale=w.completion_scale,
        unusual=w.unusual_titles() if w.keeps("fct_watch_event") else None,
        unusual_customers=w.unusual_customers() if w.keeps("fct_watch_event") else None,
    ),
    "fct_support_interaction": lambda w: facts.fct_support_interaction(w["stg_support_tickets"], w["dim_customer"]),
    "fct_daily_user_activity": lambda w: facts.fct_daily_user_activity(
        w["stg_watch_events"], w["stg_user_ratings"], w["stg_user_watchlist"], w["dim_customer"]
    ),
    "fct_subscription_event": lambda w: facts.fct_subscription_event(
        w["stg_subscription_events"], w["dim_customer"], w["dim_date"]
    ),
    "ml_churn_feature_store": lambda w: features.feature_table(
        w["dim_customer"],
        w["fct_watch_event"],
        w["fct_subscription_event"],
        w["fct_support_interaction"],
        w["stg_user_ratings"],
        w["stg_user_watchlist"],
        w.as_of,
        w["dim_content"],
        w.keeps("fct_watch_event"),
    ),
}
# Staging models stay views, but the deduplicated catalogue is worth storing.
STORED = {"stg_content_catalog": "staging"} | {name: "marts" for name in MARTS}

# Fixed value: unusual titles or customers that are broadcast; a longer list is joined.
UNUSUAL_MAX = 100_000


# Raw rows that a fact which is written reads three times: parsed or joined once, and written as they came.
READ_AGAIN = "raw_watch_events"


class Warehouse(Mapping):
    """Tables by name, each built on first use from the raw tables.

    Without a ``store`` everything is lazy and only what an action touches is computed. With one, each stored table is
    written once and read back, so later steps scan pruned columns of its files and a lost executor never replays the
    graph. ``cut`` names tables that are written once without a store, and the columns that are kept of them: for one that several
    branches of a plan read.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: date,
        store: Store | None = None,
        week: str = "iso",
        completion_scale: int = 1,
        cut: Mapping[str, Sequence[str]] = MappingProxyType({}),
    ):
        self._cut = cut
        self.as_of, self.week, self.completion_scale = as_of, week, completion_scale
        self._raw, self._store = raw, store
        self._models = STAGING | MARTS
        self._tables: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self._raw["raw_users"].sparkSession

    def keeps(self, name: str) -> bool:
        """Whether a table is written when it is built."""
        return bool(self._store and name in STORED) or name in self._cut

    def unusual_titles(self) -> DataFrame | None:
        """The list that spares the viewings a shuffle, written once, if it is short."""
        return self._short(facts.unusual_titles(self["stg_watch_events"], self["dim_content"]))

    def unusual_customers(self) -> DataFrame | None:
        return self._short(facts.unusual_customers(self["stg_watch_events"], self["dim_customer"]))

    def _short(self, unusual: DataFrame) -> DataFrame | None:
        found = cut_lineage(unusual)
        return found if found.count() <= UNUSUAL_MAX else None

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._raw:
            if name != READ_AGAIN or not self.keeps("fct_watch_event"):
                return self._raw[name]
            if name not in self._tables:
                self._tables[name] = cut_lineage(self._raw[name])
            return self._tables[name]
        if name not in self._tables:
            table = self._models[name](self)
            if self._store and name in STORED:
                table = self._store(STORED[name], name, table)
            elif name in self._cut:
                table = cut_lineage(table.select(*self._cut[name]))
            self._tables[name] = table
        return self._tables[name]

    def __iter__(self):
        return iter([*self._raw, *self._models])

    def __len__(self) -> int:
        return len(self._raw) + len(self._models)


def run(raw: Mapping[str, DataFrame], as_of: date, store: Store | None = None, **options) -> dict[str, DataFrame]:
    """Every table, in dependency order; with a ``store`` this is the daily full rebuild."""
    warehouse = Warehouse(raw, as_of, store, **options)
    return {name: warehouse[name] for name in warehouse}
