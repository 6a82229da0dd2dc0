"""The declared data tests, by table. 53 not_null, 16 unique, 12 accepted_values, 8 relationships."""

from __future__ import annotations

from stayline.functions import vocab

_CUSTOMER = ("dim_customer", "customer_key")
_CONTENT = ("dim_content", "content_key")
_DAY = ("dim_date", "date_day")

CHECKS: dict[str, dict] = {
    "raw_content_catalog": {
        "not_null": ["content_id", "title", "content_type"],
        "accepted_values": {"content_type": vocab.CONTENT_TYPES},
    },
    "raw_users": {
        "not_null": ["customer_id", "signup_date"],
        "accepted_values": {"plan_type": vocab.PLANS, "activity_level": vocab.ACTIVITY_LEVELS},
    },
    "raw_subscription_events": {
        "not_null": ["customer_id", "event_type", "event_date"],
        "accepted_values": {"event_type": vocab.EVENT_TYPES},
    },
    "raw_watch_events": {"not_null": ["watch_event_id", "customer_id", "content_id", "watch_date"]},
    "raw_user_ratings": {
        "not_null": ["rating_id", "customer_id", "content_id", "rating"],
        "accepted_values": {"rating": vocab.RATINGS},
    },
    "raw_user_watchlist": {"not_null": ["watchlist_id", "customer_id", "content_id", "added_at"]},
    "raw_support_tickets": {"not_null": ["ticket_id", "customer_id"]},
    "stg_customers": {"not_null": ["customer_key", "customer_id"], "unique": ["customer_key", "customer_id"]},
    "stg_subscription_events": {
        "not_null": ["subscription_event_key", "customer_id"],
        "unique": ["subscription_event_key"],
    },
    "stg_support_tickets": {"not_null": ["interaction_key", "ticket_id"], "unique": ["interaction_key", "ticket_id"]},
    "stg_content_catalog": {"not_null": ["content_key", "content_id"], "unique": ["content_key", "content_id"]},
    "dim_date": {"not_null": ["date_day"], "unique": ["date_day"]},
    "dim_customer": {
        "not_null": ["customer_key", "customer_id"],
        "unique": ["customer_key", "customer_id"],
        "accepted_values": {"plan_type": vocab.PLANS},
    },
    "dim_content": {
        "not_null": ["content_key", "content_id"],
        "unique": ["content_key", "content_id"],
        "accepted_values": {"content_type": vocab.CONTENT_TYPES},
    },
    "fct_watch_event": {
        "not_null": ["watch_event_key", "customer_key", "content_key", "date_day"],
        "unique": ["watch_event_key"],
        "accepted_values": {"engagement_level": vocab.ENGAGEMENT_LEVELS},
        "relationships": {"customer_key": _CUSTOMER, "content_key": _CONTENT, "date_day": _DAY},
    },
    "fct_support_interaction": {
        "not_null": ["interaction_key", "customer_key", "date_day"],
        "unique": ["interaction_key"],
        "accepted_values": {
            "sentiment_tier": vocab.SENTIMENT_TIERS,
            "resolution_tier": vocab.RESOLUTION_TIERS,
        },
        "relationships": {"customer_key": _CUSTOMER},
    },
    "fct_daily_user_activity": {
        "not_null": ["activity_key", "customer_key", "date_day", "sessions_count", "daily_engagement_score"],
        "unique": ["activity_key"],
        "relationships": {"customer_key": _CUSTOMER, "date_day": _DAY},
    },
    "fct_subscription_event": {
        "not_null": [
            "subscription_event_key",
            "customer_key",
            "date_day",
            "event_type",
            "plan_type",
            "monthly_revenue",
        ],
        "unique": ["subscription_event_key"],
        "accepted_values": {"event_type": vocab.EVENT_TYPES, "plan_type": vocab.PLANS},
        "relationships": {"customer_key": _CUSTOMER, "date_day": _DAY},
    },
}
KINDS = ("not_null", "unique", "accepted_values", "relationships")


def count_by_kind() -> dict[str, int]:
    return {kind: sum(len(declared.get(kind, ())) for declared in CHECKS.values()) for kind in KINDS}
