"""Value lists, thresholds and codes shared by the operators."""

from __future__ import annotations

# Fixed values. Domains of the categorical columns.
PLANS = ("basic", "standard", "premium")
ACTIVITY_LEVELS = ("low", "medium", "high")
EVENT_TYPES = ("subscribe", "upgrade", "downgrade", "cancel")
CONTENT_TYPES = ("movie", "tv_show")
RATINGS = (1, 2, 3, 4, 5)
ENGAGEMENT_LEVELS = ("completed", "engaged", "sampled", "abandoned")
SENTIMENT_TIERS = ("positive", "neutral", "negative")
RESOLUTION_TIERS = ("quick", "standard", "slow", "critical")
RISK_TIERS = ("low", "medium", "high")

# Fixed values. Bucket ladders: (bound, label) rungs in test order, then the label for everything else, NULL included.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")), "55+"
CONTENT_AGES = ((1, "new_release"), (3, "recent"), (10, "catalog")), "classic"
RATING_LADDER = ((8.0, "highly_rated"), (6.5, "well_rated"), (5.0, "average")), "below_average"
ENGAGEMENT_LADDER = ((90, "completed"), (50, "engaged"), (10, "sampled")), "abandoned"
SESSION_LADDER = ((15, "short"), (60, "medium"), (120, "long")), "binge"
RESOLUTION_LADDER = ((4, "quick"), (24, "standard"), (48, "slow")), "critical"
SENTIMENT_LADDER = ((0.3, "positive"), (-0.3, "neutral")), "negative"
RECENCY_LADDER = ((14, 5), (7, 4), (3, 3), (1, 2)), 1
RISK_TIER_LADDER = ((0.3, "low"), (0.6, "medium"), (1.0, "high"))

# Fixed values. Names and codes looked up by exact value.
REVENUE_CATEGORIES = {
    "subscribe": "new",
    "upgrade": "expansion",
    "downgrade": "contraction",
    "cancel": "churned",
}, "other"
AGE_BAND_CODES = {"18-24": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55+": 5}
PLAN_CODES = {"basic": 1, "standard": 2, "premium": 3}
CHANNEL_CODES = {"organic": 1, "referral": 2, "paid_search": 3, "social": 4, "tv_ad": 5}
DEVICE_CODES = {"smart_tv": 1, "desktop": 2, "mobile": 3, "tablet": 4, "gaming_console": 5}
ACTIVITY_CODES = {"low": 1, "medium": 2, "high": 3}

# Fixed values. Defaults and weights.
BINGE_DAY_TITLES = 3
ENGAGEMENT_WEIGHTS = {"sessions": 1.0, "completed": 2.0, "ratings": 1.5, "watchlist": 0.5}
FRUSTRATION_WEIGHTS = {"negative": 3.0, "unresolved": 2.0, "critical": 2.0}
NEVER_WATCHED_DAYS = 9999
WEEKS_IN_30_DAYS = "4.28"
LOW_RATING_MAX, HIGH_RATING_MIN = 2, 4
RISK_POINTS_MAX = 12
DEFAULT_RUNTIME = {"tv_show": 45, "movie": 90}
HIGH_NULL_RATE = 0.20
FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS = 1, 30
CALENDAR_START, CALENDAR_END = "2023-01-01", "2027-12-31"  # the end day is not part of the calendar

# Fixed values. Catalogue ids, defaults and genre names.
CONTENT_ID_PREFIX = "TMDB_"
MOVIE_ID_PREFIX, SHOW_ID_PREFIX = "TMDB_M_", "TMDB_T_"
LIST_SEPARATOR = "|"
UNKNOWN_GENRE = "Unknown"
OVERVIEW_CHARS = 200
DEFAULT_LANGUAGE = "en"
GENRES = {
    28: "Action",
    12: "Adventure",
    16: "Animation",
    35: "Comedy",
    80: "Crime",
    99: "Documentary",
    18: "Drama",
    10751: "Family",
    14: "Fantasy",
    36: "History",
    27: "Horror",
    10402: "Music",
    9648: "Mystery",
    10749: "Romance",
    878: "Science Fiction",
    10770: "TV Movie",
    53: "Thriller",
    10752: "War",
    37: "Western",
    10759: "Action & Adventure",
    10762: "Kids",
    10763: "News",
    10764: "Reality",
    10765: "Sci-Fi & Fantasy",
    10766: "Soap",
    10767: "Talk",
    10768: "War & Politics",
}
