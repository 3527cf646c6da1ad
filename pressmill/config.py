"""Parameters. The numbers are fixed values: results depend on them."""

from __future__ import annotations

from dataclasses import dataclass, field

REGION_ORDER = {"CZ": 0, "EU": 1, "US": 2, "GLOBAL": 3}

# fixed values: preference of source types when copies are resolved (others: 9)
SOURCE_PRIORITY = {
    "research": 0, "polling": 0, "think_tank": 1, "journal": 1, "government": 2, "ngo": 3, "industry": 4, "media": 5,
}
SOURCE_PRIORITY_OTHER = 9

SUPPRESSED_WEEK = "0000-W00"


@dataclass(frozen=True)
class Selection:
    max_items: int = 35
    max_per_org: int = 3
    max_media_share: float = 0.4
    max_journal_share: float = 0.25
    max_per_cluster: int = 2
    cluster_threshold: float = 70.0
    min_domestic: int = 12
    min_attitudes: int = 5
    media_items: int = 6
    min_relevance: int = 3
    title_threshold: float = 90.0
    undated_first_run_cap: int = 3
    grace_days: int = 3
    seen_retention_weeks: int = 30

    def type_caps(self) -> dict[str, int]:
        return {"media": int(self.max_items * self.max_media_share),
                "journal": int(self.max_items * self.max_journal_share)}


@dataclass(frozen=True)
class ScoreWeights:
    domestic_impact: float = 1.5
    eu_impact: float = 0.8
    geo: dict = field(default_factory=lambda: {"CZ": 1.0, "EU": 0.5, "US": -0.5, "GLOBAL": 0.0})
    attitudes: float = 1.5
    research: float = 0.8
    opinion: float = -0.8
    event: float = -4.0
    source_type: dict = field(default_factory=lambda: {
        "polling": 0.6, "research": 0.5, "think_tank": 0.4, "government": 0.3, "journal": 0.2, "ngo": 0.0,
        "media": 0.0, "industry": -0.3, "funding": -0.5})
    source_weight: float = 2.0


@dataclass(frozen=True)
class Fetch:
    max_items_per_source: int = 60
    max_items_monitored: int = 5000
    stale_days: int = 60


@dataclass(frozen=True)
class Calls:
    max_items: int = 6
    pool_max: int | None = 70
    max_months: int = 6
    reminder_days: int = 45
    lookback_days: int = 30
    max_per_programme: int = 3


@dataclass(frozen=True)
class Media:
    max_classify: int = 900
    batch_size: int = 40
    max_articles: int = 160
    min_relevant: int = 5


@dataclass(frozen=True)
class Scoring:
    batch_size: int = 25
    max_items: int = 320
    budget_usd: float = 0.45
    output_tokens_per_item: int = 160


@dataclass(frozen=True)
class Rotation:
    weak_weeks: int = 4
    pause_weeks: int = 4
    max_per_run: int = 5
    history_weeks: int = 16


SENTIMENT_MIN_ROWS = 8
SENTIMENT_WEIGHT_FLOOR = 0.1
VALIDATION_RELEVANT_FROM = 5
VALIDATION_SEED = 42

# fixed values: USD per million tokens (input, output, cache write, cache read); empty = derived from input
CACHE_WRITE_FACTOR = 1.25
CACHE_READ_FACTOR = 0.1

# fixed values: journals followed by the academic job (name, ISSN, keyword filter needed)
JOURNALS = [
    ("Nature Climate Change", "1758-678X", False),
    ("Nature Energy", "2058-7546", False),
    ("Global Environmental Change", "0959-3780", False),
    ("Energy Research & Social Science", "2214-6296", False),
    ("Energy Policy", "0301-4215", True),
    ("Climatic Change", "0165-0009", False),
    ("Climate Policy", "1469-3062", False),
    ("Environmental Politics", "0964-4016", True),
    ("Joule", "2542-4351", True),
    ("One Earth", "2590-3322", True),
    ("PNAS", "0027-8424", True),
]
JOURNAL_WEIGHT = 1.1
