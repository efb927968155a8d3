"""Default thresholds of the operators. Every operator takes them as arguments."""

from __future__ import annotations

# fixed values: thresholds of the recommendation data product
MIN_PAIR_COUNT = 2
MIN_LIST_LENGTH = 5
MAX_BUNDLE_RANK = 40
MAX_VIEW_RANK = 50
CONVICTION_EPSILON = 1e-10
INDUSTRY_CONFIDENCE = 8
INDUSTRY_TOP = 20
INDEX_WEIGHTS = {"order": 2.0, "cart": 1.5, "view": 1.0}
SIMILARITY_THRESHOLD = 0.65
SIMILARITY_TOP = 30
COLOR_THRESHOLD = 0.83
COLOR_THRESHOLD_RELAXED = 0.5
BULK_SHRINK_BELOW = 50
PRIOR_WEIGHT_QUANTILE = 0.2
EMBEDDING_DIMS = {
    "type": 18, "numeric_color": 10, "numeric_other": 4, "categorical": 4,
    "gender": 18, "sleeve": 12, "other": 12,
}

# Physical limits, independent of results: a basket above this many articles is processed in tiles.
BASKET_TILE = 512
VECTOR_TILE = 2048
