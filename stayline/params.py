"""Thresholds and vocabularies of the analytics.

Everything here is a *fixed value* that results depend on; functions take them as
parameters and use these as defaults.
"""

from __future__ import annotations

# -- fixed values: visits and snapshots --------------------------------------------------
HORIZON_DAYS = 548          # spend counts while within a year and a half of the first day
MATURITY_DAYS = 270         # a patient must have been known this long to be trained on
MAX_MODEL_VISIT = 5         # one model per visit number 1..5
PROMO_PREFIX = "First Day Daycare Fre"

# -- fixed values: labels ----------------------------------------------------------------
SPEND_CAP = 5000
BAND_EDGES = (0, 1, 200, 350, 500, 1000, 99999)     # right-closed, lowest edge included
BINARY_EDGES = (0, 1, 99999)
N_BANDS = 6

# -- fixed values: product groups --------------------------------------------------------
GROUP_PREFIXES = {"Retail": "Retail", "Medication": "Medication", "Referrals": "Referrals"}
GROUP_MEMBERS = {
    "Boarding": ("Boarding", "Daycare", "Daycare Packages"),
    "admin": ("to print", "To Print", "Administration"),
}

# -- fixed values: category vocabularies of the feature matrix ---------------------------
BREED_SIZES = ("cat", "large", "medium", "other_animal", "small")
TIERS = {"None": "tier_other", "tier_1": "tier_1", "tier_2": "tier_2", "tier_3": "tier_3", "tier_4": "tier_4"}
SIZE_PRIORITY = ("small", "medium", "large", "cat", "other_animal")     # later wins
DEFAULT_SIZE = "medium"
DEFAULT_TIER = ("oth", 0.0)

# -- fixed values: scoring ---------------------------------------------------------------
MISSING_WEIGHT = -999
DEFAULT_AGE = 10
LOCAL_ZONE = "America/Chicago"

# -- fixed values: return study ----------------------------------------------------------
RETURN_DAY_REVENUE = 100
EXCLUDED_GROUP = "Surgical Services"
EXCLUDED_NAME_PART = "Subscri"
EXCLUDED_PROCEDURE = "Examination"
DIRTY_BREED = "0.0"
FREQUENT_NAME_ROWS = 75
HIST_BINS = 50

# -- fixed values: staffing --------------------------------------------------------------
REV_PER_HOUR_MAX = 99999
OUTLIER_REV_PER_HOUR = 200

# -- fixed values: model settings --------------------------------------------------------
TREE_DEPTH = 5
BOOST_ROUNDS = 20
TRAIN_PERCENT = 80
SPLIT_SEED = 42
KEEP_RUNS = 5
