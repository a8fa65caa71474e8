"""Values that results depend on, as plain text."""

# Segment cuts and their labels, first match wins.
CHURN_RISK = [(0.70, "High"), (0.40, "Medium")]
CHURN_RISK_DEFAULT = "Low"
LTV_TIERS = [(500, "Platinum"), (250, "Gold"), (100, "Silver")]
LTV_TIER_DEFAULT = "Bronze"
CONVERSION_PRIORITY = [
    (0.7, "Hot lead — immediate offer"),
    (0.4, "Warm lead — nurture campaign"),
]
CONVERSION_DEFAULT = "Cold lead — organic only"
ACTION_FRAUD = "Investigate fraud"
ACTION_VIP = "VIP save — immediate"
ACTION_HIGH = "High-priority save"
ACTION_PROACTIVE = "Proactive engagement"
ACTION_DEFAULT = "Standard monitoring"
CLASS_NAMES = {0: "Active", 1: "Churn"}

# Limits used in derived features.
LOW_ACTIVITY_DAYS = 10
HIGH_VALUE_CHARGES = 70
CONVERSION_CUT = 0.45
UPGRADE_CUT = 0.5
LOGIN_FAILURE_LIMIT = 5
PAYMENT_FAILURE_LIMIT = 2
LOW_HOURS = 0.1
LOW_STARTS = 10
MANY_STARTS = 100
OUTLIER_QUANTILE = 0.95
FORECAST_Z = 1.96
SEASON_WEEKS = 52

# Threshold grids in percent (first, last, step).
SWEEP_WIDE = (10, 90, 5)
SWEEP_NARROW = (20, 80, 5)
SWEEP_FINE = (10, 90, 2)
