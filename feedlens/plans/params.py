"""Reference dates and parameters used by the registered queries.

The reference runs on "today"; the fixture data covers 2024-01-01..2024-01-30,
so the registered queries pin the equivalent dates inside it.
"""

AS_OF = "2024-01-31"  # "today": yesterday is 2024-01-30, the last day of data
EXP_START, EXP_END = "2024-01-15", "2024-01-21"  # experiment week
PRE_START, PRE_END = "2024-01-08", "2024-01-14"  # pre-period of the power study
MONTH_START, MONTH_END = "2024-01-01", "2024-02-01"  # dashboard month, half-open
ANOMALY_START, ANOMALY_END = "2024-01-05", "2024-01-11"  # flagged period
HOLDOUT_DAYS = 14
HORIZON_DAYS = 30
N_BOOTSTRAP = 2000
N_BUCKETS = 50
SMOOTHING_ALPHA = 5.0
SIGNIFICANCE = 0.05
SEED = 42
# Effect of the simulated algorithm: +1 or +2 views with probability 0.9 for
# users at or above the views threshold.  The reference threshold is 50; fixture
# users have 1 to 13 views a week, so the registered power query uses 6.
EFFECT_PROBABILITY = 0.9
EFFECT_VIEWS_THRESHOLD = 6
