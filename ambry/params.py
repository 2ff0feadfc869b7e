"""Fixed parameters of the jobs.

Values marked *fixed values* must equal the reference's for identical
results; the rest are test-fixture choices (see FIXTURES.md §3).
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------- fixed values
# Score weight parameter names, in the order the scoring query reads them.
WEIGHT_NAMES = [
    "Seller Rating",
    "Stock Availability",
    "GMV",
    "Newly Added Product",
    "Order Count",
    "Product Rating",
    "Deal Bowl Participation",
    "CTR/Product View",
]
# Stock availability buckets: (lower bound inclusive, upper bound inclusive or
# None for open, factor).  Everything else (<= 0 or NULL) scores 0.
STOCK_BUCKETS = [
    (101, None, "1.0"),
    (51, 100, "0.55"),
    (11, 50, "0.40"),
    (1, 10, "0.25"),
]
NEW_PRODUCT_DAYS = 7                 # "created in the last 7 days"
REFERENCE_ORDER_WINDOW_DAYS = 7      # order items window of the reference
EXCLUDED_PACKAGE_STATUS = 23         # order status that does not count
APPROVED_STATUS = 1                  # product approval status that is scored
DEFAULT_WATERMARK = _dt.datetime(1900, 1, 1, 1, 1, 1)   # missing state row
SYNC_OVERLAP_HOURS = 6               # bronze watermark = run time - 6 h
ERROR_TEXT_LIMIT = 1000              # audit row error text is cut here
# ------------------------------------------------------------ end fixed values

# A key with at least this many rows on the many side of a join is "hot":
# its rows are joined against a broadcast of its (unique) partner rows
# instead of being shuffled into one task (ambry.operators.skew).
HOT_KEY_ROWS = 1_000_000
# Largest written table (key sets, small aggregates, dimensions projected to
# what a join needs) that is broadcast, in bytes of its files; a few times
# that in an executor's memory (ambry.operators.materialize).
BROADCAST_MAX_BYTES = 32 << 20
# Buckets over which rows with a NULL join key are spread (they never match).
NULL_KEY_BUCKETS = 64

# Test-fixture parameters (FIXTURES.md §3); all jobs take them as arguments.
AS_OF = _dt.datetime(2001, 11, 5)            # scoring "now"
ORDER_WINDOW_DAYS = 90                       # window on the test data
ORDERS_AS_OF = _dt.datetime(2001, 8, 2)      # warehouse "now"
SILVER_WATERMARK = _dt.datetime(2001, 7, 1)  # silver incremental watermark
BRONZE_WATERMARK = _dt.datetime(2001, 7, 1)  # bronze sync watermark
BRONZE_TARGET_UNTIL = _dt.datetime(2001, 7, 15)  # existing bronze rows end here
PUBLISH_BATCH_SIZE = 100                     # rows per published message
PUBLISH_LAST_SYNC = _dt.datetime(2001, 11, 4, 12)  # publish watermark fixture
PUBLISH_DELAY = _dt.timedelta(seconds=1)     # scores are published after they are stamped
OLD_SCORE_TS = _dt.datetime(2001, 11, 4, 9)  # updated_at of the existing scores
DIM_EPOCH = _dt.datetime(2001, 1, 1)         # dims: ts = epoch + key % DIM_DAYS days
DIM_DAYS = 3650
BRONZE_KEY_RANGE = 1000                      # keys per partition of a ranged bronze table
DRIFT_KEY_RANGE = 100                        # keys per range of a reconciliation

# Weight table of the scoring job (decimal(10,2)), FIXTURES.md §3.
WEIGHTS = {
    "Seller Rating": "10",
    "Stock Availability": "15",
    "GMV": "20",
    "Newly Added Product": "5",
    "Order Count": "15",
    "Product Rating": "15",
    "Deal Bowl Participation": "5",
    "CTR/Product View": "15",
}


def ts_sql(t: _dt.datetime) -> str:
    """A TIMESTAMP_NTZ literal usable by both Spark SQL and DuckDB."""
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"
