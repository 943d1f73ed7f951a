"""Fixed values and defaults.

Values in the FIXED block must equal the behaviour being reproduced
(event ids, routing rules, report ids and labels, year length).  Names of
topics, tables and indexes are only defaults; every job takes them as
parameters.
"""

# ---- FIXED VALUES (must stay as written) -----------------------------------
# Event ids that drive the coupon alert.
EVID_CLICK = "clickItem"
EVID_COUPON = "coupon"

# Change-feed entry type that carries row data; other entry types are
# transaction markers and are dropped.
ENTRY_ROWDATA = "ROWDATA"

# Router: (source table, event types) -> logical stream.
ROUTES = (
    ("order_info", ("INSERT",), "order"),
    ("order_detail", ("INSERT",), "order_detail"),
    ("user_info", ("INSERT", "UPDATE"), "user"),
)

# Report ids and display names of the three totals, in output order.
TOTAL_METRICS = (
    ("dau", "新增日活"),
    ("new_mid", "新增设备"),
    ("order_amount", "新增交易额"),
)

# Gender recode used by the sale-search facet, as written: M -> 女, F -> 男.
GENDER_LABELS = (("M", "女"), ("F", "男"))

# Age bands of the sale-search facet: under 20, 20 to under 30, 30 and over.
AGE_BANDS = ("20岁以下", "20-30岁", "30岁以上")

# Age in whole 365-day years, no leap days.
MS_PER_YEAR = 365 * 24 * 60 * 60 * 1000
MS_PER_DAY = 24 * 60 * 60 * 1000
MS_PER_MINUTE = 60 * 1000
# ---- end of fixed values ----------------------------------------------------

# Defaults (parameters, not fixed behaviour).
DEFAULT_TOPICS = {
    "startup": "startup",
    "event": "event",
    "order": "order",
    "order_detail": "order_detail",
    "user": "user_info",
}
SALE_DETAIL_INDEX = "sale_detail"
ALERT_WINDOW = "5 minutes"
ALERT_SLIDE = "5 seconds"
ALERT_MIN_USERS = 3
JOIN_LATE_BOUND = "10 seconds"
TRIGGER_INTERVAL = "5 seconds"
