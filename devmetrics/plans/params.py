"""Fixed parameters of the registered queries (shared by the Spark plans and their DuckDB oracles)."""

from devmetrics.functions.values import NS_PER_SECOND

# 2024-02-01T00:00:00Z: "now" for lookback, retention and pending checks (the data spans January 2024).
NOW_NS = 1_706_745_600 * NS_PER_SECOND
FLAGSHIP_GPU = "7"
FLAGSHIP_START = "2024-01-10T00:00:00Z"
FLAGSHIP_END = "2024-01-20T00:00:00Z"
START_NS = 1_704_844_800 * NS_PER_SECOND  # 2024-01-10T00:00:00Z
END_NS = 1_705_708_800 * NS_PER_SECOND  # 2024-01-20T00:00:00Z
# A range whose ends fall within an hour and a minute: 2024-01-10T05:17:23.5Z to 2024-01-19T21:42:41.25Z.
UNALIGNED_START_NS = START_NS + 19_043_500_000_000
UNALIGNED_END_NS = END_NS - 8_238_750_000_000
ACK_TIMEOUT_NS = 30 * NS_PER_SECOND
SCAN_INTERVAL_NS = 10 * NS_PER_SECOND
MAX_RETRIES = 5
MAX_DELIVERIES = 2
QUEUE_MAX = 25
HIGH_WATER_PCT = 80
ROLLING_WIDTH_NS = 6 * 3600 * NS_PER_SECOND
AROUND_NS = 1_705_276_800 * NS_PER_SECOND  # 2024-01-15T00:00:00Z
#: Ack timeout and scan interval, as the ledger operators take them.
SCAN = (ACK_TIMEOUT_NS, SCAN_INTERVAL_NS)
# 2024-01-15T00:00:20Z: an instant with deliveries pending, for the counters.
COUNTERS_NS = AROUND_NS + 20 * NS_PER_SECOND
# A (GPU, day) of more rows than this is cut into parts before its rows meet in a window.
SPLIT_ROWS = 2_000_000
