"""How the landed tables map onto the usage model (shared by queries and tests).

Readings come from ``events``: user_id, app := event_type or the constant
'all', t := epoch seconds of ts, power := value.  Parameters below are the
catalogue's choices for these tables, not reference settings.
"""

from __future__ import annotations

import datetime as _dt

from loadlens.settings import Thresholds

EPOCH = _dt.date(1970, 1, 1)

# Catalogue parameters (see README "Query catalogue").
DEF_APP = "all"
DEF = Thresholds({DEF_APP: [10, 300, 21600]})
AS_OF_DAY = (_dt.date(2024, 1, 29) - EPOCH).days          # data day 2024-01-29
AS_OF_YMD = AS_OF_DAY * 86400 + 54000                       # 1706540400
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
TYPE_THRESHOLDS = Thresholds({
    "click": [10, 300, 3600],
    "purchase": [10, 0, 600],
    "view": [10, 600, 3600],
})
ALL_TYPE_THRESHOLDS = Thresholds({k: [10, 0, 3600] for k in EVENT_TYPES})
LATENIGHT_SPECIAL = {7: (-7200, 18000)}
RANGE_START = "2024-01-08 00:00:00"
RANGE_END = "2024-01-15 00:00:00"
PAIR_THRESHOLDS = Thresholds({"300": [10, 0, 21600], "301": [10, 0, 21600], "300301": [10, 0, 21600]})
PAYLOAD_THRESHOLDS = Thresholds({str(k): [20, 0, 600] for k in range(1, 6)})
WM_AHEAD = 40 * 86400
WM_CUT = "2024-01-16 00:00:00"
NOW = int((_dt.datetime(2024, 1, 31) - _dt.datetime(1970, 1, 1)).total_seconds())
PAYLOAD_ST = int((_dt.datetime(2024, 1, 10) - _dt.datetime(1970, 1, 1)).total_seconds())
PAYLOAD_COMMIT = int((_dt.datetime(2024, 1, 20) - _dt.datetime(1970, 1, 1)).total_seconds())
ALLOW_REGION = 1
