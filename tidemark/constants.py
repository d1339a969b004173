"""Fixed values that must equal the load conventions being rebuilt.

Fixed values: housekeeping column names (in table order), their defaults, the
prefix given to source columns that collide with them, the default period
start, the check-window grace, the "no earliest override" sentinel and the
message of a check.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values -----------------------------------------------------------
HOUSEKEEPING_COLUMNS = (
    "ID",
    "INSERT_DTTM",
    "UPDATE_DTTM",
    "LST_MOD_USER",
    "MSTR_LOAD_ID",
    "ACTIVE_FLAG",
)
RESERVED_PREFIX = "S_"
ACTIVE = 1
DEFAULT_PERIOD_START = _dt.datetime(2000, 1, 1)
NO_EARLIEST_OVERRIDE = _dt.datetime(1990, 1, 1)
CHECK_GRACE_HOURS = 5
MISSING_MESSAGE = "{job} : MIN DTTM MISSING FROM TARGET : {dttm} in SEARCH date range {start} and {end}"
# ---------------------------------------------------------------------------

# Merge actions carried in the ``_action`` column of a merge result.
INSERT = "INSERT"
UPDATE = "UPDATE"
UNCHANGED = "UNCHANGED"
TARGET_ONLY = "TARGET_ONLY"
ACTION_COL = "_action"

RESERVED_UPPER = frozenset(HOUSEKEEPING_COLUMNS)
