"""Generic DataFrame operators (joins, flags, first-row, windows, series)."""

from churnlab.operators.core import (  # noqa: F401
    active_months,
    activity_maps,
    anti_orphans,
    daily_activity,
    first_per_key,
    orphan_keys,
    retention_flags,
    stage_flags,
    union_all,
)
