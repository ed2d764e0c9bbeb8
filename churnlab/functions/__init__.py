"""Column-level functions: calendar arithmetic, buckets, stable hashing."""

from churnlab.functions.dates import (  # noqa: F401
    add_days,
    add_days_ts,
    as_date,
    date_lit,
    day_diff,
    month_diff,
    month_series,
    month_start,
    week_start,
)
from churnlab.functions.scalar import (  # noqa: F401
    bucketize,
    hash_bucket,
    ratio,
)
