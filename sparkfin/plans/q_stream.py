"""Streaming query."""
from __future__ import annotations

import hashlib

from ..session import ensure_checkpoint_dir
from ..streaming.daily import daily_windows
from .registry import register


@register("stream_daily_windows", """
SELECT cast(date_trunc('day', ts) AS date) AS day, event_type, count(*) AS n_events,
       cast(sum(cast(value AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum
FROM (SELECT DISTINCT ON (event_id) * FROM events) e
GROUP BY 1, 2""")
def stream_daily_windows(spark, sf):
    """One folder per source under the shared checkpoint folder: a second call
    goes on from the first, unless a file was replaced."""
    name = hashlib.md5(sf.encode()).hexdigest()
    return daily_windows(spark, sf, f"{ensure_checkpoint_dir(spark)}/stream_daily/{name}")
