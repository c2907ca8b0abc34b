"""Join helpers that keep broadcasts bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``small`` only after checking it has at most ``max_rows`` rows.

    For tables that are cheap to read (local lookups, small files): the check
    is one bounded job (``limit(max_rows + 1).count()``). Beyond the bound the
    frame is returned as is and the planner picks a shuffle join.

    Tables derived from the data by an aggregate are not passed here: counting
    them would recompute the aggregate. Those joins carry no hint, and AQE
    broadcasts the aggregate's output only when its measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small
