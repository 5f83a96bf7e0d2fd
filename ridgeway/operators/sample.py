"""First-N rows by an integer key (the training-sample operator), exact and bounded.

``orderBy(key).limit(n)`` plans as TakeOrderedAndProject: one scan, every partition sends its own
top n to ONE final task, which grows with the number of partitions.  That is the plan while n x partitions
is at most ``DIRECT_ROWS`` (plan only: the same rows).  Beyond it a bound on the
key is found first: the keys' range is cut into equal buckets, ``groupBy(bucket).count()``
(at most ``buckets`` rows a task and in the result) shows which bucket holds the n-th row, and
that bucket is cut again until at most ``slack * n`` rows lie at or below its end, or it is a
single key.  ``key <= bound`` is pushed into the scan, and the final top-n sees few rows.

Rows with a NULL key are not in the order and never in the sample, whatever the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT_ROWS = 100_000


def first_n_by(df: DataFrame, key: str, n: int, buckets: int = 1024, slack: float = 4.0) -> DataFrame:
    known = df.filter(F.col(key).isNotNull())
    if n <= 0:
        return known.limit(0)
    if n * known.rdd.getNumPartitions() <= DIRECT_ROWS:
        return known.orderBy(key).limit(n)
    r = known.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()[0]
    if r["lo"] is None:
        return known.limit(0)
    lo, hi, below = int(r["lo"]), int(r["hi"]), 0
    while True:
        width = (hi - lo) // buckets + 1
        inside = known.filter((F.col(key) >= F.lit(lo)) & (F.col(key) <= F.lit(hi)))
        # two steps of a subtraction that could leave int64 are done in decimal
        at = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(str(lo)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)")).cast("int")
        counts = {c["b"]: c["count"] for c in inside.groupBy(at.alias("b")).count().collect()}  # at most `buckets` rows
        total, end = below, None
        for b in sorted(counts):
            if total + counts[b] >= n:
                end = b
                break
            total += counts[b]
        if end is None:            # fewer than n rows in all
            return known.orderBy(key).limit(n)
        lo, hi = lo + end * width, min(hi, lo + (end + 1) * width - 1)
        if width == 1 or total + counts[end] <= slack * n:
            return known.filter(F.col(key) <= F.lit(hi)).orderBy(key).limit(n)
        below = total
