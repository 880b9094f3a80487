"""Inner equi-joins.

No side is forced into a broadcast: Spark broadcasts a side whose size it knows
to be under `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles,
where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt: int | None = None) -> DataFrame:
    """Inner join on equal keys, which are kept once.

    `salt` spreads each key of `left` over that many partitions and repeats the
    rows of `right`, the smaller side, as often; for hot keys where adaptive
    execution is off or the split parts would still be too large.
    """
    if not salt or salt < 2:
        return left.join(right, list(keys))
    # With the partition in the hash, equal rows spread too.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(salt)).cast("int")
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return left.withColumn("_salt", spread).join(repeated, [*keys, "_salt"]).drop("_salt")


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-group statistics back to the rows, NULL keys included.

    Spark broadcasts few groups and joins many by a shuffle.
    """
    renamed = stats.withColumnsRenamed({k: f"_stat_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_stat_{k}")) for k in keys]
    return df.join(renamed, match).drop(*[f"_stat_{k}" for k in keys])
