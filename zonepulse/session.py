"""Session builder with the settings the plans are designed for.

On a cluster the platform owns sizes: memory and the number of shuffle partitions are left
to it (adaptive execution only merges partitions, it never adds any, so a small default
would cap the parallelism of every shuffle).  What matters to these plans:
* adaptive execution on (coalesce small shuffles, split skewed join partitions, switch
  joins to broadcast when a side turns out small);
* ANSI mode left on; all parsing of outside text uses try_* forms.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def tuned_builder(
    master: str | None = None, shuffle_partitions: int | None = None, scratch: str | None = None
) -> SparkSession.Builder:
    b = SparkSession.builder.appName("zonepulse")
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if scratch:
        # Local runs only: shuffle spill and event log stay in the run's scratch folder.
        b = b.config("spark.local.dir", scratch)
    return b
