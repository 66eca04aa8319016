"""Settings a deployment puts on its session builder. The library itself never builds a session."""

from __future__ import annotations

import math

MIB = 1024 * 1024


def s3a_options(
    access_key: str, secret_key: str, endpoint: str = "s3.amazonaws.com"
) -> dict[str, str]:
    """Object-store credentials and endpoint, as session options."""
    return {
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
    }


def scale_options(
    input_bytes: int,
    cores: int,
    checkpoint_dir: str,
    partition_bytes: int = 256 * MIB,
    block_bytes: int = 64 * 1024,
) -> dict[str, str]:
    """Partition counts for an input of ``input_bytes`` on ``cores`` task slots.

    A partition is about ``partition_bytes``, and there are at least two per slot. Beyond a terabyte
    shuffle partitions grow instead of only getting more: a shuffle moves one block per map and
    reduce task, so with ever more of both the blocks would shrink to nothing. They are kept at
    ``block_bytes``. Scans stay at ``partition_bytes``, which is compressed and several times that in
    a task. Adaptive execution merges what turns out small and splits what turns out skewed, even
    where that costs a further shuffle.
    """
    by_size = math.ceil(input_bytes / partition_bytes)
    by_blocks = math.isqrt(input_bytes // block_bytes)
    partitions = max(2 * cores, min(by_size, by_blocks))
    size = max(partition_bytes, math.ceil(input_bytes / partitions))
    return {
        "spark.checkpoint.dir": checkpoint_dir,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(size),
    }


def configure(builder, *option_sets: dict[str, str]):
    """Put option sets on a ``SparkSession.builder``."""
    for options in option_sets:
        for name, value in options.items():
            builder = builder.config(name, value)
    return builder
