"""Session settings by input size."""

from __future__ import annotations

MIB = 1 << 20
SMALLEST, LARGEST = 128 * MIB, 2048 * MIB
TASKS = 50_000


def session_options(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for cleaning `input_bytes` of text on `cores` executor cores.

    All rows cross one shuffle (duplicates). Its cost for the driver is the product of its map and
    reduce tasks, so the bytes per task grow with the input, from 128 MiB to 2 GiB, to keep both
    near 50,000; grouping spills where a task has less memory than that. Adaptive execution merges
    small partitions again. Rows are written to two directories (kept or not); two open files per
    task save the sort that one open file would need.
    """
    per_task = min(max(SMALLEST, -(-input_bytes // TASKS)), LARGEST)
    partitions = max(cores, -(-input_bytes // per_task))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_task),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(per_task),
        "spark.sql.maxConcurrentOutputFileWriters": "2",
    }
