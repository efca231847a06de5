"""Session helpers: local sessions for tests/bench, and the folder that a cluster shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: list[str] = []

#: Settings the library relies on. AQE coalesces shuffle partitions and splits
#: skewed ones at run time; ANSI stays on (parsing uses ``try_*`` functions).
#: ``hugeMethodLimit=8000`` is HotSpot's own JIT limit: a whole-stage method
#: above it would run interpreted, so Spark splits that stage instead (wide
#: CASE ladders over derived columns otherwise run ~5x slower).
RECOMMENDED_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", *, shuffle_partitions: int = 8, app: str = "blotter",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench (no UI, no ports beyond Spark's own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 "spark.driver.memory": "8g", **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("BLOTTER_LOG_LEVEL", "ERROR"))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a purely local session (tests) that does not name one gets a scratch
    folder; a cluster without the setting is refused, because its machines
    would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append("file://" + tempfile.mkdtemp(prefix="blotter-shared-"))
    return _LOCAL_ROOT[0]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; every call gives another one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cluster_settings(input_bytes: int, *, cores: int, shuffle_bytes: int | None = None,
                     split_bytes: int = 256 << 20, reducer_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for a large cluster run.

    Scan splits follow the input. Shuffle partitions follow what is shuffled:
    ``shuffle_bytes`` defaults to a fiftieth of the input, a generous bound for
    counts that were combined before the shuffle. They are never fewer than
    two per core, and adaptive execution coalesces small ones and splits large
    ones (also those of the rebalanced clean write, the only full shuffle), so
    a few thousand serve 100 TB without a map status per split and reducer
    that the driver could not hold.
    """
    shuffled = input_bytes // 50 if shuffle_bytes is None else shuffle_bytes
    partitions = str(max(2 * cores, -(-shuffled // reducer_bytes)))
    return {
        **{k: v for k, v in RECOMMENDED_CONF.items() if not k.startswith("spark.ui.")},
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
