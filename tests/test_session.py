"""Session helpers: shared checkpoint folder and cluster sizing."""

from types import SimpleNamespace

import pytest

from blotter.session import RECOMMENDED_CONF, cluster_settings, shared_folder, shared_root


def session(named, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_in_the_folder_that_the_session_names(spark):
    one, two = (shared_folder(spark, "t") for _ in range(2))
    assert one != two and one.startswith(f"{shared_root(spark)}/t-")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_root(spark) == (named.rstrip("/") if named else shared_root(spark))
    assert shared_root(session("hdfs://x/y/", "spark://h:1")) == "hdfs://x/y"
    assert shared_root(session(None, "local[4]")) == shared_root(session(None, "local"))  # a scratch folder, once
    for master in ("spark://h:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session(None, master))


def test_cluster_settings_follow_cores_and_shuffled_bytes():
    small = cluster_settings(10 << 30, cores=40)
    big = cluster_settings(100 << 40, cores=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two per core
    # 100 TB: 2 TB of counts at 1 GB a reducer, not a reducer per input split.
    assert int(big["spark.sql.shuffle.partitions"]) == 2048
    assert int(cluster_settings(100 << 40, cores=4000)["spark.sql.shuffle.partitions"]) == 8000
    more = cluster_settings(100 << 40, cores=1000, shuffle_bytes=50 << 40)
    assert int(more["spark.sql.shuffle.partitions"]) == 51_200  # no cap
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.codegen.hugeMethodLimit"] == RECOMMENDED_CONF["spark.sql.codegen.hugeMethodLimit"]
    assert "spark.ui.enabled" not in big
    assert "spark.sql.sources.partitionOverwriteMode" not in big
