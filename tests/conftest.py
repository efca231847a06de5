import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def event_log(tmp_path_factory):
    return str(tmp_path_factory.mktemp("events"))


@pytest.fixture(scope="session")
def spark(event_log):
    from blotter.session import local_session
    s = local_session("*", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{event_log}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    yield s
    s.stop()


@pytest.fixture
def rows_read(spark, event_log):
    """Call it before and after a query: rows that tasks have read from files so far, from the event log."""
    import json

    def total() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        read = 0
        for name in os.listdir(event_log):
            with open(os.path.join(event_log, name)) as f:
                for line in f:
                    if line.startswith('{"Event":"SparkListenerTaskEnd"'):
                        metrics = json.loads(line).get("Task Metrics") or {}
                        read += metrics.get("Input Metrics", {}).get("Records Read", 0)
        return read
    return total
