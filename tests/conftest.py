from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s
    s.stop()


def cpu(cid, user=0, nice=0, system=0, idle=0, iowait=0, irq=0, softirq=0, steal=0, guest=0, guest_nice=0):
    return (cid, user, nice, system, idle, iowait, irq, softirq, steal, guest, guest_nice)


def snapshot_df(spark, rows):
    """rows: (hostname, timestamp, [cpu tuples], src_offset)."""
    from statflow.schemas import SNAPSHOT_ROW

    full = [
        (h, ts, cpus, [], [], 0, 0, 0, 0, 0, 0, off)
        for h, ts, cpus, off in rows
    ]
    return spark.createDataFrame(full, SNAPSHOT_ROW)
