"""Stream queries over a folder of part files, several micro-batches each, against their SQL."""

import os
from pathlib import Path

import pytest

from lakeweave.catalog import CATALOG, streams

from .oracle import TABLES, connect, differences

ROOT = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not ROOT.exists(), reason="test tables are not mounted")
NAMES = ["stream_route", "stream_surge", "stream_trail_state", "stream_running_state", "stream_dedup", "stream_latest_table",
         "stream_filtered", "incremental_ingest", "stream_validate", "stream_minute_stats", "stream_tumbling", "stream_hopping",
         "stream_sessions", "stream_hourly_landing", "stream_message_upsert", "stream_silence_alarms", "stream_sketched_quantiles"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        if name not in ("events", "orders"):
            (root / f"{name}.parquet").symlink_to(ROOT / f"{name}.parquet")
    (root / "orders.parquet").symlink_to(ROOT / "orders.parquet")
    events = spark.read.parquet(str(ROOT / "events.parquet"))
    events.repartitionByRange(3, "ts").write.parquet(str(root / "events.parquet"))
    for i, part in enumerate(sorted((root / "events.parquet").glob("part-*"))):  # read in the order of their time
        os.utime(part, (1_700_000_000 + i * 60,) * 2)
    return root


@pytest.mark.parametrize("name", NAMES)
def test_several_batches_equal_the_sql(spark, folder, name, monkeypatch):
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 1)
    con = connect(ROOT)
    problem, count, _ = differences(spark, con, str(folder), CATALOG[name])
    assert problem is None and count > 0
