"""The streamed lookback against the batch one, load by load."""

import random

import pytest
from ticklake.operators import backlog
from ticklake.streaming.lookback import PROVIDER, lookback_stream, state_store

from .conftest import rows

HOUR = 3_600_000
SCHEMA = "exchange_id string, extraction_timestamp long, snapshot_path string"


def frame(spark, values):
    return spark.createDataFrame([(v, t, f"{v}_{t}") for v, t in values], SCHEMA)


@pytest.mark.parametrize("given", [False, True])
def test_streamed_equals_batch_load_by_load(spark, tmp_path, given):
    """Venues move at different speeds; late ones lie below, in and above their own windows."""
    rng = random.Random(2)
    start = {"fast": 900, "slow": 100, "late": 500}
    loaded = [("fast", 890 * HOUR), ("fast", 888 * HOUR), ("gone", HOUR)] if given else []
    known = frame(spark, loaded).select("exchange_id", "extraction_timestamp")
    taken: list[tuple] = []
    before = spark.conf.get(PROVIDER, None)
    for n in range(4):
        new = [(v, (at + 5 * n + rng.randrange(-14, 5)) * HOUR + rng.randrange(3)) for v, at in start.items() for _ in range(8 if n < 3 or v != "slow" else 0)]
        new += [(None, 7 * HOUR + n), ("fast", None)]
        frame(spark, new).write.mode("append").parquet(str(tmp_path / "landed"))
        fresh = spark.createDataFrame(loaded, "exchange_id string, extraction_timestamp long")
        # Rows not taken by an earlier load lie below their floor for good, so the new ones decide.
        want = backlog.backlog_lookback(frame(spark, new), backlog.loaded_timestamps(fresh))
        want_rows = rows(want)
        stream = lookback_stream(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "landed")), known if given else None)
        writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
        with state_store(spark):
            writer.trigger(availableNow=True).start().awaitTermination()
        taken += want_rows
        got = rows(spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")))
        assert sorted(got, key=str) == sorted(taken, key=str), n
        loaded += [(v, t) for v, t, _ in want_rows if v is not None]
    assert spark.conf.get(PROVIDER, None) == before
