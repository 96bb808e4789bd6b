"""Each venue's lookback as a stream: landed snapshots come in, those to load come out.

A micro-batch is a load. A landing is chosen by what its venue had loaded before the batch: its instant must not be loaded and
must lie above the oldest loaded instant of the window that ends with the venue's newest one. So a slow or late
venue has its own cut, which one watermark for all venues can't give. The state of a venue is the instants of its window,
at one snapshot a minute 360 numbers; landings are one row a snapshot, not one a symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.backlog import KEY, LOOKBACK_MS, recent_loaded, stamped
from ticklake.session import stored

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which such state needs; the session's setting stays as it was."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _processor(lookback_ms: int, columns: list[str]):
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Lookback(StatefulProcessor):
        """One venue. Travels by value, so workers need no package."""

        def init(self, handle):
            self.recent = handle.getListState("recent", "instant long")

        def _keep(self, instants: set[int], newest: int) -> None:
            window = sorted(t for t in instants if t > newest - lookback_ms)
            self.recent.put([(t,) for t in window])

        def handleInitialState(self, key, initialState, timerValues):
            known = set(initialState.recent or [])
            if known:
                self._keep(known, max(known))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            loaded = {r[0] for r in self.recent.get()} if self.recent.exists() else set()
            floor = min(loaded, default=None)
            newest, now = max(loaded, default=None), set(loaded)
            for row in rows:
                instant = row.extraction_timestamp
                if floor is not None and (instant <= floor or instant in loaded):
                    continue
                yield Row(**{c: row[c] for c in columns})
                newest = instant if newest is None else max(newest, instant)
                if instant > newest - lookback_ms:
                    now.add(instant)
                if len(now) > 2 * len(loaded) + 10_000:  # a long history: only its last window is of use
                    now = {t for t in now if t > newest - lookback_ms}
            if newest is not None:
                self._keep(now, newest)

        def close(self):
            pass

    return Lookback()


def lookback_stream(landings: DataFrame, loaded: DataFrame | None = None, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """Those of a stream of manifest rows that each micro-batch, as a load, has to take.

    ``loaded``: (exchange_id, extraction_timestamp) pairs that are in the table before the stream begins. As with
    ``backlog_lookback`` a venue that has nothing yet gets everything, rows without an instant are left out, and rows without a
    venue are always taken. Start the query inside ``state_store``.
    """
    rows = stamped(landings)
    known = rows.filter(F.col("exchange_id").isNotNull())
    begin = None
    if loaded is not None:
        window = recent_loaded(loaded.select(*KEY).distinct(), lookback_ms)
        # One row per venue, bounded by the instants of one lookback; written, so that every restart has the same plan.
        begin = stored(window.groupBy("exchange_id").agg(F.collect_list("extraction_timestamp").alias("recent")), "windows").groupBy("exchange_id")
    chosen = known.groupBy("exchange_id").transformWithState(
        _processor(lookback_ms, landings.columns), landings.schema, "append", "none", begin
    )
    return chosen.unionByName(rows.filter(F.col("exchange_id").isNull()))
