"""Sinks: catalog tables by contract, the partitioned ticker table, node tables, SQL databases."""

from __future__ import annotations

import re
import uuid
from contextlib import suppress
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import STRING, TICKER, Contract, property_type
from ticklake.functions.times import DAY_MS, utc_date
from ticklake.operators.backlog import LOOKBACK_MS
from ticklake.operators.flatten import conform
from ticklake.operators.loaded_index import LoadedIndex
from ticklake.operators.reduce import first_by
from ticklake.session import drop, escaped, existing, folders, read_text, stored, write_new
from ticklake.sources.tables import jdbc_options


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """All declared columns, nullable, whatever the first batch brings."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{at}")


def append_by_name(
    df: DataFrame,
    name: str,
    contract: Contract | None = None,
    *,
    on_missing: str = "create",
    on_empty: str = "create",
    location: str | None = None,
) -> None:
    """Append to a catalog table by column name: extras dropped, absent columns NULL.

    ``on_missing="error"`` refuses a table that is not there; otherwise it is created from the
    contract, or from the frame if there is none. ``on_empty="skip"`` creates nothing for an empty
    frame; an existing table needs no such check, appending no rows changes nothing.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        if on_empty == "skip" and df.isEmpty():
            return
        if on_missing == "error":
            raise ValueError(f"Table {name} does not exist")
        if "." in name:
            create_namespace(spark, name.rsplit(".", 1)[0])
        create_table(spark, name, contract.struct if contract else df.schema, location)
    conform(df, spark.table(name).schema).write.insertInto(name)


def append_jdbc(
    df: DataFrame, url: str, table: str, *, contract: Contract | None = None, writers: int = 8, **extra: object
) -> None:
    """Append to a table of a SQL database with at most ``writers`` connections."""
    rows = conform(df, contract.struct) if contract else df
    options = jdbc_options(url, table, numPartitions=writers, batchsize=10_000, **extra)
    rows.write.format("jdbc").options(**options).mode("append").save()


class TickerTable:
    """The ticker contract as partitioned parquet: venue, date, and the load that wrote it.

    A load that runs again replaces its own partitions, so a retry never doubles rows. With ``indexed`` every load
    also notes its instants in a bitmap index, which answers full-history questions without the table.

    Closed days may be compacted: their loads are copied into one generation of few files, which counts once
    a numbered pointer file names its entries. Entries say which load of which day is read from
    which generation; the loads' own folders are hidden from then on and dropped later (``vacuum``). A crash before the
    pointer changes nothing, one after it leaves hidden folders. A compacted load that runs again is written to its own
    folders as ever, and the next pointer makes them count instead of the generation's rows of that load.
    One writer at a time compacts, drops, or repeats compacted loads; of two, the second fails at the pointer, whose
    number is taken, and changes nothing.
    """

    LAYOUT = ("exchange_id", "date", "load_id")
    _ENTRY = "exchange_id string, date date, load_id string, generation string, kept boolean"

    def __init__(self, spark: SparkSession, path: str, indexed: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.indexed = indexed
        self.index = LoadedIndex(spark, f"{self.path}/_loaded")
        self.compacted_root = f"{self.path}/_compacted"

    @property
    def stored(self) -> T.StructType:
        extra = [T.StructField("date", T.DateType()), T.StructField("load_id", STRING)]
        return T.StructType([*TICKER.struct.fields, *extra])

    def append(self, rows: DataFrame, load_id: str) -> None:
        """Rebalancing merges small partitions and splits hot ones, so neither many tiny files nor
        one huge writer result; symbols are clustered inside the files for row-group skipping."""
        layout = [F.col(c) for c in self.LAYOUT]
        (
            conform(rows, TICKER.struct)
            .withColumn("date", utc_date(F.col("extraction_timestamp")))
            .withColumn("load_id", F.lit(load_id))
            .hint("rebalance", *layout)
            .sortWithinPartitions(*layout, "symbol")
            .write.partitionBy(*self.LAYOUT)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(self.path)
        )
        if name := self._pointer():
            again = (F.col("load_id") == load_id) & F.col("kept")
            n, entries = self._next(), self._entries(name)
            if not entries.filter(again).isEmpty():
                self._switch(n, entries.withColumn("kept", F.col("kept") & (F.col("load_id") != load_id)))
        if self.indexed:
            own = [f"{self.path}/exchange_id=*/date=*/load_id={load_id}"]
            self.index.add(self._live(own), load_id)

    def loaded_index(self) -> DataFrame:
        """The merged bitmap index; a table that was written without one gets it now."""
        if not self.index.exists():
            self.index.rebuild(self._all([self.path], [self.compacted_root]))
        return self.index.read()

    def _live(self, names: list[str]) -> DataFrame:
        there, _ = existing(self.spark, names)
        read = self.spark.read.schema(self.stored).option("basePath", self.path)
        return read.parquet(*there) if there else self.spark.createDataFrame([], self.stored)

    def _pointers(self) -> list[int]:
        return sorted(int(n.rsplit("/", 1)[1]) for n in folders(self.spark, f"{self.path}/_pointer/*"))

    def _pointer(self) -> str | None:
        """Name of the entries that count; None before the first compaction.

        A pointer without a name belongs to a writer that is not done, or was lost: the one before it counts.
        """
        for n in reversed(self._pointers()):
            if name := read_text(self.spark, f"{self.path}/_pointer/{n}"):
                return name
        return None

    def _entries(self, name: str | None) -> DataFrame:
        if name is None:
            return self.spark.createDataFrame([], self._ENTRY)
        return self.spark.read.schema(self._ENTRY).parquet(f"{self.path}/_entries/{name}")

    def _switch(self, n: int, entries: DataFrame) -> None:
        """Write entries, and then pointer n, which makes them count; that another writer was quicker is an error."""
        name = f"{n:08d}-{uuid.uuid4().hex[:8]}"
        entries.write.parquet(f"{self.path}/_entries/{name}")
        write_new(self.spark, f"{self.path}/_pointer/{n}", name)

    def _next(self) -> int:
        return max(self._pointers(), default=-1) + 1

    def _all(self, live: list[str], compacted: list[str]) -> DataFrame:
        """Rows of these folders as the pointer resolves them."""
        name = self._pointer()
        rows = self._live(live)
        if name is None:
            return rows
        kept = self._entries(name).filter("kept")
        rows = rows.join(kept.select(*self.LAYOUT), list(self.LAYOUT), "left_anti")
        there, _ = existing(self.spark, compacted)
        if not there:
            return rows
        schema = T.StructType([*self.stored.fields, T.StructField("generation", STRING)])
        old = self.spark.read.schema(schema).option("basePath", self.compacted_root).parquet(*there)
        key = F.struct(*self.LAYOUT, "generation").alias("entry")
        counts = old.select("*", key).join(kept.select(key), "entry", "left_semi")
        return rows.unionByName(counts.select(*rows.columns))

    def read(self) -> DataFrame:
        """Contract columns plus ``date`` for pruning; an absent table is empty."""
        return self._all([self.path], [self.compacted_root]).select(*TICKER.columns, "date")

    def recent(self, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
        """Rows of the days that a lookback from each venue's newest instant can touch.

        The newest day of each venue is known from the folders' names, so older days are neither listed nor
        read: the newest instant lies in it, and the window starts at most ``lookback_ms`` before it.
        """
        days: dict[str, dict[date, list[str]]] = {}
        for pattern in (f"{self.path}/exchange_id=*/date=*", f"{self.compacted_root}/generation=*/exchange_id=*/date=*"):
            for name in folders(self.spark, pattern):
                venue, day = name.rsplit("/", 2)[1:]
                with suppress(ValueError):  # rows without an instant have no day
                    days.setdefault(venue, {}).setdefault(date.fromisoformat(day.removeprefix("date=")), []).append(name)
        back = timedelta(days=-(-lookback_ms // DAY_MS))
        names = [name for own in days.values() for day, found in own.items() if day >= max(own) - back for name in found]
        compacted = [name for name in names if "/_compacted/generation=" in name]
        return self._all([name for name in names if name not in compacted], compacted).select(*TICKER.columns, "date")

    def compact(self, before: date) -> str | None:
        """Copy days before ``before`` that several loads wrote, or that got more since, into one generation.

        Returns the generation's name, None if there is nothing to do. Rows are the same before, during and after;
        nothing is deleted.
        """
        n, entries = self._next(), self._entries(self._pointer())
        hidden = entries.filter("kept").select(*self.LAYOUT)
        live = self._live([self.path]).filter(F.col("date") < before)
        fresh = live.select(*self.LAYOUT).distinct().join(hidden, list(self.LAYOUT), "left_anti")
        day = ["exchange_id", "date"]
        done = entries.filter("kept").select(*day).distinct().select(*day, F.lit(0).alias("new"), F.lit(1).alias("old"))
        loads = fresh.select(*day, F.lit(1).alias("new"), F.lit(0).alias("old")).unionByName(done)
        # A day of one load stays as it is; one that was compacted before is copied if a load came since.
        several = loads.groupBy(*day).agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
        days = stored(several.filter("new > 0 AND new + old > 1").select(*day), "days")
        # One name per venue and day closed since the last time: only those are read.
        names = [f"exchange_id={escaped(self.spark, r.exchange_id)}/date={r.date}" for r in days.toLocalIterator()]
        if not names:
            return None
        generation = f"{n:08d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.compacted_root}/generation={generation}"
        rows = self._all([f"{self.path}/{d}" for d in names], [f"{self.compacted_root}/generation=*/{d}" for d in names])
        place = [F.col("exchange_id"), F.col("date")]
        (
            rows.select(*self.stored.fieldNames())
            .hint("rebalance", *place)
            .sortWithinPartitions(*place, "symbol")
            .write.partitionBy("exchange_id", "date")
            .parquet(folder)
        )
        copied = self.spark.read.schema(self.stored).parquet(folder).select(*self.LAYOUT).distinct()
        new = copied.select(*self.LAYOUT, F.lit(generation).alias("generation"), F.lit(True).alias("kept"))
        others = entries.join(days, day, "left_anti").select(*new.columns)
        self._switch(n, others.unionByName(new))
        return generation

    def vacuum(self) -> int:
        """Drop what no reader of the present pointer uses: hidden folders, old generations and entries. Their number.

        Call it when readers that began before the last pointer are done.
        """
        present = self._pointer()
        if present is None:
            return 0
        kept = self._entries(present).filter("kept")
        used = {r.generation for r in kept.select("generation").distinct().toLocalIterator()}
        names = [f"{self.path}/exchange_id={escaped(self.spark, r.exchange_id)}/date={r.date}/load_id={r.load_id}" for r in kept.toLocalIterator()]
        for pattern, keep in ((f"{self.compacted_root}/generation=*", used), (f"{self.path}/_entries/*", {present})):
            names += [f for f in folders(self.spark, pattern) if re.split("[/=]", f)[-1] not in keep]
        return sum(drop(self.spark, name) for name in names)


def node_properties(df: DataFrame) -> DataFrame:
    """Cast every column to the type a node property may have."""
    return conform(df, T.StructType([T.StructField(f.name, property_type(f.dataType)) for f in df.schema]))


def replace_node_table(df: DataFrame, label: str, order: list[str], location: str | None = None) -> None:
    """Replace the node table: first column is the key, of equal keys the first by ``order`` stays.

    A row without a key makes the write fail, and the table stays as it was.
    """
    key = df.columns[0]
    refused = F.raise_error(F.lit(f"Node table {label}: NULL in its key {key}")).cast(df.schema[key].dataType)
    nodes = first_by(df, [key], order).withColumn(key, F.coalesce(F.col(key), refused))
    writer = node_properties(nodes).write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(label)
