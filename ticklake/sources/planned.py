"""Files that a plan names, read inside tasks: a data source for batches and streams.

A plan is a folder of Parquet with a column ``file_path``. The driver only sees the names of the plan's own parts, which
hold a bounded number of rows each (``write_plan``); every part is one partition, whose task reads the part's rows and
then the files they name. Nothing is listed a second time, and a name is taken as it stands: blanks, percent
signs, brackets and letters of any script need no escaping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLAN_ROWS = 2000  # files per task
SCHEMA = "file_path string, value string, missing boolean"
FORMAT = "planned_files"


def write_plan(chosen: DataFrame, folder: str) -> None:
    """Write rows with a ``file_path`` as a plan, replacing what the folder holds."""
    chosen.write.option("maxRecordsPerFile", PLAN_ROWS).mode("overwrite").parquet(folder)


def register(spark: SparkSession) -> None:
    """Make the format known to the session. Its class travels by value, so workers need no package."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

    def store(name: str):
        """File system and its own spelling of a path: nothing is decoded, as names aren't encoded."""
        from pyarrow import fs

        scheme, colon, rest = name.partition(":")
        if not colon or "/" in scheme:
            return fs.LocalFileSystem(), name
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        authority, _, path = rest.removeprefix("//").partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        if scheme == "s3":
            return fs.S3FileSystem(), f"{authority}/{path}"
        return fs.FileSystem.from_uri(f"{scheme}://{authority}/")[0], "/" + path

    def children(folder: str) -> list[tuple[str, str]]:
        """(name, path) of what lies in a folder; nothing if it isn't there."""
        from pyarrow import fs

        files, path = store(folder)
        found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted((f.base_name, f"{folder.rstrip('/')}/{f.base_name}") for f in found)

    def parts(folder: str) -> list[InputPartition]:
        return [InputPartition(path) for name, path in children(folder) if name.endswith(".parquet")]

    def contents(name: str, lines: bool):
        import io

        files, path = store(name)
        with files.open_input_stream(path) as stream:
            if not lines:
                yield stream.read().decode(errors="replace")
                return
            for line in io.TextIOWrapper(stream, "utf-8", errors="replace", newline="\n"):
                if line.strip():
                    yield line.rstrip("\r\n")

    def read(part: InputPartition, lines: bool):
        import pyarrow as pa
        import pyarrow.parquet as pq

        files, path = store(part.value)
        rows: list[tuple] = []
        held = 0

        def batch():
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.bool_()), strict=True)], ["file_path", "value", "missing"])

        with files.open_input_file(path) as plan:
            for names in pq.ParquetFile(plan).iter_batches(columns=["file_path"]):
                for name in names.column(0).to_pylist():
                    try:
                        for value in contents(name, lines):
                            rows.append((name, value, False))
                            held += len(value)
                            if held > 8_000_000 or len(rows) >= 10_000:
                                yield batch()
                                rows, held = [], 0
                    except FileNotFoundError:
                        rows.append((name, None, True))
        if rows:
            yield batch()

    class Batch(DataSourceReader):
        def __init__(self, options):
            self.folder, self.lines = options["path"], options.get("lines", "false") == "true"

        def partitions(self):
            return parts(self.folder)

        def read(self, partition):
            if partition is not None and partition.value is not None:
                yield from read(partition, self.lines)

    class Stream(DataSourceStreamReader):
        """Numbered plans ``plan=<n>``: an offset is the last number taken, and a plan counts once it is complete."""

        def __init__(self, options):
            self.folder, self.lines = options["path"], options.get("lines", "false") == "true"

        def plans(self) -> list[int]:
            numbers = [int(n.removeprefix("plan=")) for n, _ in children(self.folder) if n.startswith("plan=")]
            return sorted(n for n in numbers if any(name == "_SUCCESS" for name, _ in children(f"{self.folder}/plan={n}")))

        def initialOffset(self):
            return {"plan": -1}

        def latestOffset(self):
            return {"plan": max(self.plans(), default=-1)}

        def partitions(self, start, end):
            taken = [n for n in self.plans() if start["plan"] < n <= end["plan"]]
            return [part for n in taken for part in parts(f"{self.folder}/plan={n}")]

        def read(self, partition):
            yield from read(partition, self.lines)

        def commit(self, end):
            pass

    class PlannedFiles(DataSource):
        @classmethod
        def name(cls):
            return "planned_files"

        def schema(self):
            return "file_path string, value string, missing boolean"

        def reader(self, schema):
            return Batch(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    spark.dataSource.register(PlannedFiles)


def read_plan(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """(file_path, value, missing): the text of each file, or of each of its lines; a file that is gone is one row."""
    register(spark)
    return spark.read.format(FORMAT).option("lines", lines).load(folder)


def stream_plans(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """The same of the plans ``plan=<n>`` in a folder, each number taken once, in order, as they are completed."""
    register(spark)
    return spark.readStream.format(FORMAT).option("lines", lines).load(folder)
