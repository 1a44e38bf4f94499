"""Lake tables whose readers follow a manifest: a run appears whole or not at all.

Every run writes what it makes into a folder of its own. Last of all it writes one manifest, which lists for
every table the folders that hold it now: those of this run and, for what the run left
alone, those of earlier ones. Readers take the newest whole manifest, so a run that breaks at any point
leaves the previous state, and its folder is just never named. A manifest is a small table written
by Spark's commit protocol; one without its success mark is ignored, and its number is not
used again. Of two runs that end at once the second fails instead of undoing the first.

A table may be dealt over buckets of a hashed key. Then a run can replace only the buckets
that hold changed rows; the manifest lists folders bucket by bucket.
"""

from __future__ import annotations

import re
import uuid
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .storage import by_folder

MANIFEST = "number long, table_name string, bucket int, path string"
BUCKETS = 64
BUCKET = "_bucket"
WHOLE = -1
"""The bucket of a table that is not dealt."""


def bucket_of(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


class Lake:
    """The tables below a root folder, as the newest manifest has them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def numbers(self, whole: bool = True) -> list[int]:
        """The numbers of the manifests, also of broken ones if asked."""
        context = self.spark.sparkContext
        pattern = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/number=*{'/_SUCCESS' if whole else ''}")
        found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(int(re.search(r"number=(\d+)", f.getPath().toString())[1]) for f in found or ())

    def entries(self) -> list[tuple[str, int, str]]:
        """(table, bucket, path) of the newest manifest."""
        numbers = self.numbers()
        if not numbers:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/number={numbers[-1]:012d}").collect()
        return [(r["table_name"], r["bucket"], r["path"]) for r in rows]

    def read(self, name: str, schema: T.StructType, buckets: set[int] | None = None) -> DataFrame:
        """A table, empty before its first run, or only some of its buckets."""
        return self._frame([p for t, b, p in self.entries() if t == name and (buckets is None or b in buckets)], schema)

    def _frame(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        frame = None
        # Folders of one run share a base, which tells the columns that are folder names.
        for base in sorted({p.split("#")[0] for p in paths}):
            own = [p.replace("#", "/").rstrip("/") for p in paths if p.split("#")[0] == base]
            part = self.spark.read.schema(schema).option("basePath", base).parquet(*own).select(*schema.fieldNames())
            frame = part if frame is None else frame.unionByName(part)
        return frame

    def begin(self) -> Run:
        return Run(self)


class Run:
    """What a run is about to publish; nothing is seen before ``commit``."""

    def __init__(self, lake: Lake) -> None:
        self.lake, self.start = lake, max(lake.numbers(whole=False), default=0)
        self.seen = max(lake.numbers(), default=0)
        self.folder = f"{lake.root}/runs/{self.start + 1:012d}-{uuid.uuid4().hex[:8]}"
        self.tables = lake.entries()
        # Tables may be written side by side.
        self.lock = Lock()

    def holds(self, name: str) -> bool:
        return any(t == name for t, _, _ in self.tables)

    def read(self, name: str, schema: T.StructType, buckets: set[int] | None = None) -> DataFrame:
        """A table as this run will leave it."""
        paths = [p for t, b, p in self.tables if t == name and (buckets is None or b in buckets)]
        return self.lake._frame(paths, schema)

    def _written(self, name: str, rows: DataFrame, by: list[str]) -> str:
        place = f"{self.folder}/{name}"
        if by:
            by_folder(rows, by).write.partitionBy(*by).parquet(place)
        else:
            rows.write.parquet(place)
        return place

    def replace(self, name: str, rows: DataFrame, by: list[str] | None = None) -> None:
        """``rows`` are the table from now on; ``by`` gives the columns with a folder per value."""
        place = self._written(name, rows, by or [])
        with self.lock:
            self.tables = [e for e in self.tables if e[0] != name] + [(name, WHOLE, place)]

    def append(self, name: str, rows: DataFrame) -> None:
        place = self._written(name, rows, [])
        with self.lock:
            self.tables = [*self.tables, (name, WHOLE, place)]

    def put(self, name: str, rows: DataFrame, key: list[str], instead: bool) -> None:
        """Adds rows to a table dealt over buckets of ``key``, or puts them in place of the buckets they fall into."""
        dealt = rows.withColumn(BUCKET, bucket_of(key))
        place = self._written(name, dealt, [BUCKET])
        # At most BUCKETS values, known from the names of the folders.
        written = self.lake.spark.read.schema(dealt.schema).parquet(place)
        own = sorted(r[0] for r in written.select(BUCKET).distinct().collect())
        with self.lock:
            kept = [e for e in self.tables if not (instead and e[0] == name and e[1] in own)]
            self.tables = kept + [(name, b, f"{place}#{BUCKET}={b}") for b in own]

    def drop(self, name: str, buckets: set[int]) -> None:
        """The table no longer holds these buckets."""
        with self.lock:
            self.tables = [e for e in self.tables if not (e[0] == name and e[1] in buckets)]

    def commit(self) -> None:
        """Publishes the run, unless another one has been published since it began."""
        numbers = self.lake.numbers()
        if max(numbers, default=0) != self.seen:
            raise RuntimeError("another run has been published since this one began")
        number = max(self.lake.numbers(whole=False), default=0) + 1
        rows = self.lake.spark.createDataFrame([(number, *e) for e in self.tables], MANIFEST)
        rows.coalesce(1).write.mode("error").parquet(f"{self.lake.root}/manifests/number={number:012d}")
