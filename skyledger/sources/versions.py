"""Derived tables in versions: data in folders of their own, and one small manifest put in place last.

    TABLE/data/v=ID/event_date=DAY/*.parquet     written once, never changed
    TABLE/manifests/000000000007.json            which version holds each day, and the columns

A reader takes the newest manifest once and reads exactly the folders it names, so it sees one state of
the table, however many writers come after. A writer that stops at any step leaves files that no manifest
names: the table stays as it was. A new manifest takes over the days it does not replace, so replacing
some days writes and lists nothing of the others. ``expire`` deletes what no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "event_date"
#: Folder of the rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Store:
    """The folder of one table, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._place(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        place = self._place(f"{self.path}/{folder}")
        if not self._files.exists(place):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(place)]

    def text(self, name: str) -> str:
        stream = self._files.open(self._place(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a whole file under a new name, or nothing: False where the name is taken."""
        last = self._place(f"{self.path}/{name}")
        draft = self._place(f"{self.path}/drafts/{uuid.uuid4().hex}")
        stream = self._files.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._files.mkdirs(last.getParent())
        done = not self._files.exists(last) and self._files.rename(draft, last)
        if not done:
            self._files.delete(draft, False)
        return done

    def delete(self, name: str) -> None:
        self._files.delete(self._place(f"{self.path}/{name}"), True)

    def manifest(self) -> tuple[int, dict | None]:
        """Number and content of the newest manifest; 0 and None where there is no table yet."""
        numbers = [int(n[:-5]) for n in self.names("manifests") if n.endswith(".json")]
        if not numbers:
            return 0, None
        return max(numbers), json.loads(self.text(f"manifests/{max(numbers):012d}.json"))


def _between(day: str, since: date | None, until: date | None) -> bool:
    if since is None and until is None:
        return True
    return day != NO_DAY and (since is None or day >= str(since)) and (until is None or day < str(until))


def table_exists(spark: SparkSession, path: str) -> bool:
    return Store(spark, path).manifest()[1] is not None


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """The days that the newest version holds, in order (from its manifest, nothing is listed)."""
    _, found = Store(spark, path).manifest()
    return sorted(d for d in (found or {"days": {}})["days"] if d != NO_DAY)


def read_table(
    spark: SparkSession, path: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The newest version, or its days from ``since`` up to and without ``until``: other folders are not
    even listed. The frame keeps to this version when a later one is published."""
    store = Store(spark, path)
    _, found = store.manifest()
    if found is None:
        raise FileNotFoundError(f"no version of {path} has been published")
    schema = T.StructType.fromJson(found["schema"])
    folders = [
        f"{store.path}/data/v={version}/{DAY}={day}" for day, version in sorted(found["days"].items())
        if _between(day, since, until)
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("v", T.StringType()), T.StructField(DAY, T.DateType())])
    return spark.read.schema(stored).option("basePath", f"{store.path}/data").parquet(*folders).drop("v", DAY)


def publish(
    df: DataFrame,
    path: str,
    day: str = "date",
    since: date | None = None,
    until: date | None = None,
    tries: int = 5,
) -> int:
    """Make ``df`` the table's newest version, and return its number; ``df`` may read an earlier one.

    With ``since`` or ``until`` only those days are replaced; ``df`` must then hold no others, and a day
    it has no rows for becomes empty. Where another writer publishes at the same time, this one takes
    over the other's days and tries again.
    """
    store = Store(df.sparkSession, path)
    version = uuid.uuid4().hex
    rows = df.withColumn(DAY, F.to_date(day)).hint("rebalance", DAY).sortWithinPartitions(DAY)
    rows.write.partitionBy(DAY).parquet(f"{store.path}/data/v={version}")
    written = [n.split("=", 1)[1] for n in store.names(f"data/v={version}") if n.startswith(f"{DAY}=")]
    beyond = [d for d in written if not _between(d, since, until)]
    if beyond:
        raise ValueError(f"rows of {beyond[0]} are outside the days to replace")
    # What is stored may be NULL, whatever the plan at hand promises.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).jsonValue()
    for _ in range(tries):
        number, found = store.manifest()
        kept = {} if found is None else {d: v for d, v in found["days"].items() if not _between(d, since, until)}
        if kept and found["schema"] != schema:
            raise ValueError(f"the columns differ from those of the days of {path} that stay")
        content = {"days": kept | {d: version for d in written}, "schema": schema}
        if store.put(f"manifests/{number + 1:012d}.json", json.dumps(content)):
            return number + 1
    raise OSError(f"other writers of {path} were always first")


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` manifests, and the data that they do not name. Run it when no
    writer is at work; readers of a deleted version fail."""
    store = Store(spark, path)
    manifests = sorted(n for n in store.names("manifests") if n.endswith(".json"))
    kept = [json.loads(store.text(f"manifests/{n}")) for n in manifests[-keep:]]
    for name in manifests[:-keep]:
        store.delete(f"manifests/{name}")
    used = {(v, d) for m in kept for d, v in m["days"].items()}
    for folder in store.names("data"):
        version = folder.split("=", 1)[1]
        days = [n for n in store.names(f"data/{folder}") if n.startswith(f"{DAY}=")]
        gone = [d for d in days if (version, d.split("=", 1)[1]) not in used]
        if len(gone) == len(days):
            store.delete(f"data/{folder}")
        else:
            for d in gone:
                store.delete(f"data/{folder}/{d}")
    store.delete("drafts")
