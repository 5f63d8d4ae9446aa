"""A table of days whose versions are published whole.

``<path>/data/batch=<id>/day=<day>/``   rows; never changed once written
``<path>/versions/<number>.json``       manifest: the batch that holds each day

A writer adds a batch folder with the days it replaces and then publishes a
manifest by one rename without overwriting.  Readers take the newest manifest, or pin
an older one, so they see a version whole or not at all, whatever happens to
the writer.  A manifest has one entry per calendar day (some tens of thousands for
a century), which is all that passes through the driver."""
from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

#: Spark's folder name of a null partition value.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class VersionConflict(Exception):
    """Another writer published the version that this one built on."""


class DayTable:
    """``DayTable(spark, path, schema)``: rows of ``schema`` by the day in ``day_col``.

    The columns ``day`` and ``batch`` name the folders and are not part of the schema."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day_col: str = "datetime"):
        self.spark, self.path, self.schema, self.day_col = spark, path.rstrip("/"), schema, day_col

    # versions -----------------------------------------------------------

    def versions(self) -> list[int]:
        """The published versions that are still kept, oldest first."""
        names = files.names(self.spark, f"{self.path}/versions")
        return [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]

    def version(self) -> int:
        """The newest version; 0 where nothing has been published."""
        return max(self.versions(), default=0)

    def _manifest(self, version: int) -> dict[str, str]:
        if version == 0:
            return {}
        return json.loads(files.read_text(self.spark, self._manifest_path(version)))["days"]

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:020d}.json"

    def _publish(self, version: int, days: dict[str, str]) -> None:
        text = json.dumps({"version": version, "days": dict(sorted(days.items()))}, indent=0)
        try:
            files.publish_text(self.spark, self._manifest_path(version), text)
        except FileExistsError:
            raise VersionConflict(f"version {version} of {self.path} exists; read it and write again") from None

    # reading ------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the newest) with their ``day``.

        A filter on ``day`` prunes folders at planning.  The folders of a pinned
        version stay readable until ``collect`` drops that version."""
        pinned = self.version() if version is None else version
        days = self._manifest(pinned)
        schema = T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])
        if not days:
            return self.spark.createDataFrame([], schema)
        # both folder levels are partition columns under one base path
        full = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        folders = [f"{self.path}/data/batch={batch}/{name}" for name, batch in days.items()]
        return (self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*folders)
                .drop("batch"))

    # writing ------------------------------------------------------------

    def replace(self, rows: DataFrame, days: DataFrame | None = None, built_on: int | None = None) -> int:
        """Publish a version in which ``rows`` are the whole content of their days.

        ``days`` (one column) also names days that may have no rows left; they
        leave the table.  ``built_on`` is the version the rows were made from
        (default: the newest at the call); where another writer has published since then,
        ``VersionConflict`` is raised and the table stays as that writer left it."""
        base = self.version() if built_on is None else built_on
        batch = uuid.uuid4().hex
        folder = f"{self.path}/data/batch={batch}"
        named = rows.select(*self.schema.fieldNames()).withColumn("day", F.col(self.day_col).cast("string"))
        named.hint("rebalance", "day").write.mode("errorifexists").partitionBy("day").parquet(folder)
        manifest = self._manifest(base)
        if days is not None:
            # day names only, one per calendar day
            for (day,) in days.select(F.col(days.columns[0]).cast("string")).distinct().collect():
                manifest = {n: b for n, b in manifest.items() if self._day(n) != day}
        for name in files.names(self.spark, folder):
            if name.startswith("day="):
                manifest[name] = batch
        self._publish(base + 1, manifest)
        return base + 1

    @staticmethod
    def _day(name: str) -> str | None:
        day = unquote(name[len("day="):])
        return None if day == NULL_DAY else day

    def collect(self, keep: int = 2, older_than: float = 24 * 3600) -> list[str]:
        """Drop all but the newest ``keep`` versions and the batch folders that
        no kept version names and that are ``older_than`` seconds old (a younger
        one may belong to a writer at work).  Returns the batches dropped."""
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self.versions()
        kept = versions[-keep:]
        used = {b for v in kept for b in self._manifest(v).values()}
        for v in versions[:-keep]:
            files.delete(self.spark, self._manifest_path(v))
        dropped = []
        for name in files.names(self.spark, f"{self.path}/data"):
            folder = f"{self.path}/data/{name}"
            if name.startswith("batch=") and name[len("batch="):] not in used \
                    and time.time() - files.modified(self.spark, folder) >= older_than:
                files.delete(self.spark, folder)
                dropped.append(name[len("batch="):])
        return dropped
