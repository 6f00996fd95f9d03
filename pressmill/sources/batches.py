"""The article table as a versioned set of batches (U1, U2, commits of E3).

A *manifest* lists one folder per batch, with its number of rows.  A job writes the
batches it worked on to new folders and publishes the next manifest, by creating a file
that must not exist yet; all else stays where it is, and is not even listed.  A reader
keeps the version it began with, and two jobs cannot publish the same version.

    <path>/manifests/00000000000000000007   one JSON line per batch
    <path>/data/<write>/batch=<n>/          rows of one batch, from one write

The driver holds the manifest, a line per import, and never rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from pressmill.schemas import ARTICLE, EXTRACTION
from pressmill.session import remove_folder

# what a stored article has; a batch written before its first extraction reads as null there
STORED = T.StructType([*ARTICLE.fields, *EXTRACTION.fields])


class VersionExists(RuntimeError):
    """Another job published the version first."""


class BatchRefused(ValueError):
    """Rows given do not make up the batches they belong to."""


@dataclass(frozen=True)
class Batch:
    batch_id: int | None
    folder: str
    rows: int


class BatchTable:
    """Batches of articles below ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = STORED, key: str = "batch_id"):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # -- manifests -------------------------------------------------------------

    def _file(self, path: str):
        place = self._hadoop.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:020d}"

    def versions(self) -> list[int]:
        """Numbers of the published versions, in order."""
        system, folder = self._file(f"{self.path}/manifests")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def latest(self) -> int:
        """The newest version; 0 for a table that has none."""
        return max(self.versions(), default=0)

    def batches(self, version: int | None = None) -> dict[int | None, Batch]:
        version = self.latest() if version is None else version
        if not version:
            return {}
        lines = self.spark.read.text(self._manifest(version)).collect()
        found = [Batch(**json.loads(line["value"])) for line in lines if line["value"]]
        return {batch.batch_id: batch for batch in found}

    def _publish(self, version: int, batches: dict[int | None, Batch]) -> int:
        system, place = self._file(self._manifest(version))
        text = "\n".join(json.dumps(asdict(b)) for b in batches.values()) + "\n"
        # written beside and then renamed, so that no reader finds half a manifest
        _, beside = self._file(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = system.create(beside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if system.exists(place) or not system.rename(beside, place):
            system.delete(beside, False)
            raise VersionExists(f"version {version} of {self.path} was published by another job")
        return version

    # -- rows ------------------------------------------------------------------

    def read(self, batch_ids: list[int | None] | None = None, version: int | None = None) -> DataFrame:
        """Rows of some batches, or of all; files of other batches are not listed or read."""
        batches = self.batches(version)
        chosen = batches.values() if batch_ids is None else [batches[b] for b in batch_ids if b in batches]
        folders = [batch.folder for batch in chosen]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, rows: DataFrame) -> dict[int | None, Batch]:
        """Write rows to a new folder, a folder per batch; what was written is counted from its files."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        typed = rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])
        typed.withColumn("_batch", F.col(self.key)).write.partitionBy("_batch").parquet(folder)
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())])).parquet(folder)
        counts = written.groupBy("_batch").agg(F.count("*").alias("rows")).collect()
        name = lambda batch: "__HIVE_DEFAULT_PARTITION__" if batch is None else batch
        return {r["_batch"]: Batch(r["_batch"], f"{folder}/_batch={name(r['_batch'])}", r["rows"]) for r in counts}

    def append(self, rows: DataFrame, replace: list[int | None] = ()) -> int:
        """Publish new batches; those of ``replace`` are left out of the next version.  Its number."""
        version, known = self.latest(), self.batches()
        kept = {b: batch for b, batch in known.items() if b not in set(replace)}
        new = self._write(rows)
        again = sorted(map(str, set(new) & set(kept)))
        if again:
            raise BatchRefused(f"batches {', '.join(again)} are there already")
        return self._publish(version + 1, {**kept, **new})

    def update(self, rows: DataFrame, since: int | None = None) -> int:
        """Publish new contents of the batches that ``rows`` belong to.  The version's number.

        Each must be given whole: a batch of another number of rows, or one that the
        table does not have, is refused and nothing is published.  ``since`` is the
        version the rows were read from; a later one is refused.
        """
        version = self.latest()
        if since is not None and since != version:
            raise VersionExists(f"version {version} of {self.path} came after {since}")
        known, new = self.batches(version), self._write(rows)
        for number, batch in new.items():
            before = known[number].rows if number in known else 0
            if batch.rows != before:
                raise BatchRefused(f"batch {number} has {before} rows and {batch.rows} were given")
        return self._publish(version + 1, {**known, **new})

    def forget(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, with what only they and refused writes refer to.

        Not to be called while a job writes.
        """
        versions = self.versions()
        used = {batch.folder for v in versions[-keep:] for batch in self.batches(v).values()}
        for version in versions[:-keep]:
            system, place = self._file(self._manifest(version))
            system.delete(place, False)
        system, data = self._file(f"{self.path}/data")
        if not system.exists(data):
            return
        for write in system.listStatus(data):
            own = f"{self.path}/data/{write.getPath().getName()}"
            names = [s.getPath().getName() for s in system.listStatus(write.getPath()) if s.isDirectory()]
            stale = [name for name in names if f"{own}/{name}" not in used]
            for folder in [own] if len(stale) == len(names) else [f"{own}/{name}" for name in stale]:
                remove_folder(self.spark, folder)
