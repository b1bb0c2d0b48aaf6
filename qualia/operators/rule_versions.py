"""A published rule store: versioned snapshots of the rule table under a folder.

Every put or update writes a whole new snapshot to a folder of its own and then publishes it by creating
one small commit file, ``commits/<version>``, that names the folder. The file is created only if it does not exist
yet, so of two writers that started from the same version one is published and the other is refused
(``RuleConflict``): it has to read again and decide anew. Readers look up the last commit and never see half a
write; any earlier version can be read as it was. A writer that is lost leaves an unnamed folder, which nobody reads.

Snapshots are written by Spark, partitioned by ``source``, so a lookup reads one source's files. The commit files hold
one path each; only they are read on the driver. The folder must be on storage where creating a file that exists
fails (HDFS, local disks, object stores with conditional writes).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from qualia.operators.rulestore import get_rule, put_rules, update_rules
from qualia.sources.rules import DOCUMENT_SCHEMA


class RuleConflict(RuntimeError):
    """Another version was published since the one the change was made from."""


class RuleVersions:
    """The rule store under ``path``; version 0 is the empty store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit(self, version: int):
        return self._paths(f"{self.path}/commits/{version:020d}")

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        folder = self._paths(f"{self.path}/commits")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def latest(self) -> int:
        found = self.versions()
        return found[-1] if found else 0

    def _folder(self, version: int) -> dict:
        commit = self._commit(version)
        if not self._files.exists(commit):
            raise KeyError(f"no version {version} in {self.path}")
        stream = self._files.open(commit)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        """All documents of a version (the last one by default)."""
        version = self.latest() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], DOCUMENT_SCHEMA)
        return self.spark.read.schema(DOCUMENT_SCHEMA).parquet(f"{self.path}/{self._folder(version)['data']}")

    def note(self, version: int) -> str:
        """What the writer said of a version."""
        return self._folder(version)["note"]

    def get(self, source: str, entity: str | None = None, version: int | None = None) -> DataFrame:
        """R1 on a version."""
        return get_rule(self.read(version), source, entity)

    def put(self, docs: DataFrame, base: int | None = None, order_col: str | None = None, note: str = "") -> int:
        """R2: publish the store of version ``base`` (default: the last) with ``docs`` put in; the new version."""
        return self._publish(lambda store: put_rules(store, docs, order_col), base, note)

    def update(self, docs: DataFrame, base: int | None = None, order_col: str | None = None, note: str = "") -> int:
        """Publish the store of version ``base`` (default: the last) with the rules of ``docs`` set; the new version."""
        return self._publish(lambda store: update_rules(store, docs, order_col), base, note)

    def rollback(self, version: int, note: str = "") -> int:
        """Publish an earlier version's documents again, as a new version (no data is written)."""
        data = self._folder(version)["data"] if version else None
        if data is None:
            raise ValueError("version 0 has no documents")
        return self._name(self.latest(), data, note or f"version {version} again")

    def _publish(self, change: Callable[[DataFrame], DataFrame], base: int | None, note: str) -> int:
        base = self.latest() if base is None else base
        if base != self.latest():  # spares the write; the commit below decides
            raise RuleConflict(f"version {base} is not the last one ({self.latest()})")
        data = f"data/{uuid.uuid4().hex}"
        change(self.read(base)).write.partitionBy("source").parquet(f"{self.path}/{data}")
        return self._name(base, data, note)

    def _name(self, base: int, data: str, note: str) -> int:
        version = base + 1
        try:
            stream = self._files.create(self._commit(version), False)  # fails if it exists
        except (Py4JJavaError, PySparkException) as e:
            if self._files.exists(self._commit(version)):
                raise RuleConflict(f"version {version} was published by another writer") from e
            raise
        try:
            stream.write(bytearray(json.dumps({"data": data, "note": note}).encode()))
        finally:
            stream.close()
        return version
