"""Writing several tables as one version.

Every table goes to a folder of its own below a new version folder. Last, a manifest file with one row
per table appears under the number of the version, whole and at once, and only if no other writer has
taken the number: of two writers that began at the same version one publishes, and the other is refused
and changes nothing. Readers take the newest manifest file, so they see all tables of one version or
none.

A manifest file is written under another name and then linked (local files) or renamed (other stores)
to its own, which must fail if that exists. HDFS does so; object stores whose rename copies do not, and
need one writer at a time.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "ordinal bigint, version string, table_name string, path string"


class VersionConflict(RuntimeError):
    """Another writer has published a version since this one began."""


@dataclass(frozen=True)
class NewVersion:
    """A version that is being written, and the number it will be published under."""

    out: str
    ordinal: int
    name: str

    def folder(self, table: str) -> str:
        return f"{self.out}/versions/{self.name}/{table}"


def _manifest(spark: SparkSession, out: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{out}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(spark: SparkSession, out: str) -> int:
    manifest = _manifest(spark, out)
    return 0 if manifest is None else manifest.agg(F.max("ordinal")).first()[0] or 0


def new_version(spark: SparkSession, out: str) -> NewVersion:
    """The version after the newest published one."""
    out = out.rstrip("/")
    ordinal = _newest(spark, out) + 1
    return NewVersion(out, ordinal, f"{ordinal:08d}-{uuid.uuid4().hex[:8]}")


def publish(spark: SparkSession, version: NewVersion, names: list[str]) -> None:
    """Make the written tables visible together, or raise ``VersionConflict``."""
    rows = [dict(ordinal=version.ordinal, version=version.name, table_name=n, path=version.folder(n)) for n in names]
    content = "".join(json.dumps(r) + "\n" for r in rows).encode("utf-8")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    folder = path(f"{version.out}/manifest")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    # A name with a dot in front is no manifest file to readers.
    draft, final = path(folder, f".{version.name}"), path(folder, f"{version.ordinal:08d}.json")
    if store.getUri().getScheme() == "file":
        here, there = (store.makeQualified(p).toUri().getPath() for p in (draft, final))
        with open(here, "xb") as file:
            file.write(content)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(here, there)
            won = True
        except FileExistsError:
            won = False
        os.remove(here)
    else:
        file = store.create(draft, False)
        file.write(bytearray(content))
        file.close()
        won = not store.exists(final) and store.rename(draft, final)
        if not won:
            store.delete(draft, False)
    if not won:
        raise VersionConflict(f"version {version.ordinal} of {version.out} was published by another writer")


def write_version(tables: Mapping[str, DataFrame], out: str, version: NewVersion | None = None) -> str:
    """Write the tables as parquet and publish them together; returns the version name.

    ``version`` is one taken earlier with ``new_version``, before the tables were read, say; else it is
    taken now. If another one was published since, nothing is, and ``VersionConflict`` is raised.
    """
    spark = next(iter(tables.values())).sparkSession
    version = version or new_version(spark, out)
    for name, table in tables.items():
        table.write.parquet(version.folder(name))
    publish(spark, version, list(tables))
    return version.name


def read_version(spark: SparkSession, out: str, version: str | None = None) -> dict[str, DataFrame]:
    """Tables of the newest (or the named) published version; none if nothing is published."""
    manifest = _manifest(spark, out.rstrip("/"))
    if manifest is None:
        return {}
    if version is None:
        chosen = F.col("ordinal") == F.lit(_newest(spark, out.rstrip("/")))
    else:
        chosen = F.col("version") == version
    # One row per table of one version.
    rows = manifest.filter(chosen).collect()
    return {r["table_name"]: spark.read.parquet(r["path"]) for r in rows}
