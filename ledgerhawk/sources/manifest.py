"""Manifest of a warehouse: which version of each day's tables readers see.

Every load writes its tables into directories of a version of its own,
``<table>/load_dt=D/load=<version>/``, which no reader looks at. A manifest,
``_manifest/<number>.json``, names for each day the version of each of its tables.
Publishing is one rename: the next manifest is written beside the others and renamed to the next
number, which fails if another load took that number first. So readers see either
all tables of a load or none, and a load that breaks off leaves nothing but files that
:meth:`Warehouse.vacuum` removes.

A day's entry has a ``kind``: ``state`` (the dimensions are stored as of its end),
``range`` (loaded inside a backfill), or ``stale`` (an earlier day was loaded again since).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Manifests that stay behind the newest, for readers that have just listed them.
KEPT = 20


class ConcurrentLoad(RuntimeError):
    """Another load published first; nothing of this one is visible. Run it again."""


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    days: dict[str, dict] = field(default_factory=dict)

    def version(self, day: str, table: str) -> str | None:
        return self.days.get(day, {}).get("tables", {}).get(table)

    def kind(self, day: str) -> str | None:
        kind = self.days.get(day, {}).get("kind")
        return None if kind == "stale" else kind

    def days_of(self, table: str, stale: bool = False) -> list[str]:
        """Days with a version of ``table``, in order; ``stale`` ones only if asked."""
        return sorted(d for d, e in self.days.items() if table in e["tables"] and (stale or e["kind"] != "stale"))


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop, on the driver."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(folder))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest under ``path`` (an empty one, number 0, if there is none)."""
    fs, folder = hadoop_path(spark, path)
    numbers = _numbers(fs, folder)
    if not numbers:
        return Manifest()
    jvm = spark.sparkContext._jvm
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/{numbers[-1]:09d}.json"))
    try:
        return Manifest(numbers[-1], json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, base: Manifest, days: dict[str, dict]) -> Manifest:
    """Make ``days`` the manifest after ``base``; :class:`ConcurrentLoad` if ``base`` is not the newest any more."""
    jvm = spark.sparkContext._jvm
    fs, folder = hadoop_path(spark, path)
    fs.mkdirs(folder)
    new = Manifest(base.number + 1, days)
    written = jvm.org.apache.hadoop.fs.Path(f"{path}/_{uuid.uuid4().hex}.tmp")
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/{new.number:09d}.json")
    out = fs.create(written, False)
    try:
        out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # never over an existing file
    try:
        context.rename(fs.makeQualified(written), fs.makeQualified(target), none)
    except Exception as e:
        fs.delete(written, False)
        if fs.exists(target):
            raise ConcurrentLoad(f"{path}: manifest {new.number} was published by another load") from e
        raise
    for n in _numbers(fs, folder)[:-KEPT]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{n:09d}.json"), False)
    return new
