"""What a root holds at each moment: one small file per version, written last.

Runs write into folders of their own and change nothing that is there.  A run
becomes visible when the file of the next version appears, all of it or nothing.
The file is written under another name and renamed; renaming fails where the name
is taken, so of two runs on one base the second is told and starts again from the
new base.  That needs a file system whose rename neither replaces a file nor shows
half of one, such as HDFS.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from rategauge.roles import Roles

FOLDER = "manifest"


class BaseMoved(RuntimeError):
    """Another run was published since the manifest was read."""


@dataclass(frozen=True)
class Part:
    """The run that holds the records of a run month, and the data months among them."""

    run: str
    months: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """``parts`` by run month; ``merged`` names the folder of each data month's averages and lists,
    ``top_k`` what its lists hold; ``audits`` the runs whose audit counts, failed ones included."""

    version: int = 0
    roles: Roles | None = None
    parts: dict[str, Part] = field(default_factory=dict)
    merged: dict[str, str] = field(default_factory=dict)
    top_k: dict[str, int] = field(default_factory=dict)
    audits: tuple[str, ...] = ()

    def runs_of(self, months: set[str] | None = None) -> dict[str, list[str]]:
        """Run months by run, of parts that have records in one of the data months (or of all)."""
        found: dict[str, list[str]] = {}
        for run_month, part in sorted(self.parts.items()):
            if months is None or months & set(part.months):
                found.setdefault(part.run, []).append(run_month)
        return found


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _name(version: int) -> str:
    return f"{version:012d}.json"


def current(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; an empty one if nothing was published."""
    folder, files = _folder(spark, root)
    if not files.exists(folder):
        return Manifest()
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    newest = max((n for n in names if n.endswith(".json") and not n.startswith((".", "_"))), default=None)
    if newest is None:
        return Manifest()
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(folder, newest))
    try:
        told = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    parts = {month: Part(part["run"], tuple(part["months"])) for month, part in told.pop("parts").items()}
    roles = told.pop("roles")
    return Manifest(**told | {"audits": tuple(told["audits"])}, parts=parts, roles=Roles(**roles) if roles else None)


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make ``manifest`` the newest; :class:`BaseMoved` if its version exists."""
    folder, files = _folder(spark, root)
    java = spark._jvm.org.apache.hadoop.fs
    draft, final = java.Path(folder, f".{uuid.uuid4().hex}"), java.Path(folder, _name(manifest.version))
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(asdict(manifest), indent=1).encode()))
    finally:
        stream.close()
    keep = spark.sparkContext._gateway.new_array(java.Options.Rename, 1)
    keep[0] = java.Options.Rename.NONE
    try:
        java.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, keep)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise BaseMoved(f"version {manifest.version} of {root} exists") from error
        raise
