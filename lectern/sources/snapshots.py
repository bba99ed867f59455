"""Snapshots of append-only folders: what many runs wrote, folded once, named by a small manifest.

A folder that runs add to is read faster when it is folded from time to time. The fold is written to a
folder of its own, <base>/_snapshots/<version>; then a manifest of that version is put in place by one
rename. Readers take the newest manifest and what has been added since; until the rename they keep the old
one, and a fold that dies before it leaves nothing behind that a reader would see. Of two folds at the same
time one is refused. Files are reached through Hadoop's file system, so that any store that Spark can write works.
"""

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HIDDEN = "_snapshots"  # Spark's readers of <base> do not look into folders of such a name.


class SnapshotConflict(RuntimeError):
    """Another fold has put the next version in place."""


@dataclass(frozen=True)
class Manifest:
    """One version: the folder of its rows, their schema, and the parts of <base> that are folded in."""

    version: int
    folder: str
    schema: str
    covered: dict[str, list[str]] = field(default_factory=dict)

    def rows(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        return spark.read.schema(schema).option("basePath", self.folder).parquet(self.folder)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in order."""
    found = _files(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(s.getPath().toString() for s in found or ())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file whole, by rename; False if there is one already."""
    files, context = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    out = _files(spark, path).create(_path(spark, draft), True)
    out.write(bytearray(text.encode()))
    out.close()
    store = files.FileContext.getFileContext(_path(spark, path).toUri(), context)
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(files, "Options$Rename"), 0)
    try:
        store.rename(_path(spark, draft), _path(spark, path), no_overwrite)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        _files(spark, path).delete(_path(spark, draft), False)
        return False
    return True


def _text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def newest(spark: SparkSession, base: str) -> Manifest | None:
    """The manifest in force, if the folder has ever been folded."""
    manifests = children(spark, f"{base}/{HIDDEN}/manifest-*.json")
    return Manifest(**json.loads(_text(spark, manifests[-1]))) if manifests else None


def draft_folder(base: str) -> str:
    """Where the rows of a coming version go; no reader looks there before a manifest names it."""
    return f"{base}/{HIDDEN}/rows-{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, before: Manifest | None, folder: str, schema: T.StructType, covered: dict) -> Manifest:
    """Puts the version after `before` in force."""
    version = before.version + 1 if before else 1
    manifest = Manifest(version, folder, schema.json(), covered)
    if not put(spark, f"{base}/{HIDDEN}/manifest-{version:012d}.json", json.dumps(asdict(manifest))):
        raise SnapshotConflict(f"version {version} of {base} is there already")
    return manifest


def expire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Deletes all but the `keep` newest versions and every folder of rows that none of those names; how many went.

    Run it when no reader uses an older version and no fold is on its way.
    """
    manifests = children(spark, f"{base}/{HIDDEN}/manifest-*.json")
    old = manifests[: max(0, len(manifests) - max(1, keep))]
    named = {Manifest(**json.loads(_text(spark, m))).folder.rsplit("/", 1)[1] for m in manifests[len(old) :]}
    folders = [f for f in children(spark, f"{base}/{HIDDEN}/rows-*") if f.rsplit("/", 1)[1] not in named]
    for path in [*old, *folders]:
        remove(spark, path)
    return len(old) + len(folders)
