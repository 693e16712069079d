"""Versions of a keyed table: which folders hold each partition, in a manifest written last.

A write puts its rows into a folder of its own and then adds one small file, the manifest of the next
version, by a rename that fails where that version exists already. Readers take the newest manifest,
so they see a write as a whole or not at all; of two writers that start from one version, the second
fails and leaves the table as it is.

A partition is held by one base folder and any number of deltas after it. On reading, the row of the
last folder that has a key counts; ``compact`` turns the folders of such partitions into one again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_versions"
WRITE = "_write"


class VersionConflict(RuntimeError):
    """Another writer has added the version that this one wanted to add."""


@dataclass(frozen=True)
class Manifest:
    """One version: its number, columns, keys, the folders of each partition and the batches taken in."""

    number: int
    schema: str
    keys: tuple[str, ...]
    partitions: tuple[str, ...]
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def newest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest of the table at ``path``, or None where it has none."""
    folder, system = _files(spark, f"{path}/{MANIFESTS}")
    if not system.exists(folder):
        return None
    numbers = [int(s.getPath().getName()) for s in system.listStatus(folder) if s.getPath().getName().isdigit()]
    if not numbers:
        return None
    text = spark.read.text(f"{path}/{MANIFESTS}/{max(numbers):012d}", wholetext=True).first()["value"]
    held = json.loads(text)
    return Manifest(**held | {"keys": tuple(held["keys"]), "partitions": tuple(held["partitions"])})


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Add a version in one step, or raise :class:`VersionConflict` where its number is taken."""
    jvm = spark._jvm
    folder, system = _files(spark, f"{path}/{MANIFESTS}")
    system.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/_draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    finally:
        out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{manifest.number:012d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    rename[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(final), rename)
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in str(error) or system.exists(final):
            raise VersionConflict(f"version {manifest.number} of {path} exists already") from None
        raise


def write_folder(df: DataFrame, path: str, partitions: Sequence[str]) -> dict[str, str]:
    """Write rows into a folder of their own; the folder of each partition in it, relative to ``path``."""
    spark, name = df.sparkSession, f"{WRITE}={uuid.uuid4().hex}"
    df.hint("rebalance", *[F.col(p) for p in partitions]).write.partitionBy(*partitions).parquet(f"{path}/{name}")
    root, system = _files(spark, f"{path}/{name}")
    found, level = {}, [("", root)]
    for _ in partitions:
        level = [
            (f"{at}/{s.getPath().getName()}", s.getPath()) for at, folder in level for s in system.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()
        ]
    for at, _ in level:
        found[at.lstrip("/")] = f"{name}{at}"
    return found


def _scan(spark: SparkSession, path: str, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
    schema = T.StructType([*manifest.columns.fields, T.StructField(WRITE, T.StringType())])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{folder}" for folder in folders])


def read_version(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """The rows of a version, columns in its order; columns added later are null in older rows.

    Partitions of one folder are scanned as they are; in the others the last folder's row of each
    key counts. A batch's place among the folders is looked up in a literal of the manifest.
    """
    plain = [held[0] for held in manifest.folders.values() if len(held) == 1]
    layered = [held for held in manifest.folders.values() if len(held) > 1]
    names = manifest.columns.names
    rows = _scan(spark, path, manifest, plain).select(*names)
    if not layered:
        return rows
    order = list(dict.fromkeys(folder.split("/")[0].split("=")[1] for held in layered for folder in held))
    # Folders are listed in the order they were written in, for all partitions alike.
    order.sort(key=_places(manifest).__getitem__)
    place = F.array_position(F.lit(order), F.col(WRITE))
    both = _scan(spark, path, manifest, [folder for held in layered for folder in held])
    last = Window.partitionBy(*manifest.keys, *manifest.partitions).orderBy(place.desc())
    merged = both.withColumn("_turn", F.row_number().over(last)).where("_turn = 1")
    return rows.unionByName(merged.select(*names))


def _places(manifest: Manifest) -> dict[str, int]:
    """A place for each write that agrees with its order in every partition."""
    places: dict[str, int] = {}
    for held in manifest.folders.values():
        for folder in held:
            places.setdefault(folder.split("/")[0].split("=")[1], len(places))
    changed = True
    while changed:  # a later folder stands after an earlier one wherever both occur
        changed = False
        for held in manifest.folders.values():
            writes = [folder.split("/")[0].split("=")[1] for folder in held]
            for a, b in zip(writes, writes[1:], strict=False):
                if places[b] <= places[a]:
                    places[b], changed = places[a] + 1, True
    return places


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, the old ones first; a name is known by its letters in any case."""
    known = {field.name.lower() for field in old}
    return T.StructType([*old.fields, *[field for field in new if field.name.lower() not in known]])


def next_version(manifest: Manifest | None, schema: T.StructType, keys: Sequence[str], partitions: Sequence[str]) -> Manifest:
    if manifest is None:
        return Manifest(1, schema.json(), tuple(keys), tuple(partitions))
    if (tuple(keys), tuple(partitions)) != (manifest.keys, manifest.partitions):
        raise ValueError(f"the table has keys {manifest.keys} and partitions {manifest.partitions}")
    return replace(manifest, number=manifest.number + 1, schema=widened(manifest.columns, schema).json(), folders={k: list(v) for k, v in manifest.folders.items()}, batches=dict(manifest.batches))


def replace_folders(path: str, manifest: Manifest, rows: DataFrame) -> Manifest:
    """Write ``rows`` as the whole of their partitions."""
    for part, folder in write_folder(rows, path, manifest.partitions).items():
        manifest.folders[part] = [folder]
    return manifest


def add_folders(path: str, manifest: Manifest, rows: DataFrame) -> Manifest:
    """Write ``rows``, one per key, over what their partitions hold."""
    for part, folder in write_folder(rows, path, manifest.partitions).items():
        manifest.folders.setdefault(part, []).append(folder)
    return manifest


def compact(spark: SparkSession, path: str, folders: int = 1) -> Manifest | None:
    """A version whose partitions of more than ``folders`` folders have one; rows stay as they are.

    Reads and writes those partitions only. Returns None where there are none.
    """
    manifest = newest(spark, path)
    if manifest is None:
        return None
    full = {part: held for part, held in manifest.folders.items() if len(held) > folders}
    if not full:
        return None
    after = replace(manifest, number=manifest.number + 1, folders={k: list(v) for k, v in manifest.folders.items()})
    replace_folders(path, after, read_version(spark, path, replace(manifest, folders=full)))
    commit(spark, path, after)
    return after
