"""Published snapshots: a manifest names the folders that make up each table, and one mark makes it current.

    dest/tables/<database>/<table>/_version=v00000007/[<column>=<value>/]*.parquet
    dest/v00000007/_CLAIMED, manifest.json, _PUBLISHED

Folders below ``tables`` are written once and never changed. A version that replaces some partitions writes those and
lists the others where earlier versions put them, so its cost is that of the change. The mark is written last and is
empty: a version is complete exactly if its mark exists, and no store has to rename anything. Readers take the highest
marked version, and get the partition column of the folders, so that filters on it skip files unread.
"""

import json
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.sources.files import Folder
from aeroband.sources.tables import base_tables, on_partitions, partition_columns

_CLAIM, _MANIFEST, _MARK = "_CLAIMED", "manifest.json", "_PUBLISHED"
_VERSION = "_version"
_NULL = "__HIVE_DEFAULT_PARTITION__"
ABANDONED_SECONDS = 24 * 3600


class PublicationConflict(RuntimeError):
    """Another publisher made a version current in the meantime; nothing was published."""


@dataclass
class Published:
    """A table of a version: its schema, and the partition folders (one named "" if it has none) of each version."""

    schema: dict
    partition_by: list[str]
    folders: dict[str, list[str]] = field(default_factory=dict)
    # How many folders a version wrote: one that still counts in full is read as a whole.
    written: dict[str, int] = field(default_factory=dict)

    def without(self, names: set[str]) -> "Published":
        left = {version: [n for n in own if n not in names] for version, own in self.folders.items()}
        return Published(self.schema, self.partition_by, {v: own for v, own in left.items() if own}, self.written)

    def paths(self, root: str) -> list[str]:
        found = []
        for version, own in self.folders.items():
            whole = len(own) == self.written[version]
            found += [f"{root}/{_VERSION}={version}" + (f"/{name}" if name and not whole else "") for name in ([""] if whole else own)]
        return found


def publish_snapshot(
    spark: SparkSession,
    databases: list[str],
    dest: str,
    keep: int = 2,
    changed: dict[str, list[date | None] | None] | None = None,
    sort_by: dict[str, list[str]] | None = None,
) -> list[str]:
    """Make the base tables of the databases the current version below ``dest``, all at once.

    ``changed`` names the tables that differ from the current version and, for a partitioned one, the values of the
    partitions that do (None: all of it); others stay as published. Without ``changed``, and for tables new or of
    another schema, everything is written. ``sort_by`` names columns to sort a table's files by, so that lookups by
    them skip row groups.

    The latest ``keep`` versions stay, this one included: readers may have resolved the one before it. What a publisher
    that died left goes after a day. Returns the sorted names of the tables. A missing database or the lack of any table
    is an error, and a failure at any point leaves the current version as it was.
    """
    if keep < 1:
        raise ValueError("the version to be published has to be kept")
    names = base_tables(spark, databases)
    if not names:
        raise RuntimeError(f"no tables to publish in {', '.join(databases)}")
    folder = Folder(spark, dest)
    before = _published(folder)
    old = _manifest(folder, before[-1]) if before else {}
    version = _claimed(folder)
    try:
        manifest = {}
        for name in names:
            untouched = changed is not None and name not in changed
            values = changed.get(name) if changed is not None else None
            manifest[name] = _written(spark, folder, version, name, old.get(name), untouched, values, (sort_by or {}).get(name))
        folder.write_text(f"{version}/{_MANIFEST}", json.dumps({name: vars(table) for name, table in manifest.items()}))
        if _published(folder) != before:
            raise PublicationConflict(f"{dest} was published to while {version} was written")
        folder.mark(f"{version}/{_MARK}")
    except BaseException:
        _remove(folder, version, names)
        raise
    _tidy(folder, [*before, version], keep, names)
    return names


def _claimed(folder):
    """A version number of this publisher's own."""
    number = int(max(_versions(folder), default="v0")[1:])
    while True:
        number += 1
        if folder.claim(f"v{number:08d}/{_CLAIM}"):
            return f"v{number:08d}"


def _written(spark, folder, version, name, old, untouched, values, sort_by) -> Published:
    df = spark.table(name)
    by = partition_columns(spark, name)
    comparable = old is not None and old.partition_by == by and old.schema == _plain(df.schema)
    if comparable and untouched:
        return old
    new = Published(_plain(df.schema), by)
    if comparable and by and values is not None:
        df = on_partitions(df, by[0], values)
        new = old.without({f"{by[0]}={_NULL if value is None else value}" for value in values})
    place = f"{_root(name)}/{_VERSION}={version}"
    if by:
        # A partition is a few files, however many tasks hold its rows.
        df = df.hint("rebalance", *by)
    if sort_by:
        df = df.sortWithinPartitions(*by, *sort_by)
    (df.write.partitionBy(*by) if by else df.write).parquet(f"{folder.path}/{place}")
    own = [n for n in folder.names(place) if "=" in n] if by else [""]
    if own:
        new.folders, new.written = {**new.folders, version: own}, {**new.written, version: len(own)}
    return new


def _plain(schema: T.StructType) -> dict:
    """A schema as stored: all columns may be null, as files say."""
    found = json.loads(schema.json())
    for column in found["fields"]:
        column["nullable"], column["metadata"] = True, {}
    return found


def _root(name):
    return f"tables/{name.replace('.', '/')}"


def _remove(folder, version, names):
    """All that a version wrote; other versions do not use it."""
    for name in names:
        folder.delete(f"{_root(name)}/{_VERSION}={version}")
    folder.delete(version)


def _tidy(folder, published, keep, names):
    """Delete versions beyond ``keep``, folders that only those use, and what dead publishers left."""
    outdated, kept = published[:-keep], published[-keep:]
    in_use = {place for version in kept for place in _places(_manifest(folder, version))}
    for version in outdated:
        for place in _places(_manifest(folder, version)) - in_use:
            folder.delete(place)
        folder.delete(version)
    for version in set(_versions(folder)) - set(published):
        claim = f"{version}/{_CLAIM}"
        if not folder.exists(claim) or folder.seconds_since(claim) > ABANDONED_SECONDS:
            _remove(folder, version, names)


def _places(manifest):
    return {
        f"{_root(name)}/{_VERSION}={version}/{own}".rstrip("/")
        for name, table in manifest.items() for version, owned in table.folders.items() for own in owned
    }


def _manifest(folder, version) -> dict[str, Published]:
    return {name: Published(**table) for name, table in json.loads(folder.read_text(f"{version}/{_MANIFEST}")).items()}


def current_version(spark: SparkSession, dest: str) -> str:
    """Path of the current version."""
    published = _published(Folder(spark, dest))
    if not published:
        raise FileNotFoundError(f"nothing published in {dest}")
    return f"{dest.rstrip('/')}/{published[-1]}"


def read_snapshot(spark: SparkSession, dest: str, table: str) -> DataFrame:
    """A table (``database.name``) of the current version, with its schema also if it has no rows."""
    folder = Folder(spark, dest)
    found = _manifest(folder, current_version(spark, dest).rsplit("/", 1)[1])
    if table not in found:
        raise FileNotFoundError(f"{table} is not published in {dest}")
    schema = T.StructType.fromJson(found[table].schema)
    root = f"{folder.path}/{_root(table)}"
    paths = found[table].paths(root)
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType())])
    return spark.read.schema(stored).option("basePath", root).parquet(*paths).select(
        *[F.col(f"`{column}`") for column in schema.names]
    )


def read_published(spark: SparkSession, dest: str, fallback: str, table: str) -> tuple[DataFrame, bool]:
    """A table of the current version, and True; if there is none, that of the older copy kept at ``fallback``
    (a published folder too), and False."""
    try:
        current_version(spark, dest)
    except FileNotFoundError:
        return read_snapshot(spark, fallback, table), False
    return read_snapshot(spark, dest, table), True


def _versions(folder):
    return [name for name in folder.names() if name[:1] == "v" and name[1:].isdigit()]


def _published(folder):
    return [version for version in _versions(folder) if folder.exists(f"{version}/{_MARK}")]
