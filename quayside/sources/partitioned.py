"""Partitioned tables whose state is one small file: where each partition lies, the schema, and what was loaded.

    root/data/_load=<id>/<column>=<value>/*.parquet    a load writes only the partitions it touches, beside the older ones
    root/ledger/_load=<id>/*.parquet                   manifest rows of a load
    root/_commits/<number>.json                        a version: partition folder -> load, schema, loads with manifest rows, notes,
                                                       loads not merged yet and the rule that merges them

Readers take the newest commit and open the folders it names, so they see a load whole or not at all, and a reader of an
older version goes on reading it. A writer that is lost leaves folders that no commit names; the load is simply repeated.
Two writers of one version are told apart by the commit's number: the rename to it fails for the second one, which begins
again from what the first has written. Data, manifest rows and schema of a load become visible together.

Where the newest row of a key wins, a load is laid beside the earlier ones of its partitions, and readers take the newest
rows of them all. Every ``FAN`` loads of a partition are merged into one, and ``FAN`` of those into one again: many small
loads write each row a few times, not once a load.

A commit has one entry for each partition, such as a month. Nothing is deleted here: retention is the owner's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.cleansing import latest_per_key
from quayside.operators.incremental import merge, pending, require_unique
from quayside.sources.tables import file_system, sized, stored

EMPTY_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value
TRIES = 5
FAN = 8


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


class SchemaChange(ValueError):
    """A column came with a type that does not fit the table's."""


@dataclass(frozen=True)
class Version:
    number: int
    partition: str
    schema: T.StructType
    folders: dict[str, str]
    ledger: tuple[str, ...] = ()
    notes: dict[str, str] = field(default_factory=dict)
    layers: dict[str, list] = field(default_factory=dict)  # (load, how often merged) of a folder's loads, oldest first
    rule: dict = field(default_factory=dict)  # keys, newest and ties, by which layers become one

    def loads(self, name: str) -> list[str]:
        return [load for load, _ in self.layers[name]] if name in self.layers else [self.folders[name]]


# --- commits


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    fs, _ = file_system(spark, root)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_commits/*.json"))
    return sorted(int(s.getPath().getName()[:-5]) for s in found or [])


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A version of the table, the newest unless its number is given; None before the first commit."""
    if number is None:
        known = versions(spark, root)
        if not known:
            return None
        number = known[-1]
    fs, path = file_system(spark, f"{root}/_commits/{number:08d}.json")
    stream = fs.open(path)
    try:
        state = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    schema = T.StructType.fromJson(state["schema"])
    return Version(number, state["partition"], schema, state["folders"], tuple(state["ledger"]), state["notes"], state.get("layers", {}), state.get("rule", {}))


def commit(spark: SparkSession, root: str, new: Version) -> None:
    """Makes a version the newest one, or raises :class:`Conflict` when its number is taken."""
    jvm = spark._jvm
    state = {"partition": new.partition, "schema": new.schema.jsonValue(), "folders": new.folders, "ledger": new.ledger, "notes": new.notes}
    state |= {"layers": new.layers, "rule": new.rule}
    fs, draft = file_system(spark, f"{root}/_commits/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/_commits/{new.number:08d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise Conflict(f"version {new.number} of {root} was committed by another writer") from None
        raise


# --- schema


def wider(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both: equal ones, and numbers that only grew."""
    if old == new:
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale:
        return max(old, new, key=lambda t: t.precision)
    for small, large in ((T.IntegerType(), T.LongType()), (T.FloatType(), T.DoubleType())):
        if {old, new} == {small, large}:
            return large
    raise SchemaChange(f"column {name}: {new.simpleString()} does not fit {old.simpleString()}")


def grown(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns in their order, then those that are new; nothing is read from data files."""
    coming = {f.name: f.dataType for f in new}
    kept = [T.StructField(f.name, wider(f.name, f.dataType, coming[f.name]) if f.name in coming else f.dataType) for f in old]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new if f.name not in old.names])


def _typed(frame: DataFrame, schema: T.StructType) -> DataFrame:
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in frame.columns}
    return frame.select(*[empty.get(f.name, F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)) for f in schema])


# --- reading


def read(spark: SparkSession, root: str, at: Version | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The table in its newest version or in ``at``; ``only`` names the partition folders to open."""
    at = at or version(spark, root)
    if at is None:
        raise FileNotFoundError(f"nothing was committed to {root}")
    names = [name for name in at.folders if only is None or name in only]
    if not names:
        return spark.createDataFrame([], at.schema)
    single, several = ([n for n in names if (len(at.loads(n)) > 1) == many] for many in (False, True))
    parts = [_opened(spark, root, at.schema, {n: at.loads(n) for n in some}) for some in (single, several) if some]
    if several:
        parts[-1] = latest_per_key(parts[-1], **at.rule)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _opened(spark: SparkSession, root: str, schema: T.StructType, loads: dict[str, Sequence[str]]) -> DataFrame:
    """All rows of some loads of some folders, as they were written."""
    paths = [f"{root}/data/_load={load}/{name}" for name, some in loads.items() for load in some]
    whole = T.StructType([*schema.fields, T.StructField("_load", T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{root}/data").parquet(*paths).select(*[f"`{c}`" for c in schema.names])


def mark(spark: SparkSession, root: str):
    """The greatest partition value, from the folder names of the newest commit; None when there is none."""
    at = version(spark, root)
    if at is None or not at.folders:
        return None
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = [(unescape(name.split("=", 1)[1]),) for name in at.folders if not name.endswith(EMPTY_VALUE)]
    return spark.createDataFrame(values, "v string").agg(F.max(F.col("v").cast(at.schema[at.partition].dataType))).first()[0]


def ledger(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Manifest rows of all committed loads."""
    at = version(spark, root)
    if at is None or not at.ledger:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/ledger/_load={load}" for load in at.ledger])


# --- writing


def _land(spark: SparkSession, root: str, rows: DataFrame, schema: T.StructType, partition: str, gathered: bool = False) -> dict[str, str]:
    """Writes rows as a load of their own; returns the folders it made, with the load."""
    load = uuid.uuid4().hex
    path, typed = f"{root}/data/_load={load}", _typed(rows, schema)
    (typed if gathered else sized(typed, [partition])).write.partitionBy(partition).parquet(path)
    fs, where = file_system(spark, path)
    return {s.getPath().getName(): load for s in fs.listStatus(where) if s.isDirectory()}


def _due(tiers: Sequence[int]) -> tuple[int, int]:
    """How many loads stay as they are, and the tier of the one that the others become; with all staying, none is due."""
    keep, tier = len(tiers), 0
    while True:
        first = keep
        while first and tiers[first - 1] <= tier:
            first -= 1
        if keep - first + (keep < len(tiers)) < FAN:
            return keep, tier
        keep, tier = first, tier + 1


def stage(
    spark: SparkSession,
    root: str,
    new: DataFrame,
    keys: Sequence[str],
    partition: str,
    base: Version | None,
    replace: bool = False,
    newest: str | None = None,
    ties: Sequence[str] = (),
    manifest: DataFrame | None = None,
    whole: bool = False,
    unique: bool = False,
    gathered: bool = False,
) -> Version:
    """Writes the partitions that ``new`` touches, merged with ``base``, and returns the version to commit.

    Nothing is visible before :func:`commit`. ``new`` is computed once, by its write; partitions that ``base`` has, too,
    are merged from what was written. With ``whole`` the new rows are all rows of their partitions, and nothing is merged.
    ``unique`` tests the new rows' keys, ``gathered`` says that rows come partition by partition already.
    """
    # a later load may bring columns, but keeps those that are there even where it replaces all rows
    schema = new.schema if base is None or replace else grown(base.schema, new.schema)
    folders, layers = ({}, {}) if base is None or replace else (dict(base.folders), dict(base.layers))
    landed = _land(spark, root, new, schema, partition, gathered)
    rows = lambda names: _opened(spark, root, schema, {n: [landed[n]] for n in names})
    if unique and landed:
        require_unique(rows(landed), keys)
    rule = {} if base is None or replace else base.rule
    again = [] if whole else [name for name in landed if name in folders]
    if newest and partition in keys:
        ours = {"keys": list(keys), "newest": newest, "ties": list(ties)}
        open_ = [name for name in layers if len(layers[name]) > 1 and name in folders]
        if open_ and rule != ours:  # layers of another rule become one before
            folders |= (settled := _land(spark, root, read(spark, root, base, open_), schema, partition))
            layers = {name: [[load, 0]] for name, load in settled.items()}
        rule = ours
        due, tiers = {}, {}
        for name in again:
            several = [*layers.get(name, [[folders[name], 0]]), [landed[name], 0]]
            keep, tier = _due([t for _, t in several])
            if keep < len(several):
                due[name], tiers[name] = [load for load, _ in several[keep:]], tier
            layers[name] = several[:keep]
        merged = _land(spark, root, latest_per_key(_opened(spark, root, schema, due), **ours), schema, partition) if due else {}
        for name, load in merged.items():
            layers[name] = [*layers[name], [load, tiers[name]]]
        for name in set(landed) - set(again):
            layers.pop(name, None)
        folders |= landed | merged
    else:
        folders |= landed
        for name in landed:
            layers.pop(name, None)
        if again:
            old, some = read(spark, root, base, again), rows(again)
            both = latest_per_key(old.unionByName(some, allowMissingColumns=True), keys, newest, ties) if newest else merge(old, some, keys)
            folders |= _land(spark, root, both, schema, partition)
    known = () if base is None else base.ledger
    if manifest is not None:
        load = uuid.uuid4().hex
        manifest.write.parquet(f"{root}/ledger/_load={load}")
        known = (*known, load)
    return Version(1 if base is None else base.number + 1, partition, schema, folders, known, {} if base is None else base.notes, layers, rule)


def upsert(
    spark: SparkSession,
    root: str,
    new: DataFrame,
    keys: Sequence[str],
    partition: str,
    replace: bool = False,
    newest: str | None = None,
    ties: Sequence[str] = (),
    manifest: DataFrame | None = None,
    unique: bool = True,
    gathered: bool = False,
) -> None:
    """Merge into the table, writing only the partitions the new rows touch; one commit makes all of them visible.

    The partition column must be one of the keys. ``new`` is written to the table's folder at once; the key check and
    the merge read it there, and a load that fails is never named by a commit. ``replace`` rebuilds the whole table. With
    ``newest`` the row that is newest by that column wins, else the new one. ``manifest`` rows become part of the table's
    ledger in the same commit. ``unique=False`` is for rows whose copies were collapsed just before.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    for left in reversed(range(TRIES)):
        base = version(spark, root)
        optional = base is not None and not replace and manifest is None
        try:
            staged = stage(spark, root, new, keys, partition, base, replace, newest, ties, manifest, unique=unique, gathered=gathered)
            if optional and staged.folders == base.folders:
                return  # nothing came, as from a file without rows
            return commit(spark, root, staged)
        except SchemaChange:
            if optional and new.isEmpty():
                return
            raise
        except Conflict:
            if not left:
                raise


def load_files(
    spark: SparkSession,
    root: str,
    landed: DataFrame,
    rows_of: Callable[[list[str]], DataFrame],
    manifest_schema: T.StructType | str,
    keys: Sequence[str],
    partition: str,
    newest: str,
    ties: Sequence[str] = (),
) -> int:
    """Loads the landed files that the table's ledger does not name, each once; returns their number.

    ``landed`` has the columns of the manifest, path among them. A run that is repeated after a stop loads the files again
    that were not committed, and no others; of two runs at a time the second finds the first one's files in the ledger.
    """
    while True:
        base = version(spark, root)
        waiting = stored(pending(landed, ledger(spark, root, manifest_schema)), "waiting")
        paths = [r.path for r in waiting.select("path").distinct().collect()]  # names of files, as a listing gives them
        if not paths:
            return 0
        rows = stored(latest_per_key(rows_of(paths), keys, newest, ties), "landed")
        try:
            commit(spark, root, stage(spark, root, rows, keys, partition, base, newest=newest, ties=ties, manifest=waiting))
        except Conflict:
            continue
        return len(paths)
