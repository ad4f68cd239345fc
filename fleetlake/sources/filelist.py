"""Path tables with a numbered list of live folders: concurrent writers, atomic swaps, compaction.

A table is ``root/data/<write>/_part=<value>/*.parquet``, and ``root/pointer/part-<number>.json`` names the folders
that count. A commit is written under a name of its own and then renamed to the next number, which fails if that
number exists; the loser reads the newer list and decides again. So of two writers none is lost, and a reader
sees one list: a batch, a replaced bucket or a compacted day appears as a whole or not at all. What a failed
write left behind is never listed.

Renaming without overwriting is atomic on HDFS and local disks. A store that copies instead is safe for one writer only. The list is read by the driver, as any file listing is; it has one line per folder, not per file.
"""

from __future__ import annotations

import dataclasses
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.session import listing_settings

PART = "_part"
SMALL_BYTES = 128 << 20
TARGET_BYTES = 256 << 20
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Folders that a change wanted to replace are no longer live."""


@dataclass(frozen=True)
class Folder:
    """One folder of one write: the value of ``part``, its path below the root, its files and bytes."""

    part: str
    path: str
    files: int
    size: int


@dataclass(frozen=True)
class Listing:
    """What counts as of a commit; ``notes`` are small values that writers keep with it."""

    number: int = 0
    schema: str | None = None
    folders: tuple[Folder, ...] = ()
    notes: dict = field(default_factory=dict)

    def of(self, parts: set[str]) -> list[Folder]:
        return [f for f in self.folders if f.part in parts]


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, or return False if there is one of that name already."""
    jvm, fs = spark.sparkContext._jvm, _fs(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    out = fs.create(_path(spark, draft), False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    keep[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(_path(spark, draft), _path(spark, path), keep)
        return True
    except Py4JJavaError as error:
        fs.delete(_path(spark, draft), False)
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _commit_path(root: str, number: int) -> str:
    return f"{root}/pointer/part-{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, root), _path(spark, f"{root}/pointer")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[5:-5]) for n in names if n.startswith("part-") and n.endswith(".json"))


def listing(spark: SparkSession, root: str, number: int | None = None) -> Listing:
    """The newest list of a table, or that of an earlier commit; an empty one before the first commit."""
    if number is None:
        numbers = _numbers(spark, root)
        if not numbers:
            return Listing()
        number = numbers[-1]
    found = json.loads(read_text(spark, _commit_path(root, number)))
    folders = tuple(Folder(**f) for f in found["folders"])
    return Listing(number, found["schema"], folders, found["notes"])


def _put(spark: SparkSession, root: str, wanted: Listing) -> bool:
    body = {"schema": wanted.schema, "folders": [asdict(f) for f in wanted.folders], "notes": wanted.notes}
    return put_if_absent(spark, _commit_path(root, wanted.number), json.dumps(body))


def commit(spark: SparkSession, root: str, change: Callable[[Listing], Listing]) -> Listing:
    """Put ``change`` of the newest list in its place; it is asked again when another writer was faster.

    ``change`` raises ``Conflict`` if it cannot be applied to the list it is given.
    """
    for _ in range(ATTEMPTS):
        base = listing(spark, root)
        wanted = dataclasses.replace(change(base), number=base.number + 1)
        if _put(spark, root, wanted):
            return wanted
    raise Conflict(f"{ATTEMPTS} other commits came first at {root}")


# --- Writing and reading rows


def write_folders(
    df: DataFrame, root: str, part: Column | None = None, keep: list[str] | None = None, spread: bool = True
) -> list[Folder]:
    """Write rows (all columns, or ``keep``) below ``root``, by ``part`` if one is given, without listing them yet.

    ``spread`` sends each part to as few files as its size allows; without it rows are written where they are.
    """
    spark, name = df.sparkSession, f"data/{uuid.uuid4().hex}"
    columns = keep or df.columns
    if part is None:
        df.select(*columns).write.parquet(f"{root}/{name}/{PART}=all")
    else:
        rows = df.select(*columns, F.coalesce(part.cast("string"), F.lit("none")).alias(PART))
        (rows.hint("rebalance", PART) if spread else rows).write.partitionBy(PART).parquet(f"{root}/{name}")
    return folders_of(spark, root, name)


def folders_of(spark: SparkSession, root: str, name: str) -> list[Folder]:
    """The folders of one write with their files and sizes."""
    fs, found = _fs(spark, root), {}
    files = fs.listFiles(_path(spark, f"{root}/{name}"), True)
    while files.hasNext():
        status = files.next()
        path = status.getPath()
        if path.getName().endswith(".parquet"):
            last = path.getParent().getName()
            n, size = found.get(last, (0, 0))
            found[last] = (n + 1, size + status.getLen())
    return [Folder(last.split("=", 1)[1], f"{name}/{last}", n, size) for last, (n, size) in sorted(found.items())]


def _schema(df: DataFrame) -> str:
    return df.schema.json()


def append(df: DataFrame, root: str, part: Column | None = None, notes: dict | None = None) -> Listing:
    """Add rows to a table; other writers may add at the same time."""
    added = tuple(write_folders(df, root, part))

    def change(base: Listing) -> Listing:
        return Listing(base.number, _schema(df), base.folders + added, {**base.notes, **(notes or {})})

    return commit(df.sparkSession, root, change)


def replace(df: DataFrame, root: str, gone: list[Folder], part: Column | None = None, notes: dict | None = None) -> Listing:
    """Put rows in the place of the folders ``gone``, which must all still be live."""
    return swap(df.sparkSession, root, gone, write_folders(df, root, part), _schema(df), notes)


def swap(
    spark: SparkSession, root: str, gone: list[Folder], added: list[Folder], schema: str | None, notes: dict | None = None
) -> Listing:
    old = set(gone)

    def change(base: Listing) -> Listing:
        if not old <= set(base.folders):
            raise Conflict(f"another writer replaced folders of {root}")
        kept = tuple(f for f in base.folders if f not in old)
        return Listing(base.number, schema or base.schema, kept + tuple(added), {**base.notes, **(notes or {})})

    return commit(spark, root, change)


def read_folders(spark: SparkSession, root: str, folders: list[Folder], schema: str | None) -> DataFrame | None:
    """The rows of some folders, without their folder names; None for a table that was never written."""
    if schema is None:
        return None
    types = T.StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], types)
    with listing_settings(spark):
        return spark.read.schema(types).parquet(*[f"{root}/{f.path}" for f in folders])


def read_parts(spark: SparkSession, root: str, folders: list[Folder], schema: str, part: str) -> DataFrame:
    """The rows of some folders of one write, with the value that their folder stands for as the column ``part``."""
    types = T.StructType([*T.StructType.fromJson(json.loads(schema)).fields, T.StructField(PART, T.StringType())])
    write = f"{root}/{folders[0].path.rsplit('/', 1)[0]}"
    with listing_settings(spark):
        rows = spark.read.schema(types).option("basePath", write).parquet(*[f"{root}/{f.path}" for f in folders])
    return rows.withColumnRenamed(PART, part)


def read(spark: SparkSession, root: str, parts: set[str] | None = None, at: Listing | None = None) -> DataFrame | None:
    """The table as of its newest commit (or of ``at``), or only some of its parts; None before the first commit."""
    now = at or listing(spark, root)
    return read_folders(spark, root, list(now.folders) if parts is None else now.of(parts), now.schema)


def update(spark: SparkSession, root: str, change: Callable[[DataFrame | None], DataFrame], attempts: int = ATTEMPTS) -> Listing:
    """Replace a table by ``change`` of it, computed again if another writer was faster.

    ``change`` gets the current rows (None for a new table) and may read them any number of times.
    """
    for _ in range(attempts):
        base = listing(spark, root)
        written = change(read(spark, root, at=base))
        wanted = Listing(base.number + 1, _schema(written), tuple(write_folders(written, root)), base.notes)
        if _put(spark, root, wanted):
            return wanted
    raise Conflict(f"{attempts} other writers came first at {root}")


# --- Compaction


def bins(folders: list[Folder], small: int = SMALL_BYTES, target: int = TARGET_BYTES) -> list[list[Folder]]:
    """Folders whose files are small on average, packed to at most about ``target`` bytes; only bins worth a rewrite.

    First fit by falling size within each part: every folder goes to the first bin that still has room.
    """
    by_part: dict[str, list[Folder]] = {}
    for f in folders:
        if f.size < small * f.files:
            by_part.setdefault(f.part, []).append(f)
    packed = []
    for part in sorted(by_part):
        open_bins: list[tuple[int, list[Folder]]] = []
        for f in sorted(by_part[part], key=lambda f: (-f.size, f.path)):
            at = next((i for i, (size, _) in enumerate(open_bins) if size + f.size <= target), None)
            if at is None:
                open_bins.append((f.size, [f]))
            else:
                open_bins[at] = (open_bins[at][0] + f.size, [*open_bins[at][1], f])
        packed += [found for _, found in open_bins if sum(f.files for f in found) > 1]
    return packed


def compact(
    spark: SparkSession,
    root: str,
    small: int = SMALL_BYTES,
    target: int = TARGET_BYTES,
    before_swap: Callable[[list[Folder]], None] | None = None,
) -> Listing:
    """Rewrite small files together, each bin as about one file of its part, and swap them in one commit.

    Rows are the same before and after, and a reader sees either. Writers may add at the same time; if another one
    replaced a folder meanwhile, the compaction gives up with ``Conflict`` and nothing has changed.
    """
    now = listing(spark, root)
    packed = bins(list(now.folders), small, target)
    if not packed:
        return now
    gone = [f for found in packed for f in found]
    types = T.StructType.fromJson(json.loads(now.schema))
    # All bins in one job: a bin's number travels with its rows and is their only partitioning.
    numbers = spark.createDataFrame(
        [(f.path.removeprefix("data/"), n) for n, found in enumerate(packed) for f in found], "_folder string, _bin int"
    )
    with listing_settings(spark):
        rows = spark.read.schema(types).parquet(*[f"{root}/{f.path}" for f in gone])
    folder = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+/[^/]+)/[^/]*$", 1))
    tagged = rows.withColumn("_folder", folder).join(numbers, "_folder").drop("_folder")
    name = f"data/{uuid.uuid4().hex}"
    tagged.repartition("_bin").write.partitionBy("_bin").parquet(f"{root}/{name}")
    added = [Folder(packed[int(f.part)][0].part, f.path, f.files, f.size) for f in folders_of(spark, root, name)]
    if before_swap:
        before_swap(added)
    return swap(spark, root, gone, added, now.schema)


def file_names(spark: SparkSession, root: str, folders: list[Folder]) -> list[str]:
    """Paths of all data files of some folders, for statistics and tests."""
    fs, names = _fs(spark, root), []
    for f in folders:
        statuses = fs.listStatus(_path(spark, f"{root}/{f.path}"))
        names += [s.getPath().toString() for s in statuses if s.getPath().getName().endswith(".parquet")]
    return sorted(names)


def expire(spark: SparkSession, root: str, keep: int = 10, hours: float = 24) -> int:
    """Delete what the last ``keep`` commits do not name: older lists, and folders last written ``hours`` ago; how many folders.

    Folders of a write that has not committed yet are younger than that, if no write takes longer.
    """
    fs, numbers = _fs(spark, root), _numbers(spark, root)
    if not numbers:
        return 0
    named = {f.path for n in numbers[-keep:] for f in listing(spark, root, n).folders}
    oldest, gone = time.time() * 1000 - hours * 3_600_000, 0
    for write in fs.listStatus(_path(spark, f"{root}/data")):
        name = write.getPath().getName()
        for part in fs.listStatus(write.getPath()):
            last = part.getPath().getName()
            if "=" in last and f"data/{name}/{last}" not in named and part.getModificationTime() < oldest:
                fs.delete(part.getPath(), True)
                fs.delete(_path(spark, f"{root}/index/{name}/at={last.split('=', 1)[1]}"), True)
                gone += 1
    for n in numbers[:-keep]:
        fs.delete(_path(spark, _commit_path(root, n)), False)
    return gone
