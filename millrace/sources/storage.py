"""Reading and writing. Jobs touch storage only through these functions."""

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_JOB: ContextVar[str] = ContextVar("job", default="")


def staging_folder(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names, or one in the warehouse, which is shared as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, below the folder of the running `staged_job` if there is one."""
    return f"{staging_folder(spark)}/{_JOB.get()}{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once, read back: cuts the lineage and keeps columns prunable for every later reader."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def discard(spark: SparkSession, path: str) -> None:
    """Remove staged files; refuses anything outside the staging folder."""
    if not path.startswith(f"{staging_folder(spark)}/"):
        raise ValueError(f"{path} was not staged")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged_job(spark: SparkSession) -> Iterator[None]:
    """What is staged within is removed at the end, so results must have been written by then."""
    name = f"job-{uuid4().hex}"
    outer = _JOB.set(f"{_JOB.get()}{name}/")
    try:
        yield
    finally:
        folder = f"{staging_folder(spark)}/{_JOB.get()}"
        _JOB.reset(outer)
        discard(spark, folder)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_parquet_widened(spark: SparkSession, path: str, threads: int = 32) -> DataFrame:
    """Scan a folder whose files differ in columns or types, such as a number that is bigint in one month and double in
    the next; Spark's own scan takes one file's types for all, or refuses to merge them.

    Files of one footer are one scan, so columns and partitions are pruned and filters pushed down within it. Columns take the widest
    type: of numbers as Spark widens them, text where one is text; a column that files lack is null there. Integers
    beyond 2^53 are not exact as doubles. One footer a file is read here, several at a time.
    """
    groups: dict[str, list[str]] = {}
    hadoop = spark._jsc.hadoopConfiguration()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(hadoop)
    found, names = files.listFiles(root, True), []
    while found.hasNext():
        name = found.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name.removeprefix(files.makeQualified(root).toString()).split("/")):
            names.append(name)
    if not names:
        raise FileNotFoundError(f"no files below {path}")

    def footer(name: str) -> str:
        return spark.read.parquet(name).schema.json()

    with ThreadPoolExecutor(threads) as pool:
        for name, kind in zip(sorted(names), pool.map(footer, sorted(names))):
            groups.setdefault(kind, []).append(name)
    reader = spark.read if files.getFileStatus(root).isFile() else spark.read.option("basePath", path)
    frames = [reader.schema(StructType.fromJson(json.loads(kind))).parquet(*own) for kind, own in groups.items()]
    texts = {f.name for df in frames for f in df.schema if isinstance(f.dataType, StringType)}
    quoted = lambda name: F.col(f"`{name.replace('`', '``')}`")
    alike = [
        df.select(*[quoted(n).cast("string").alias(n) if n in texts else quoted(n) for n in df.columns]) for df in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)


def _location(spark: SparkSession, path: object) -> tuple[str, str, str]:
    """Scheme, authority and path, as the path's own file system completes them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getScheme(), uri.getAuthority() or "", uri.getPath().rstrip("/") + "/"


def _class_of(java_object: object) -> str:
    return java_object.getClass().getSimpleName()


def _items(sequence: object) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


# What an RDD is called that reads files whose place cannot be asked for.
FILE_RDDS = ("FileScanRDD", "HadoopRDD", "NewHadoopRDD", "BinaryFileRDD", "WholeTextFileRDD", "DataSourceRDD")


def _rdd_roots(rdd: object) -> list[str]:
    """Checkpoint folders that an RDD goes back to; refuses one that goes back to other files."""
    found, pending, seen = [], [rdd], set()
    while pending:
        rdd = pending.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        if _class_of(rdd) in FILE_RDDS:
            raise ValueError("cannot tell which files a frame made from an RDD reads; stage it first")
        if rdd.getCheckpointFile().isDefined():
            found.append(rdd.getCheckpointFile().get())
        pending += [dependency.rdd() for dependency in _items(rdd.dependencies())]
    return found


def _plan_roots(plan: object) -> list[str]:
    """The folders that the scans of a plan start from; a handful, however many files they hold."""
    found = []
    for leaf in [leaf for part in [plan, *_items(plan.subqueriesAll())] for leaf in _items(part.collectLeaves())]:
        kind = _class_of(leaf)
        if kind == "InMemoryRelation":
            # What is cached may be dropped and read again.
            found += _plan_roots(leaf.cacheBuilder().logicalPlan())
        elif kind == "LogicalRelation" and _class_of(leaf.relation()) == "HadoopFsRelation":
            found += [path.toString() for path in _items(leaf.relation().location().rootPaths())]
        elif kind in ("DataSourceV2ScanRelation", "DataSourceV2Relation"):
            relation = leaf.relation() if kind == "DataSourceV2ScanRelation" else leaf
            try:
                found += [path.toString() for path in _items(relation.table().fileIndex().rootPaths())]
            except Py4JError:  # not a table of files; a connector may have been given a path
                found += filter(None, [relation.options().get("path")])
        elif kind == "HiveTableRelation":
            found.append(leaf.tableMeta().location().toString())
        elif kind in ("LogicalRDD", "ExternalRDD"):
            found += _rdd_roots(leaf.rdd())
    return found


def _roots(df: DataFrame) -> list[str]:
    return _plan_roots(df._jdf.queryExecution().optimizedPlan())


def _refuse_own_input(df: DataFrame, path: str) -> None:
    """Spark would delete files below `path` first and then fail to read them. Frames that are cached, checkpointed or
    read through a connector are seen through; one made from an RDD over files is refused."""
    spark = df.sparkSession
    *target_store, target = _location(spark, path)
    for root in _roots(df):
        *store, folder = _location(spark, root)
        if store == target_store and (folder.startswith(target) or target.startswith(folder)):
            raise ValueError(f"cannot overwrite {path}, which the data is read from; stage it first")


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace what is at `path`, unless `df` itself reads from there."""
    _refuse_own_input(df, path)
    df.write.mode("overwrite").parquet(path)


def write_connector(df: DataFrame, fmt: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Replace a warehouse table through a connector that takes the target as `dbtable`."""
    if not table:
        raise ValueError("a connector write needs a target table")
    for name, value in (options or {}).items():
        if name.lower() == "path":  # options ignore case
            _refuse_own_input(df, value)
    df.write.format(fmt).options(**(options or {}), dbtable=table).mode("overwrite").save()


def table_name(parts: str | Sequence[str]) -> str:
    """A table's name from its parts, each quoted; a single text is one part."""
    parts = [parts] if isinstance(parts, str) else parts
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts)


def read_table(spark: SparkSession, *parts: str) -> DataFrame:
    """Scan a named table; each part of the name is quoted."""
    return spark.table(table_name(parts))


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for every run of other characters."""
    names = [re.sub(r"\W+", "_", name.strip()).lower() for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide once normalized: {df.columns}")
    return df.toDF(*names)
