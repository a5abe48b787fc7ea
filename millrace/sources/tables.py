"""Replacing tables as one step: rows are written once, beside the old ones, and one change of metadata shows them.

A table of the session catalog points to a versioned folder of its own; replacing it is writing the next folder and
pointing there. Until then every reader sees the old rows, and a failure at any time leaves them. Another catalog is
asked to create or replace the table itself, which is one step where the catalog stages. Several tables are published
together: all are written before any is pointed at, and one version record says which folders belong together.
"""

import json
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.sources.storage import normalize_names, read_parquet, stage, table_name

VERSION = re.compile("v-[0-9a-f]{32}")
RECORD = re.compile("([0-9]{12})[.]json")
RECORDS = "_published"
PARSED = ("csv", "json")  # formats whose reader hands on what it cannot parse
SESSION_CATALOG = "spark_catalog"

Name = str | Sequence[str]


class _Folder:
    """A folder in whatever store Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def children(self) -> dict[str, int]:
        """Names below the folder, and when each was written last."""
        if not self.files.exists(self._at(self.path)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.files.listStatus(self._at(self.path))}

    def delete(self, name: str) -> None:
        self.files.delete(self._at(f"{self.path}/{name}"), True)

    def read(self, name: str) -> str:
        """A small text file, whole."""
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0]

    def make(self) -> None:
        self.files.mkdirs(self._at(self.path))

    def create(self, name: str, text: str) -> None:
        """A file that appears whole; refuses one that is there."""
        target, part = self._at(f"{self.path}/{name}"), self._at(f"{self.path}/_{uuid4().hex}")
        out = self.files.create(part, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.files.exists(target) or not self.files.rename(part, target):
            self.files.delete(part, False)
            raise FileExistsError(f"{self.path}/{name} was written by another job")


class Pointed(NamedTuple):
    """What a table of the session catalog shows."""

    folder: str
    schema: StructType


def write_version(df: DataFrame, base: str) -> str:
    """Write the rows to a new folder below `base`; what was written is removed if that fails."""
    name = f"v-{uuid4().hex}"
    folder = f"{base.rstrip('/')}/{name}"
    try:
        df.write.parquet(folder)
    except BaseException:
        _Folder(df.sparkSession, base).delete(name)
        raise
    return folder


def _forget(spark: SparkSession, base: str, last: str | None) -> None:
    """Remove versions older than the one shown before. That one stays for readers that are at it, and what other jobs
    are writing is younger."""
    folder = _Folder(spark, base)
    written = {name: time for name, time in folder.children().items() if VERSION.fullmatch(name)}
    kept = (last or "").rstrip("/").rsplit("/", 1)[-1]
    for name, time in written.items():
        if kept in written and time < written[kept]:
            folder.delete(name)


def _parts(spark: SparkSession, table: Name) -> list[str]:
    """Catalog, the parts of its database, and the table."""
    parts = [table] if isinstance(table, str) else list(table)
    if len(parts) == 1:
        return [spark.catalog.currentCatalog(), spark.catalog.currentDatabase(), *parts]
    known = spark._jsparkSession.sessionState().catalogManager().isCatalogRegistered(parts[0])
    return parts if known and len(parts) > 2 else [spark.catalog.currentCatalog(), *parts]


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def shown(spark: SparkSession, table: Name) -> Pointed | None:
    """Where a table's rows are; None if there is no such table."""
    name = table_name(_parts(spark, table))
    if not spark.catalog.tableExists(name):
        return None
    return Pointed(_described(spark, name).get("Location", ""), spark.table(name).schema)


def _alike(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType.jsonValue()) for f in a] == [(f.name, f.dataType.jsonValue()) for f in b]


def point(spark: SparkSession, table: Name, to: Pointed) -> None:
    """Let a table show the rows of a folder of Parquet files.

    That is one change of metadata for a new table, or if the columns stay. With other columns a second table is
    made and takes the name; should that fail, the old one gets its name back.
    """
    parts = _parts(spark, table)
    name = table_name(parts)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=to.folder, source="parquet", schema=to.schema)
        return
    about = _described(spark, name)
    if about.get("Type") == "VIEW":
        raise ValueError(f"{name} is a view")
    plain = about.get("Provider", "").lower() == "parquet" and "# Partition Information" not in about
    if plain and _alike(spark.table(name).schema, to.schema):
        literal = to.folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{literal}'")
        spark.catalog.refreshTable(name)
        return
    mark = uuid4().hex
    # A new name is given without the catalog.
    place = parts[1:-1]
    new, old = (table_name([*place, f"{parts[-1]}_{label}_{mark}"]) for label in ("next", "last"))
    own = table_name([*place, parts[-1]])
    spark.catalog.createTable(new, path=to.folder, source="parquet", schema=to.schema)
    try:
        spark.sql(f"ALTER TABLE {own} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {own}")
        except BaseException:
            spark.sql(f"ALTER TABLE {old} RENAME TO {own}")
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {old}")


def _take_back(spark: SparkSession, table: Name, before: Pointed | None) -> None:
    """Let a table show what it showed before; drop it if there was none."""
    if before is not None:
        point(spark, table, before)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(_parts(spark, table))}")


def _base(spark: SparkSession, parts: Sequence[str]) -> str:
    """Where versions go that were given no path: in the database's folder."""
    database = spark.catalog.getDatabase(table_name(parts[:-1]))
    return f"{database.locationUri.rstrip('/')}/_versions/{parts[-1].lower()}"


def _stages(spark: SparkSession, catalog: str) -> bool:
    """Whether a catalog replaces a table as one step."""
    kind = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.connector.catalog.StagingTableCatalog")
    return kind.isInstance(spark._jsparkSession.sessionState().catalogManager().catalog(catalog))


def replace_table(df: DataFrame, table: Name, path: str | None = None) -> None:
    """Create or replace a table from a DataFrame, with its versions below `path` if given.

    `table` is the parts of its name. A frame may read the table that it replaces. The rows are written once; a
    failure before the last step leaves the old table as it was. Dropping the table leaves its files. In a catalog
    other than the session's that does not stage, the rows are computed into a staged copy first.
    """
    spark = df.sparkSession
    parts = _parts(spark, table)
    if parts[0] != SESSION_CATALOG:
        source = df if _stages(spark, parts[0]) else stage(df, "table")
        source.writeTo(table_name(parts)).createOrReplace()
        return
    base, before = path or _base(spark, parts), shown(spark, table)
    folder = write_version(df, base)
    try:
        point(spark, table, Pointed(folder, read_parquet(spark, folder, df.schema).schema))
    except BaseException:
        _Folder(spark, base).delete(folder.rsplit("/", 1)[-1])
        raise
    _forget(spark, base, before and before.folder)


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """The folder of each table in the last version that was published below `root`; empty if there is none."""
    records = sorted(name for name in _Folder(spark, f"{root}/{RECORDS}").children() if RECORD.fullmatch(name))
    if not records:
        return {}
    places = json.loads(_Folder(spark, f"{root}/{RECORDS}").read(records[-1]))
    return {name: f"{root}/{place}" for name, place in places.items()}


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the last version, which belong together whatever is published meanwhile."""
    return {name: read_parquet(spark, folder) for name, folder in published(spark, root).items()}


def publish_tables(frames: Mapping[str, DataFrame], database: Name, root: str | None = None) -> None:
    """Replace several tables together: write all, point each of the database's tables at its new rows, and set the
    version record below `root`, or in the database's folder.

    A failure while writing leaves everything as it was, one while pointing takes back the tables that were pointed
    already. Readers of the record never see a mixture, even if the job dies in between; `point_published` then
    makes the database's tables agree with the record. Catalogs other than the session's replace one table at a time.
    """
    spark = next(iter(frames.values())).sparkSession
    parts = [database] if isinstance(database, str) else list(database)
    whole = _parts(spark, [*parts, ""])
    if whole[0] != SESSION_CATALOG:
        for name, df in frames.items():
            replace_table(df, [*parts, name])
        return
    root = (root or f"{spark.catalog.getDatabase(table_name(whole[:-1])).locationUri}/_together").rstrip("/")
    number = max([int(m[1]) for m in map(RECORD.fullmatch, _Folder(spark, f"{root}/{RECORDS}").children()) if m], default=0)
    before = {name: shown(spark, [*parts, name]) for name in frames}
    written: dict[str, Pointed] = {}
    pointed: list[str] = []
    try:
        for name, df in frames.items():
            folder = write_version(df, f"{root}/{name}")
            written[name] = Pointed(folder, read_parquet(spark, folder, df.schema).schema)
        for name, new in written.items():
            pointed.append(name)
            point(spark, [*parts, name], new)
        places = {name: new.folder.removeprefix(f"{root}/") for name, new in written.items()}
        _Folder(spark, f"{root}/{RECORDS}").create(f"{number + 1:012}.json", json.dumps(places))
    except BaseException:
        for name in pointed:
            _take_back(spark, [*parts, name], before[name])
        for name, new in written.items():
            _Folder(spark, f"{root}/{name}").delete(new.folder.rsplit("/", 1)[-1])
        raise
    for name, old in before.items():
        _forget(spark, f"{root}/{name}", old and old.folder)


def point_published(spark: SparkSession, database: Name, root: str) -> None:
    """Point the database's tables at the last version that was published below `root`."""
    parts = [database] if isinstance(database, str) else list(database)
    for name, folder in published(spark, root).items():
        point(spark, [*parts, name], Pointed(folder, read_parquet(spark, folder).schema))


def land_raw(
    spark: SparkSession,
    fmt: str,
    table: Name,
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
    path: str | None = None,
    rejects: Name | None = None,
) -> DataFrame:
    """Copy an external source whole into the raw table and return that table.

    With `rejects`, for CSV and JSON and a given schema, records that do not fit go to a table of that name, as they
    stand in the source (`record`) and with what is wrong (`reason`). The source is parsed and its rows are written
    once, for both tables together.
    """
    if rejects is not None:
        return _land_with_rejects(spark, fmt, table, dict(options or {}), schema, path, rejects)
    reader = spark.read.format(fmt).options(**(options or {}))
    source = (reader if schema is None else reader.schema(schema)).load()
    replace_table(normalize_names(source), table, path)
    return spark.table(table_name(table))


def _fresh(name: str, taken: set[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _land_with_rejects(
    spark: SparkSession, fmt: str, table: Name, options: dict[str, str], schema: StructType | str | None,
    path: str | None, rejects: Name,
) -> DataFrame:
    if fmt not in PARSED or schema is None:
        raise ValueError(f"rejects need a schema and one of the formats {', '.join(PARSED)}")
    if any(name.lower() in ("mode", "columnnameofcorruptrecord") for name in options):
        raise ValueError("rejects set the reader's mode and its column for bad records")
    if _parts(spark, table)[0] != SESSION_CATALOG or _parts(spark, rejects)[0] != SESSION_CATALOG:
        raise ValueError("rejects are landed in the session catalog")
    wanted = spark.createDataFrame([], schema).schema
    good = normalize_names(spark.createDataFrame([], wanted)).schema
    taken = {name.lower() for name in (*wanted.names, *good.names)}
    bad, why, clash = (_fresh(name, taken) for name in ("record", "reason", "rejected"))
    whole = StructType([*wanted.fields, StructField(bad, StringType())])
    given = options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = spark.read.format(fmt).options(**given).schema(whole).load()
    quoted = lambda name: F.col(f"`{name.replace('`', '``')}`")
    if fmt == "csv":
        texts = ", ".join(f"c{i} string" for i in range(len(wanted)))
        again = F.from_csv(bad, texts, {name: value for name, value in options.items() if name.lower() != "path"})
        value = lambda i, name: again[f"c{i}"]
    else:
        value = lambda i, name: F.try_variant_get(F.try_parse_json(bad), f"$[{json.dumps(name)}]", "string")
    # What is there as text but not as a value was refused.
    wrong = [F.when(value(i, f.name).isNotNull() & quoted(f.name).isNull(), F.lit(f.name)) for i, f in enumerate(wanted)]
    names = F.array_compact(F.array(*wrong))
    reason = F.when(F.size(names) > 0, F.concat(F.lit("cannot read "), F.array_join(names, ", "))).otherwise("malformed record")
    marked = parsed.withColumn(why, F.when(F.col(bad).isNotNull(), reason)).toDF(*good.names, bad, why)
    parts = _parts(spark, table)
    base = path or _base(spark, parts)
    folder = f"{base.rstrip('/')}/v-{uuid4().hex}"
    before, before_rejects = shown(spark, table), shown(spark, rejects)
    told = StructType([StructField(bad, StringType()), StructField(why, StringType())])
    try:
        marked.withColumn(clash, F.col(bad).isNotNull()).write.partitionBy(clash).parquet(folder)
        places = [f"{folder}/{clash}={'true' if is_bad else 'false'}" for is_bad in (False, True)]
        for place in places:
            _Folder(spark, place).make()
        point(spark, table, Pointed(places[0], good))
        try:
            point(spark, rejects, Pointed(places[1], told))
        except BaseException:
            _take_back(spark, table, before)
            raise
    except BaseException:
        _Folder(spark, base).delete(folder.rsplit("/", 1)[-1])
        raise
    for old in (before, before_rejects):
        _forget(spark, base, old and old.folder.rsplit("/", 1)[0])
    return spark.table(table_name(table))
