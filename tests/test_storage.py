from pathlib import Path

import connector
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace import sources
from millrace.sources import storage as module
from millrace.sources import tables


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, None)], "`ORDER ID` int, `ITEM TYPE` string")


def test_parquet_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    sources.write_parquet(rows, path)
    sources.write_parquet(rows.limit(1), path)
    assert sources.read_parquet(spark, path).count() == 1


def test_overwriting_the_own_input_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "out put")
    sources.write_parquet(rows, path)
    own = sources.read_parquet(spark, path)
    for target in (f"file://{path}/", f"{path}/part", str(tmp_path)):
        with pytest.raises(ValueError, match="cannot overwrite"):
            sources.write_parquet(own.where("`ORDER ID` > 1"), target)
    with pytest.raises(ValueError, match="cannot overwrite"):
        sources.write_connector(own.limit(1), "parquet", "t", {"path": path})
    assert own.count() == 2
    sources.write_parquet(sources.stage(own), path)
    sources.write_parquet(sources.read_parquet(spark, path), f"{path}2")


def test_no_file_list_is_fetched(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "in")
    rows.repartition(2).write.parquet(path)
    monkeypatch.setattr(type(rows), "inputFiles", lambda self: pytest.fail("lists files"))
    sources.write_parquet(sources.read_parquet(spark, path), str(tmp_path / "out"))


def test_equal_paths_in_two_stores_differ(spark, tmp_path):
    assert module._location(spark, f"file://{tmp_path}/a")[2] == f"{tmp_path}/a/"
    assert module._location(spark, str(tmp_path)) == module._location(spark, f"file:{tmp_path}/")


FAILING = "CASE WHEN `ORDER ID` > 1 THEN raise_error('broken') ELSE `ITEM TYPE` END AS t"


@pytest.mark.parametrize("external", [False, True])
def test_a_failing_rebuild_leaves_the_old_table(spark, rows, tmp_path, external):
    path = str(tmp_path / "ext") if external else None
    name = f"kept_{external}"
    sources.replace_table(rows, name, path)
    with pytest.raises(Exception, match="broken"):
        sources.replace_table(rows.selectExpr("`ORDER ID`", FAILING), name, path)
    assert sorted(spark.table(name).collect(), key=str) == sorted(rows.collect(), key=str)
    sources.replace_table(rows.limit(1), name, path)
    assert spark.table(name).count() == 1


def test_a_table_can_be_rebuilt_from_itself(spark, rows):
    sources.replace_table(rows, "own")
    sources.replace_table(spark.table("own").where("`ORDER ID` = 1"), "own")
    assert [row[0] for row in spark.table("own").collect()] == [1]


def test_table_names_are_quoted_by_parts(spark, rows):
    assert sources.table_name(["a b", "c`d"]) == "`a b`.`c``d`"
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    sources.replace_table(rows, ["spark_catalog", "parts", "t"])
    assert sources.read_table(spark, "spark_catalog", "parts", "t").count() == 2
    with pytest.raises(Exception, match="a b"):  # the built-in catalog refuses the name, not the parser
        sources.replace_table(rows, ["spark_catalog", "parts", "a b"])


def test_staged_files_of_a_job_go_with_it(spark, rows):
    with sources.staged_job(spark):
        staged = sources.stage(rows)
        folder = Path(staged.inputFiles()[0].removeprefix("file://")).parents[1]
        assert folder.exists()
    assert not folder.exists()
    kept = sources.stage(rows)
    assert kept.count() == 2
    with pytest.raises(ValueError, match="was not staged"):
        sources.discard(spark, "/elsewhere")


class Recorder:
    """Stands for a frame and its writer; notes what it is asked for."""

    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def save(self):
        self.calls["saved"] = True


def test_connector_writes_name_their_target():
    frames = {name: Recorder() for name in ("trips", "a b.payments")}
    for name, frame in frames.items():
        sources.write_connector(frame, "warehouse", name, {"user": "u"})
    for name, frame in frames.items():
        assert frame.calls == {
            "format": "warehouse", "options": {"user": "u", "dbtable": name}, "mode": "overwrite", "saved": True,
        }


def test_stage_keeps_schema_and_goes_to_the_shared_folder(spark, rows):
    staged = sources.stage(rows, "here")
    assert staged.dtypes == rows.dtypes
    assert sorted(staged.collect()) == sorted(rows.collect())
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(f"{folder}/here-" in path for path in staged.inputFiles())


def test_staging_paths_differ(spark):
    assert sources.staging_path(spark, "x") != sources.staging_path(spark, "x")


class Settings:
    """Stands for a session with the given settings."""

    def __init__(self, **values):
        self.conf = self
        self.values = {key.replace("__", "."): value for key, value in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_staging_goes_to_a_shared_folder():
    settings = {"spark__sql__warehouse__dir": "hdfs://w/"}
    assert sources.staging_path(Settings(**settings), "x").startswith("hdfs://w/_staged/x-")
    assert sources.staging_path(Settings(spark__checkpoint__dir="s3a://b/c/", **settings), "x").startswith("s3a://b/c/x-")


def test_table_is_created_and_replaced(spark, rows):
    sources.replace_table(rows, "replaced")
    sources.replace_table(rows.select("ITEM TYPE"), "replaced")
    assert spark.table("replaced").columns == ["ITEM TYPE"]
    found = sources.read_table(spark, "spark_catalog", "default", "replaced")
    assert sorted(found.collect(), key=str) == sorted(rows.select("ITEM TYPE").collect(), key=str)


def test_connector_write_passes_table_and_options(spark, rows, tmp_path):
    path = str(tmp_path / "target")
    for df in (rows, rows.limit(1)):
        sources.write_connector(df.withColumnRenamed("ORDER ID", "id"), "json", "t", {"path": path})
    assert spark.read.json(path).count() == 1
    with pytest.raises(ValueError, match="table"):
        sources.write_connector(rows, "json", "", {"path": path})


def test_names_are_normalized(spark, rows):
    assert sources.normalize_names(rows).columns == ["order_id", "item_type"]
    with pytest.raises(ValueError, match="collide"):
        sources.normalize_names(rows.withColumn("item_type", F.lit(1)).toDF("a", "B b", "b_B"))


def test_raw_landing_replaces_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    rows.write.option("header", True).csv(path)
    options = {"path": path, "header": "true"}
    sources.land_raw(spark, "csv", "landed", options)
    landed = sources.land_raw(spark, "csv", "landed", options, rows.schema)
    assert landed.dtypes == [("order_id", "int"), ("item_type", "string")]
    assert sorted(landed.collect()) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("external", [False, True])
def test_a_failure_in_the_last_step_leaves_the_old_table(spark, rows, tmp_path, monkeypatch, external):
    """Pointing fails, with equal columns and with others; what was written goes, the old rows stay."""
    name, path = f"last_{external}", str(tmp_path / "ext") if external else None
    sources.replace_table(rows, name, path)
    before = tables.shown(spark, name)
    sql = type(spark).sql

    def failing(word):
        def run(self, text, *args, **options):
            if word in text:
                raise RuntimeError("metadata store is gone")
            return sql(self, text, *args, **options)

        return run

    for word, df in (("SET LOCATION", rows.limit(1)), ("RENAME TO `default`.`last", rows.select("ITEM TYPE"))):
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", failing(word))
            with pytest.raises(RuntimeError, match="gone"):
                sources.replace_table(df, name, path)
        assert tables.shown(spark, name) == before
        assert sorted(spark.table(name).collect(), key=str) == sorted(rows.collect(), key=str)
    assert len(tables._Folder(spark, before.folder.rsplit("/", 1)[0]).children()) == 1


def test_the_second_rename_is_taken_back(spark, rows, monkeypatch):
    sources.replace_table(rows, "renamed")
    sql = type(spark).sql

    def run(self, text, *args, **options):
        if "_next_" in text and "RENAME" in text:
            raise RuntimeError("gone")
        return sql(self, text, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", run)
        with pytest.raises(RuntimeError, match="gone"):
            sources.replace_table(rows.select("ITEM TYPE"), "renamed")
    assert spark.table("renamed").columns == ["ORDER ID", "ITEM TYPE"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("renamed_")]


def test_rows_are_written_once_and_old_versions_go(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    written = []
    write = tables.write_version
    monkeypatch.setattr(tables, "write_version", lambda df, base: written.append(base) or write(df, base))
    monkeypatch.setattr(tables, "stage", lambda *_: pytest.fail("writes the rows twice"))
    for n in (1, 2, 1, 2):
        sources.replace_table(rows.limit(n), "versions", path)
        assert spark.table("versions").count() == n
    assert written == [path] * 4
    assert len(list(Path(path).glob("v-*"))) == 2


def test_a_reader_of_the_old_version_goes_on(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sources.replace_table(rows, "read", path)
    old = spark.table("read")
    assert old.count() == 2
    sources.replace_table(rows.limit(1), "read", path)
    assert old.count() == 2 and spark.table("read").count() == 1


def test_tables_of_other_forms_are_replaced(spark, rows):
    """A managed table, a partitioned one and one in another format; a view is refused."""
    rows.toDF("a", "b").write.saveAsTable("managed")
    rows.toDF("a", "b").write.partitionBy("b").saveAsTable("partitioned")
    rows.toDF("a", "b").write.format("json").saveAsTable("other_format")
    for name in ("managed", "partitioned", "other_format"):
        sources.replace_table(rows.toDF("a", "b").limit(1), name)
        assert spark.table(name).count() == 1
    spark.sql("CREATE OR REPLACE VIEW a_view AS SELECT 1 AS a")
    with pytest.raises(ValueError, match="is a view"):
        sources.replace_table(rows, "a_view")
    assert spark.table("a_view").count() == 1


class Catalog:
    """Stands for a frame whose table is in another catalog."""

    def __init__(self, spark):
        self.sparkSession, self.calls = spark, []

    def writeTo(self, name):
        self.calls.append(name)
        return self

    def createOrReplace(self):
        self.calls.append("created")


@pytest.mark.parametrize("stages", [True, False])
def test_another_catalog_replaces_its_own_tables(spark, monkeypatch, stages):
    frame = Catalog(spark)
    monkeypatch.setattr(tables, "_parts", lambda spark, table: list(table))
    monkeypatch.setattr(tables, "_stages", lambda spark, catalog: stages)
    monkeypatch.setattr(tables, "stage", lambda df, label: df.calls.append("staged") or df)
    sources.replace_table(frame, ["lake", "db", "t"])
    assert frame.calls == ([] if stages else ["staged"]) + ["`lake`.`db`.`t`", "created"]


def test_the_session_catalog_does_not_stage(spark):
    assert not tables._stages(spark, "spark_catalog")


@pytest.fixture
def pair(spark, rows, tmp_path):
    """Two tables published together, each with rows that say so."""
    database = f"pair_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database}")
    root = str(tmp_path / "pair")
    frames = lambda version: {n: rows.withColumn("v", F.lit(version)) for n in ("one", "two")}
    sources.publish_tables(frames(1), database, root)
    return database, root, frames


def versions(spark, database, root):
    by_name = [spark.table(f"{database}.{n}").first()["v"] for n in ("one", "two")]
    by_record = [df.first()["v"] for df in sources.read_published(spark, root).values()]
    return by_name, by_record


def test_tables_are_published_together(spark, pair):
    database, root, frames = pair
    assert versions(spark, database, root) == ([1, 1], [1, 1])
    kept = sources.read_published(spark, root)
    sources.publish_tables(frames(2), database, root)
    assert versions(spark, database, root) == ([2, 2], [2, 2])
    assert [df.first()["v"] for df in kept.values()] == [1, 1]


def test_a_failure_while_writing_publishes_nothing(spark, rows, pair):
    database, root, frames = pair
    with pytest.raises(Exception, match="broken"):
        sources.publish_tables({"one": frames(2)["one"], "two": rows.selectExpr("`ORDER ID`", FAILING)}, database, root)
    assert versions(spark, database, root) == ([1, 1], [1, 1])
    assert all(len(list(Path(root, n).glob("v-*"))) == 1 for n in ("one", "two"))


@pytest.mark.parametrize("step", ["one", "two", "record"])
def test_a_failure_while_pointing_is_taken_back(spark, rows, pair, monkeypatch, step):
    database, root, frames = pair
    point, create = tables.point, tables._Folder.create
    fail = lambda: (_ for _ in ()).throw(RuntimeError("gone"))
    failed = []

    def pointing(spark, table, to):
        point(spark, table, to)
        if table[-1] == step and not failed:
            failed.append(step)
            fail()

    with monkeypatch.context() as patch:
        patch.setattr(tables, "point", pointing)
        patch.setattr(tables._Folder, "create", lambda *a: fail() if step == "record" else create(*a))
        with pytest.raises(RuntimeError, match="gone"):
            sources.publish_tables(frames(2) | {"three": rows}, database, root)
    assert versions(spark, database, root) == ([1, 1], [1, 1])
    assert not spark.catalog.tableExists(f"{database}.three")


def test_a_job_that_died_while_pointing_is_put_right(spark, rows, pair, tmp_path):
    database, root, frames = pair
    folder = tables.write_version(frames(2)["one"], f"{root}/one")
    tables.point(spark, [database, "one"], tables.Pointed(folder, spark.read.parquet(folder).schema))
    assert versions(spark, database, root) == ([2, 1], [1, 1])
    sources.point_published(spark, database, root)
    assert versions(spark, database, root) == ([1, 1], [1, 1])


def test_two_publishers_do_not_share_a_record(spark, pair):
    _, root, _ = pair
    records = tables._Folder(spark, f"{root}/_published")
    assert list(records.children()) and all(n.endswith("1.json") for n in records.children() if not n.startswith("."))
    with pytest.raises(FileExistsError):
        records.create("000000000001.json", "{}")
    assert len(sources.published(spark, root)) == 2


def test_cached_frames_do_not_hide_their_input(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    sources.write_parquet(rows, path)
    cached = sources.read_parquet(spark, path).where("`ORDER ID` > 1").cache()
    twice = cached.withColumn("more", F.lit(1)).cache()
    try:
        for df in (cached, cached.limit(1), twice, twice.where("more = 1")):
            with pytest.raises(ValueError, match="cannot overwrite"):
                sources.write_parquet(df, path)
    finally:
        twice.unpersist(), cached.unpersist()
    assert spark.read.parquet(path).count() == 2


def test_option_names_ignore_case(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    sources.write_parquet(rows, path)
    own = sources.read_parquet(spark, path)
    for key in ("PATH", "Path", "path"):
        with pytest.raises(ValueError, match="cannot overwrite"):
            sources.write_connector(own, "parquet", "t", {key: path})
    assert own.count() == 2


def test_other_scans_are_seen_through(spark, rows, tmp_path):
    """Scans of the newer connector interface, subqueries, checkpoints; frames made from RDDs over files are refused."""
    path = str(tmp_path / "in")
    sources.write_parquet(rows, path)
    own = sources.read_parquet(spark, path)
    own.createOrReplaceTempView("own_rows")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    try:
        newer = spark.read.parquet(path)
        assert "BatchScan" in newer._jdf.queryExecution().executedPlan().toString()
        with pytest.raises(ValueError, match="cannot overwrite"):
            sources.write_parquet(newer.limit(1), path)
    finally:
        spark.conf.unset("spark.sql.sources.useV1SourceList")
    scalar = rows.where(F.col("ORDER ID") == spark.sql("SELECT 1").first()[0]).selectExpr("*")
    scalar.createOrReplaceTempView("others")
    with pytest.raises(ValueError, match="cannot overwrite"):
        sources.write_parquet(spark.sql("SELECT * FROM others WHERE `ORDER ID` < (SELECT max(`ORDER ID`) FROM own_rows)"), path)
    with pytest.raises(ValueError, match="cannot tell"):
        sources.write_parquet(spark.createDataFrame(own.rdd, own.schema), path)
    assert own.count() == 2
    sources.write_parquet(rows.limit(1), path)


def test_a_checkpoint_folder_is_not_overwritten(spark, rows, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "points"))
    saved = rows.checkpoint()
    (point,) = set(module._roots(saved))
    with pytest.raises(ValueError, match="cannot overwrite"):
        sources.write_parquet(saved, point)
    assert saved.count() == 2


@pytest.fixture
def warehouse(spark, tmp_path):
    cloudpickle.register_pickle_by_value(connector)  # workers do not see the tests' folder
    spark.dataSource.register(connector.Warehouse)
    root = tmp_path / "warehouse"
    root.mkdir()
    return str(root)


def test_a_connector_shows_a_table_when_all_tasks_are_done(spark, rows, warehouse):
    df = rows.toDF("id", "item").repartition(3)
    for name, frame in (("trips", df), ("payments", df.limit(1)), ("trips", df.withColumn("id", F.col("id") * 10))):
        sources.write_connector(frame, "test_warehouse", name, {"root": warehouse})
    assert sorted(r["id"] for r in connector.rows_of(warehouse, "trips")) == [10, 20]
    assert len(connector.rows_of(warehouse, "payments")) == 1
    assert connector.rows_of(warehouse, "others") is None


def test_a_failing_task_leaves_the_connectors_table(spark, warehouse):
    df = spark.range(100).repartition(4)
    sources.write_connector(df, "test_warehouse", "t", {"root": warehouse})
    with pytest.raises(Exception, match="connection was lost"):
        sources.write_connector(df.withColumn("id", -F.col("id") - 1), "test_warehouse", "t", {"root": warehouse, "failfrom": "2"})
    assert sorted(r["id"] for r in connector.rows_of(warehouse, "t")) == list(range(100))


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_records_that_do_not_fit_are_kept(spark, tmp_path, fmt):
    texts = {
        "csv": ["ORDER ID,Ship Date,units", "1,2024-01-02,5", "x,2024-01-03,6", "3,soon,many", "4,2024-01-05", '5,"2024-01-06",7', "6,,", "7,2024-01-07,1,2"],
        "json": [
            '{"ORDER ID": 1, "Ship Date": "2024-01-02", "units": 5}', '{"ORDER ID": "x", "Ship Date": "2024-01-03", "units": 6}',
            '{"ORDER ID": 3, "Ship Date": "soon", "units": "many"}', '{"ORDER ID": 4,', '{"ORDER ID": 5, "Ship Date": "2024-01-06", "units": 7}', '{"ORDER ID": 6}',
        ],
    }
    source = tmp_path / "in"
    source.write_text("\n".join(texts[fmt]) + "\n")
    schema = "`ORDER ID` int, `Ship Date` date, units int"
    options = {"path": str(source)} | ({"header": "true"} if fmt == "csv" else {})
    path = str(tmp_path / "landed")
    for _ in range(3):
        landed = sources.land_raw(spark, fmt, f"good_{fmt}", options, schema, path, rejects=f"bad_{fmt}")
    records = texts[fmt][fmt == "csv" :]
    bad = {r.record: r.reason for r in spark.table(f"bad_{fmt}").collect()}
    assert landed.columns == ["order_id", "ship_date", "units"]
    assert landed.count() + len(bad) == len(records)
    assert set(bad) <= set(records)
    assert bad[records[1]] == "cannot read ORDER ID"
    assert bad[records[2]] == "cannot read Ship Date, units"
    assert {r.order_id for r in landed.collect()} == {1, 5, 6}
    assert bad[records[3]] == "malformed record"
    assert len(list(Path(path).glob("v-*"))) == 2


def test_landing_without_bad_records_has_an_empty_table_of_them(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    rows.toDF("id", "record").write.json(source)
    landed = sources.land_raw(spark, "json", "all_good", {"path": source}, "id int, record string", rejects="none_bad")
    assert landed.columns == ["id", "record"] and landed.count() == 2
    assert spark.table("none_bad").count() == 0 and spark.table("none_bad").columns == ["record_", "reason"]
    with pytest.raises(ValueError, match="need a schema"):
        sources.land_raw(spark, "parquet", "x", {"path": source}, "id int", rejects="y")


def test_stages_go_on_where_they_stopped(spark, tmp_path):
    ran, folder = [], str(tmp_path / "marks")

    def stages(broken=False, source="a"):
        def load():
            ran.append("load")
            if broken:
                raise RuntimeError("no connection")

        return {"extract": (lambda: ran.append("extract"), {"source": source}), "load": (load, {}), "tell": (lambda: ran.append("tell"), {})}

    with pytest.raises(RuntimeError, match="no connection"):
        sources.run_stages(spark, folder, "day 1", stages(broken=True))
    assert sources.run_stages(spark, folder, "day 1", stages()) == ["load", "tell"]
    assert ran == ["extract", "load", "load", "tell"]
    assert sources.run_stages(spark, folder, "day 1", stages()) == []
    with pytest.raises(ValueError, match="was done with"):
        sources.run_stages(spark, folder, "day 1", stages(source="b"))
    assert sources.run_stages(spark, folder, "day 2", stages(source="b")) == ["extract", "load", "tell"]
    with pytest.raises(ValueError, match="no name"):
        sources.run_stages(spark, folder, "a/b", stages())


def test_files_of_different_types_scan_as_the_widest(spark, tmp_path, plan_of):
    path = str(tmp_path / "months")
    spark.sql("SELECT 2L AS passengers, 1.5F AS miles, 7 AS code, 'n' AS flag").write.parquet(f"{path}/m=1")
    spark.sql("SELECT 3.5D AS passengers, 2.25D AS miles, 'x7' AS code, 'y' AS flag").write.parquet(f"{path}/m=2")
    spark.sql("SELECT NULL::int AS passengers, 1D AS miles, 8 AS code, DATE'2024-01-01' AS day").write.parquet(f"{path}/m=3")
    spark.sql("SELECT 2L AS passengers, 1.5F AS miles, 9 AS code, 'n' AS flag").write.parquet(f"{path}/m=4")
    with pytest.raises(Exception):  # noqa: B017 - whichever way Spark puts it
        spark.read.option("mergeSchema", "true").parquet(path).collect()
    df = sources.read_parquet_widened(spark, path)
    assert dict(df.dtypes) == {"passengers": "double", "miles": "double", "code": "string", "flag": "string", "day": "date", "m": "int"}
    got = sorted((r.code, r.passengers, r.miles, r.flag) for r in df.collect())
    assert got == [("7", 2.0, 1.5, "n"), ("8", None, 1.0, None), ("9", 2.0, 1.5, "n"), ("x7", 3.5, 2.25, "y")]
    plan = plan_of(df.where("flag = 'n'").select("miles"))
    assert plan.count("FileScan") <= 3 and "passengers" not in plan and "EqualTo(flag,n)" in plan
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        sources.read_parquet_widened(spark, str(tmp_path / "empty"))
