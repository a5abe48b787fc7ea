"""A warehouse connector for tests: tasks hand in what they wrote, and one step at the end shows it under the table's name."""

import json
import os
from dataclasses import dataclass
from pathlib import Path
from uuid import uuid4

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class Writer(DataSourceWriter):
    def __init__(self, options, schema, overwrite):
        self.root, self.table, self.overwrite = options["root"], options["dbtable"], overwrite
        self.columns, self.fail_from = schema.names, int(options.get("failfrom", -1))

    def write(self, rows):
        name, count = f"{uuid4().hex}.jsonl", 0
        with open(Path(self.root) / name, "w") as file:
            for row in rows:
                if self.fail_from >= 0 and TaskContext.get().partitionId() >= self.fail_from:
                    raise RuntimeError("the connection was lost")
                file.write(json.dumps(dict(zip(self.columns, row)), default=str) + "\n")
                count += 1
        return Written(name, count)

    def commit(self, messages):
        target = Path(self.root) / f"{self.table}.table"
        old = [] if self.overwrite or not target.exists() else json.loads(target.read_text())["files"]
        files = [m.file for m in messages if m is not None]
        part = target.with_suffix(f".{uuid4().hex}")
        part.write_text(json.dumps({"files": old + files, "rows": sum(m.rows for m in messages if m is not None)}))
        os.replace(part, target)

    def abort(self, messages):
        for message in messages:
            if message is not None:
                (Path(self.root) / message.file).unlink(missing_ok=True)


class Warehouse(DataSource):
    @classmethod
    def name(cls):
        return "test_warehouse"

    def writer(self, schema, overwrite):
        return Writer(self.options, schema, overwrite)


def rows_of(root, table):
    """What the warehouse shows under a name."""
    target = Path(root) / f"{table}.table"
    if not target.exists():
        return None
    files = json.loads(target.read_text())["files"]
    return [json.loads(line) for name in files for line in (Path(root) / name).read_text().splitlines()]
