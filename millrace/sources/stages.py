"""Jobs of several stages that go on where a failed run stopped.

A run is known by a name that its caller gives, such as the day it is for. Every stage that ends leaves a mark in the run's
folder in the shared store, with what it was given; a later run of the same name skips the stages that are marked.
"""

import json
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from millrace.sources.tables import _Folder


def run_stages(
    spark: SparkSession, folder: str, run: str, stages: Mapping[str, tuple[Callable[[], object], Mapping[str, object]]]
) -> list[str]:
    """Run the stages in order and return the names of those that ran. `stages`: a function, and what it is given.

    A stage must replace what it writes, as it may have written some of it when it failed. A mark of the same run with
    other input is an error, as is one behind a stage that is not marked.
    """
    if not run or "/" in run:
        raise ValueError(f"{run!r} is no name for a run")
    marks = _Folder(spark, f"{folder.rstrip('/')}/{run}")
    done = {name: marks.read(f"{name}.json") for name in stages if f"{name}.json" in marks.children()}
    given = {name: json.dumps(dict(about), sort_keys=True, default=str) for name, (_, about) in stages.items()}
    for name, text in done.items():
        if text != given[name]:
            raise ValueError(f"stage {name} of run {run} was done with {text}, not with {given[name]}")
    if list(done) != list(stages)[: len(done)]:
        raise ValueError(f"run {run} has marks of {sorted(done)}, but earlier stages are not done")
    ran = []
    for name, (function, _) in stages.items():
        if name not in done:
            function()
            marks.create(f"{name}.json", given[name])
            ran.append(name)
    return ran
