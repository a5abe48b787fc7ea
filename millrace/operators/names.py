"""Names for helper columns."""

from pyspark.sql import DataFrame


def fresh_name(base: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case."""
    taken = {name.lower() for df in frames for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
