"""Names and expressions that several operators share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 1024 * 1024  # of texts that go to a Python worker at once; a longer text goes alone
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, BLANK), "")


def in_training_fold(doc_id: Column) -> Column:
    """Labels of the other fold are held out: crc32 of the id as text, divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed a single time, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, first: Column, combine: Callable[[Column, Column], Column], chunk: int = 64) -> Column:
    """`first`, and what the first 1, 2, ... values make of it: one more than there are values.

    `combine` is associative. Chunks are added up on their own, as an array that grows by one element at a time is
    copied each time: so a long array costs little more per value than a short one.
    """

    def extend(acc: Column, value: Column) -> Column:
        return F.concat(acc, F.array(combine(F.element_at(acc, -1), value)))

    def of_chunk(part: Column, start: Column) -> Column:
        return F.slice(F.aggregate(part, F.array(start), extend), F.lit(1), F.size(part))

    def of_all(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / chunk).cast("int"))
        chunks = F.transform(numbers, lambda i: F.slice(all_, i * chunk + 1, F.lit(chunk)))
        sums = F.transform(chunks, lambda c: F.aggregate(F.slice(c, F.lit(2), F.size(c)), F.get(c, F.lit(0)), combine))
        return once(
            F.struct(chunks.alias("chunks"), F.aggregate(sums, F.array(first), extend).alias("starts")),
            lambda both: F.concat(
                F.flatten(F.zip_with(both["chunks"], F.slice(both["starts"], F.lit(1), F.size(both["chunks"])), of_chunk)),
                F.slice(both["starts"], -1, 1),
            ),
        )

    return once(values, lambda all_: F.when(F.size(all_) > 0, of_all(all_)).otherwise(F.array(first)))


PIECE_CHARS = 256


def cut(text: Column, use: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """`use` of a function from a start and an end to that part of the text.

    A place in a long string is found from its beginning only, so the text is kept in pieces of one length: many parts
    of one text then cost no more than their own lengths.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))

    def between_in(kept: Column) -> Callable[[Column, Column], Column]:
        def between(start: Column, end: Column) -> Column:
            one, other = F.floor(start / PIECE_CHARS).cast("int"), F.floor(end / PIECE_CHARS).cast("int")
            begin, piece = start - one * PIECE_CHARS, F.coalesce(F.get(kept, one), F.lit(""))
            across = F.concat_ws(
                "", F.substring(piece, begin + 1, F.lit(PIECE_CHARS)),
                F.array_join(F.slice(kept, one + 2, F.greatest(other - one - 1, F.lit(0))), ""),
                F.left(F.get(kept, other), end - other * PIECE_CHARS),
            )
            return F.when(one == other, F.substring(piece, begin + 1, end - start)).otherwise(across)

        return between

    return once(pieces, lambda kept: use(between_in(kept)))


def row_key(doc_id: str, text: str) -> Column:
    """Rows with equal id and text share a key; a null id differs from every other."""
    known = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("n"))
    return F.md5(F.concat(known, F.lit("\n"), whole_text(text)).cast("binary"))


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col(f"`{name.replace('`', '``')}`")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that what a task makes of one stays small beside the batch itself.

    What Arrow keeps for further batches is given back at the end, as the worker lives on beside other tasks."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
    pa.default_memory_pool().release_unused()


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session that hands Python workers small batches: JVM and worker each hold one at a time."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    conf.set(key, str(BATCH_BYTES))
    return df
