"""The bounded sample of labelled rows that classifiers are fitted on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_training_fold, whole_text


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, label and text of up to `rows` labelled documents of the training fold, chosen by a hash of the id.

    Rows without an id or a label stay out; of rows that share an id the smallest text and label count. The
    chosen ids are at most `rows` numbers and are broadcast; repeated rows shrink before they are shuffled.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).alias("label"))
    usable = known.where(F.col("label").isNotNull() & in_training_fold(F.col("doc_id")))
    ids = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.select(F.col("doc_id").alias("doc_id"), whole_text().alias("text"))
    return own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
