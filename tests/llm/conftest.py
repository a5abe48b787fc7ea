import pytest

VOCABULARIES = "/opt/tokenizers"

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Names that the operators use for columns of their own.
CLASHING = (
    "key", "size", "score", "ids", "n", "kind", "spans", "group", "prefix", "signature", "whole_text", "whole", "bits",
    "base", "seen", "mix_key", "mix_copy", "jaccard_key", "pii_key", "pii_spans", "pii_text", "quality_score", "given",
    "block", "shard", "copy", "draw", "source_key", "task", "label", "words", "hashes", "round_trip",
)


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from texts, or from (doc_id, text[, source])."""

    def build(*rows, clashing=False):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, source = (*row, "s")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])
        return df

    return build


def own_columns_are_kept(df):
    """Whether the clashing columns came through as they were."""
    from pyspark.sql import functions as F

    wrong = [F.col(name) != f"own {name}" for name in CLASHING]
    condition = wrong[0]
    for other in wrong[1:]:
        condition = condition | other
    return df.where(condition).count() == 0
