import random

import numpy as np
import pytest
from conftest import CLASHING, own_columns_are_kept
from pyspark.sql import functions as F

from millrace.llm import quality, toxicity
from millrace.llm.common import in_training_fold
from millrace.llm.samples import labelled_texts

LABELS = "doc_id bigint, quality int, toxic int"
INSULTS = ["blockhead", "nitwit", "dunderhead", "numskull"]


def word(rng):
    return "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10)))


@pytest.fixture(scope="module")
def corpus(spark, documents):
    """A sixth is toxic, a fifth junk; two labels in a hundred are wrong."""
    rng = random.Random(12)
    rows, labels, truth = [], [], {}
    for i in range(1500):
        words = [word(rng) for _ in range(rng.randrange(30, 120))]
        toxic, good = int(i % 6 == 0), int(i % 5 != 0)
        if toxic:
            for at in range(0, len(words), 25):
                words[at] = rng.choice(INSULTS) + rng.choice(["", ",", "!"])
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[n // 20 * 20] for n in range(len(words))]
        rows.append((i, " ".join(words)))
        flip = rng.random() < 0.02
        labels.append((i, 1 - good if flip else good, 1 - toxic if flip else toxic))
        truth[i] = (good, toxic)
    return documents(*rows).cache(), spark.createDataFrame(labels, LABELS).cache(), truth


def held_out(corpus, scored, which, bound):
    docs, _, truth = corpus
    rows = scored.where(~in_training_fold(F.col("doc_id"))).collect()
    assert len(rows) > 200
    return sum((row.score >= bound) == bool(truth[row.doc_id][which]) for row in rows) / len(rows)


def test_toxicity_on_held_out_documents(corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).cache()
    assert held_out(corpus, scored, 1, 0.5) > 0.97
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert len(model.toxic) <= toxicity.DICTIONARY_BYTES["toxic"]
    again = toxicity.score(docs, toxicity.fit(docs, labels))
    assert sorted(scored.collect()) == sorted(again.collect())


def test_a_toxic_passage_counts_alike_in_a_long_text(corpus, documents):
    docs, labels, _ = corpus
    rng = random.Random(1)
    long = [word(rng) for _ in range(20_000)]
    passage = [w for i in range(25) for w in (rng.choice(INSULTS), *long[i * 7 : i * 7 + 7])]
    texts = [
        " ".join(long[:60]), " ".join(long), " ".join(passage), " ".join([*long[:9_000], *passage, *long[9_000:]]),
        f"nitwit {' '.join(long[:60])} blockhead", " ".join([*long[:9_000], "NITWIT!?", *long[9_000:]]),
    ]
    model = toxicity.fit(docs, labels)
    found = [r.score for r in toxicity.score(documents(*texts), model).orderBy("doc_id").collect()]
    assert found[0] < 0.5 and found[1] < 0.5
    assert found[2] >= 0.5 and found[3] >= 0.5 and found[4] >= 0.5
    assert found[5] < found[4]


def test_best_stretch_is_the_best_of_all(corpus, monkeypatch):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    windows, rng = toxicity._Windows(model.toxic, model.ordinary), random.Random(2)
    monkeypatch.setattr(toxicity, "STRETCH_WORDS", 7)
    weights = np.array(model.weights)
    for n in (0, 1, 6, 7, 8, 60):
        words = [rng.choice([*INSULTS, word(rng)]) for _ in range(n)]
        each = [weights[windows.differences[w]] for w in words]
        best = max((sum(each[i : i + 7]) for i in range(max(1, n - 6))), default=0.0)
        assert abs(windows.best_stretch(" ".join(words), weights) - best) < 1e-9
        assert windows.counts(" ".join(words)) == [[windows.differences[w] for w in words].count(d) for d in range(13)]


def test_quality_on_held_out_documents(corpus):
    docs, labels, _ = corpus
    scored = quality.score(docs, quality.fit(docs, labels)).cache()
    assert held_out(corpus, scored, 0, 0.3) > 0.97
    again = quality.score(docs, quality.fit(docs, labels))
    assert sorted(scored.select("doc_id", "score").collect()) == sorted(again.select("doc_id", "score").collect())


def test_exact_votes(spark, documents):
    """Scores are those of all cosine products, whatever the blocks."""
    import numpy as np

    rng = random.Random(7)
    texts = [" ".join(word(rng) for _ in range(40)) for _ in range(300)]
    labels = [(i, i % 2, 0) for i in range(300)]
    model = quality.fit(documents(*texts), spark.createDataFrame(labels, LABELS))
    vectors = quality._unit(quality._balanced(quality.text_features(texts)) @ model.projection)
    products = vectors @ model.voters.T
    got = {r.doc_id: r.score for r in quality.score(documents(*texts), model).collect()}
    for i in range(0, 300, 17):
        near = np.argsort(-products[i], kind="stable")[: quality.NEIGHBOURS]
        weights = np.maximum(products[i][near], 1e-6).astype(float) ** quality.SHARPNESS
        assert abs(got[i] - (weights * model.labels[near]).sum() / weights.sum()) < 1e-3


def test_labels_are_the_only_thing_learned_from_them(corpus, spark):
    """The fold that is held out does not matter, nor do further columns."""
    docs, labels, _ = corpus
    wrong = labels.withColumn("toxic", F.when(in_training_fold(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs.withColumn("lang", F.lit("x")), wrong)


def test_the_sample_is_bounded_and_fixed(corpus):
    docs, labels, _ = corpus
    one, two = (labelled_texts(d, labels, "toxic", 50) for d in (docs, docs.unionByName(docs).repartition(7)))
    assert one.count() == 50
    assert sorted(one.collect()) == sorted(two.collect())


@pytest.mark.parametrize("labelled", [[], [(1, None, None)], [(None, 1, 1)], [(1, 1, 1)], [(1, 0, 0), (2, 1, 1)], [(99, 1, 0)]])
def test_few_or_no_labels(spark, documents, labelled):
    docs = documents("a b c", "d e f", "nitwit", None, "")
    labels = spark.createDataFrame(labelled, LABELS)
    for module, name in ((toxicity, "toxic"), (quality, "quality")):
        scores = [r.score for r in module.score(docs, module.fit(docs, labels, name)).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)


def test_defined_cases(corpus, documents):
    docs, labels, _ = corpus
    odd = documents((None, "x"), (None, None), (4, ""), (4, "😀" * 3), (4, "w " * 100_000), (5, "ab"), clashing=True)
    tox, good = toxicity.fit(docs, labels), quality.fit(docs, labels)
    for scored in (toxicity.score(odd, tox), quality.score(odd.drop("score"), good)):
        assert scored.count() == 6
        assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert not set(CLASHING) - {"score"} & set(toxicity.score(odd, tox).columns)
    replaced = quality.score(odd, good)
    assert replaced.columns.count("score") == 1 and dict(replaced.dtypes)["score"] == "double"
    assert own_columns_are_kept(quality.score(odd, good, name="other").drop("other"))
    assert toxicity.score(documents(), tox).collect() == []
    assert quality.score(documents(), good).collect() == []
