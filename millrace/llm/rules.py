"""Quality rules: statistics of whole texts, and decision lists learned from labelled ones.

A decision list is an ordered list of conjunctions of thresholds; the first that holds rejects the text.
Learning is sequential covering: a rule grows by the condition with the highest information gain while there is any,
is pruned on rows kept apart, and the rows it covers leave before the next rule. It ends when no condition covers
MIN_COVERED rejected rows, or the next rule is less precise than MIN_PRECISION. Every step is one count per
feature, bin and label over the labelled rows, by Spark; the driver sees those counts only.

Defined cases: a null text has no words and fails the base rules; rows are judged one by one, so repeated
rows fare alike and the order is free; an id labelled more than once counts once per label row; without
usable labels the list is empty and the base rules alone decide; an empty table gives no rows; further
columns stay out of it.
"""

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANK_CHARS, in_training_fold, whole_text, words
from millrace.sources import stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

CUTS = 32  # quantiles of each class that can become thresholds
MIN_COVERED = 5  # rejected labelled rows that a rule must cover
MIN_PRECISION = 0.6  # on the pruning rows: a rule that loses more clean texts is not taken
QUANTILE_ACCURACY = 10_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "word_length", "line_words", "n_words")


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base statistics, and the shares that rules test. One pass, no shuffle.

    A text's 8-word windows are compared by 64-bit hashes; only texts with an equal pair are looked at closer.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, BLANK_CHARS, "")) > 0)
    parsed = own.select(
        "doc_id",
        F.length(F.translate("text", BLANK_CHARS, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{Punct}")).cast("bigint").alias("n_marks"),
        lines.alias("lines"),
        F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"),
    )
    hashes = F.col("hashes")
    n_words = F.size(hashes)
    windows = F.when(
        n_words >= WINDOW,
        F.transform(F.sequence(F.lit(1), n_words - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    windowed = parsed.select(
        "doc_id",
        n_words.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_upper",
        "n_marks",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    ordered = windowed.withColumn(
        "ordered",
        F.when(
            repeats,
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
        ),
    ).drop("windows")
    found = F.filter(
        "ordered",
        lambda w, i: (w["h"] == F.get("ordered", i - 1)["h"]) | (w["h"] == F.get("ordered", i + 1)["h"]),
    )
    placed = ordered.withColumn("starts", F.array_sort(F.transform(found, lambda w: w["at"]))).drop("ordered")
    # A window covers its words up to the next found window.
    covered = F.transform(
        "starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - s, F.lit(WINDOW)))
    )
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda acc, n: acc + n), F.lit(0)).cast("bigint")
    counted = placed.withColumn("n_repeat_words", total).drop("starts")
    per = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return counted.select(
        "doc_id",
        *BASE,
        per("n_symbols", "n_words").alias("symbol_share"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        per("n_upper", "word_chars").alias("upper_share"),
        per("n_marks", "word_chars").alias("mark_share"),
        per("word_chars", "n_words").alias("word_length"),
        per("n_words", "n_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Condition:
    """`feature` at or above the bound, or below it."""

    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        value, bound = F.col(self.feature), F.lit(self.bound)
        return value >= bound if self.above else value < bound

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.bound:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(Column.__and__, [condition.column() for condition in rule], F.lit(True))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null when none does, which keeps the text."""
    chain = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, start=1))):
        chain = F.when(holds(rule), number).otherwise(chain)
    return chain


def _cuts(rows: DataFrame, features: tuple[str, ...]) -> dict[str, list[float]]:
    """Thresholds to try: quantiles of both classes, which sees values that the rejected few have."""
    shares = [i / CUTS for i in range(1, CUTS)]
    quantiles = rows.groupBy("bad").agg(*[F.percentile_approx(F.col(f), shares, QUANTILE_ACCURACY).alias(f) for f in features])
    found = quantiles.collect()  # two rows
    return {f: sorted({float(cut) for row in found for cut in row[f] or []}) for f in features}


def _gain(good_before: int, bad_before: int, good: int, bad: int) -> float:
    """How many bits of the still covered rejected rows a condition saves."""
    if bad == 0 or bad_before == 0:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(bad_before / (bad_before + good_before)))


def _best_condition(covered: DataFrame, cuts: dict[str, list[float]]) -> Condition | None:
    """One count per feature, bin and label gives the split of every threshold."""
    bins = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in cuts])
    ).alias("b")
    counts: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(c) + 1)] for f, c in cuts.items()}
    for row in covered.select("bad", bins).groupBy("b.feature", "b.bin", "bad").count().collect():
        counts[row["feature"]][row["bin"]][int(row["bad"])] = row["count"]
    best, best_gain = None, 1e-9
    for feature, table in sorted(counts.items()):
        good_all, bad_all = (sum(cell[k] for cell in table) for k in (0, 1))
        good_below = bad_below = 0
        for cut, (good, bad) in zip(cuts[feature], table):
            good_below, bad_below = good_below + good, bad_below + bad
            for above, g, b in ((True, good_all - good_below, bad_all - bad_below), (False, good_below, bad_below)):
                if b >= MIN_COVERED and (gain := _gain(good_all, bad_all, g, b)) > best_gain:
                    best, best_gain = Condition(feature, above, cut), gain
    return best


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, float]:
    """The beginning of the rule that separates unseen rows best, and its precision there."""
    parts = [rule[:n] for n in range(1, len(rule) + 1)]
    sums = []
    for i, part in enumerate(parts):
        sums += [F.count_if(holds(part) & F.col("bad")).alias(f"b{i}"), F.count_if(holds(part)).alias(f"n{i}")]
    row = rows.agg(*sums).first()
    scored = [((2 * row[f"b{i}"] - row[f"n{i}"]) / max(1, row[f"n{i}"]), row[f"n{i}"], part) for i, part in enumerate(parts)]
    score, _, part = max(scored, key=lambda s: (s[0], s[1], -len(s[2])))
    return part, (score + 1) / 2


def learn_rules(
    statistics: DataFrame, labels: DataFrame, label: str = "quality", features: tuple[str, ...] = FEATURES
) -> list[Rule]:
    """A decision list for label 0, from the rows of the training fold; all of them are used."""
    own = labels.select(F.col("doc_id").alias("doc_id"), (F.col(label) == 0).alias("bad"))
    known = own.where(F.col("bad").isNotNull() & in_training_fold(F.col("doc_id")))
    rows = stage(
        statistics.join(known, "doc_id").select(
            "bad", *features, (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")
        ),
        "rules",
    )
    cuts = _cuts(rows, features)

    def bin_of(feature: str) -> Column:
        bounds = F.array(*[F.lit(cut) for cut in cuts[feature]])
        return F.size(F.filter(bounds, lambda cut: cut <= F.col(feature))).alias(f"bin_{feature}")

    cuts = {f: c for f, c in cuts.items() if c}
    binned = stage(rows.select("*", *[bin_of(f) for f in cuts]), "rules")
    grow, prune = binned.where(~F.col("prune")), binned.where("prune")
    rules: list[Rule] = []
    while cuts:
        rule: Rule = ()
        while best := _best_condition(grow.where(holds(rule)), cuts):
            rule += (best,)
        if not rule:
            break
        rule, precision = _pruned(rule, prune)
        if precision < MIN_PRECISION:
            break
        rules.append(rule)
        grow, prune = grow.where(~holds(rule)), prune.where(~holds(rule))
    return rules


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (which one rejects) and kept."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = statistics.withColumns({"base_failed": base_failed, "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
