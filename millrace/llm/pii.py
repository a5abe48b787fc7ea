"""Personal data: spans by fixed forms, and more by bootstrapped context patterns. Spark expressions only.

The fixed forms give the seeds. The words around a seed are its patterns; a pattern is as good as the
share of its instances that are known, an instance as good as its patterns together, over a few rounds.
Each slot of a pattern that enough seeds (or words of their shape) support holds one instance: a seed, or the run
of one to four words that stands in the patterns on both sides, else the one most like the kind's seeds. Likeness is
soft: composition and length. Runs in patterns of high confidence become spans as well; a run without digit or at
sign only between two such patterns.

Defined cases: a null text is empty; rows with equal id and text get equal spans; repeated rows count as
one instance; a document without spans gets empty strings; an empty table gives no rows; further columns
are ignored, and `redact` keeps them, whatever their names.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BLANK, cut, once, quoted, row_key, running, whole_text, words
from millrace.operators import fit_broadcast, fresh_name, join_lookup
from millrace.sources import read_parquet, stage, staged_job, staging_path

# Kinds in the order of results.
KINDS = ("email", "ip", "card", "phone")

# The contract's forms. Possessive quantifiers change no match, as what follows cannot start inside them; the look-behinds
# leave out starts that fail, or lose to an earlier start, whenever the run's first character does. Both keep long runs linear.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)"
IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: A word with a digit or an at sign, from the first letter, digit or plus on.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: Signs around a value; a bracket that is closed within the value is part of it.
SIGNS_BEFORE = r"^(?:[^\p{L}0-9+(]|\((?![^()]*\)[^()]*[\p{L}0-9]))+"
SIGNS_BEHIND = r"[^\p{L}0-9]+$"

CONTEXT_WORDS = 2
CONTEXT_CHARS = 64  # looked at on either side,
WIDE_CHARS = 1_024  # or so many where they hold too few words; a word beyond that has no part in a pattern
RUN_WORDS = 4
ROUNDS = 3
MIN_INSTANCES = 10  # different values that a pattern must have been seen with
MIN_CONFIDENCE = 0.9
MIN_SUPPORT = 5  # different seeds, or words of their shape, before a pattern's slots are looked up,
MIN_SUPPORT_SHARE = 0.005  # and that share of the kind's different seeds
MIN_SHARE = 0.25  # of known instances among the different words in a pattern's slots, to begin with
MIN_SCORE = 0.75  # confidence of the patterns around, times LIKENESS_POWER of the likeness
LIKENESS_POWER = 0.25
MIN_SHAPE_SEEDS = 3  # different seeds of one shape before words of that shape count as its like

SPAN = "struct<kind: int, start: int, end: int>"
OCCURRENCE = "struct<start: int, end: int, value: string, before: string, after: string>"


def occurrences(text: Column, pattern: str) -> Column:
    """All matches, leftmost first: start, end (code points), value, and some text on either side, other matches included.
    A blank stands for the beginning and the end of the whole text."""
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))
    return once(found, lambda both: _placed(both["gaps"], both["values"]))


def _placed(gaps: Column, values: Column) -> Column:
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda gap, value: F.length(gap) + F.length(value))
    edged = F.transform(
        gaps,
        lambda gap, i: F.concat_ws("", F.when(i == 0, " "), gap, F.when(i == F.size(values), " ")),
    )

    def place(p: Column) -> Column:
        piece = lambda i: F.concat_ws("", F.get(p["edged"], i), F.get(values, i))
        # A gap and a match hold at least one word in most texts; two words need no more than three of them.
        last = lambda i: F.right(piece(i), F.lit(WIDE_CHARS))
        next_ = lambda i: F.left(piece(i), F.lit(WIDE_CHARS))

        def one(value: Column, i: Column) -> Column:
            start = F.get(p["starts"], i) + F.length(F.get(gaps, i))
            before = F.concat_ws("", F.when(i > 2, last(i - 3)), F.when(i > 1, last(i - 2)), F.when(i > 0, last(i - 1)), F.get(p["edged"], i))
            after = F.concat_ws("", next_(i + 1), next_(i + 2), next_(i + 3))
            return F.struct(
                start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                F.right(before, F.lit(WIDE_CHARS)).alias("before"), F.left(after, F.lit(WIDE_CHARS)).alias("after"),
            )

        return F.transform(values, one)

    starts = running(lengths, F.lit(0), lambda a, b: a + b)
    placed = once(F.struct(edged.alias("edged"), starts.alias("starts")), place)
    return F.when(F.size(values) > 0, placed).otherwise(F.array().cast(f"array<{OCCURRENCE}>"))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(value, " ().-+", "")).between(9, 15)
    return F.lit(True)


def _worth_a_look(kind: str, text: Column) -> Column:
    """Cheap tests that every match passes."""
    sign = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    return F.contains(text, F.lit(sign)) if sign else text.rlike("[0-9]")


def base_spans(text: Column) -> dict[str, Column]:
    """Occurrences of each kind that pass its test; a failing match is dropped and its text not looked at again."""
    empty = F.array().cast(f"array<{OCCURRENCE}>")

    def of(kind: str) -> Column:
        found = F.filter(occurrences(text, FORMS[kind]), lambda o: _valid(kind, o["value"]))
        return F.when(_worth_a_look(kind, text), found).otherwise(empty)

    return {kind: of(kind) for kind in KINDS}


def _shape(value: Column) -> Column:
    """Digits one by one, letters by runs."""
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "0")


def _plain(text: Column) -> Column:
    """Letter case and the length of numbers do not count in a context."""
    return F.regexp_replace(F.lower(text), "[0-9]+", "0")


def _patterns(o: Column) -> Column:
    """The words before the word it starts in, and those behind the word it ends in; none where the text begins or ends."""

    def before(near: Column) -> Column:
        # The last piece belongs to the value's own word; the first may be the end of a longer word.
        pieces = F.split(near, BLANK)
        found = F.array_remove(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0))), "")
        return F.reverse(F.slice(F.reverse(found), 1, CONTEXT_WORDS))

    def after(near: Column) -> Column:
        pieces = F.split(near, BLANK)
        found = F.array_remove(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0))), "")
        return F.slice(found, 1, CONTEXT_WORDS)

    def side(name: str, look, near: Column, wide: Column) -> Column:
        found = once(look(near), lambda close: F.when(F.size(close) == CONTEXT_WORDS, close).otherwise(look(wide)))
        return F.concat(F.lit(name), _plain(F.array_join(found, " ")))

    sides = F.array(
        side("< ", before, F.right(o["before"], F.lit(CONTEXT_CHARS)), o["before"]),
        side("> ", after, F.left(o["after"], F.lit(CONTEXT_CHARS)), o["after"]),
    )
    return F.filter(sides, lambda pattern: F.length(pattern) > 2)


def _searched(spans: Column, use: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """`use` of a function from a stretch, by start and end, to the spans that may overlap it; `spans` are sorted by
    start. Both ends of that slice are searched by halves, so many spans in one text stay cheap."""
    highest = running(F.transform(spans, lambda s: s["end"]), F.lit(-1), lambda a, b: F.greatest(a, b))
    widest = F.ceil(F.log2(F.size(spans) + F.lit(1))).cast("int")
    bits = F.transform(F.reverse(F.sequence(F.lit(0), widest)), lambda i: F.pow(F.lit(2), i).cast("int"))

    def near(known: Column) -> Callable[[Column, Column], Column]:
        size = F.size(known["spans"])

        def count(passes: Callable[[Column], Column]) -> Column:
            """How many spans pass, if those that do stand before those that don't: the number's bits, highest first."""
            step = lambda low, bit: F.when((low + bit <= size) & passes(low + bit), low + bit).otherwise(low)
            return F.aggregate(known["bits"], F.lit(0), step)

        def slice_(start: Column, end: Column) -> Column:
            ended = count(lambda n: F.get(known["highest"], n) <= start)
            begun = count(lambda n: F.get(known["spans"], n - 1)["start"] < end)
            return F.slice(known["spans"], ended + 1, F.greatest(begun - ended, F.lit(0)))

        return slice_

    return once(F.struct(spans.alias("spans"), highest.alias("highest"), bits.alias("bits")), lambda known: use(near(known)))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def found_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, doc_id, `base` (spans) and `seen`: seeds with their kind and other words that might be data, each with
    its patterns. Staged with the texts; the key stands for id and text."""
    own = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), row_key(doc_id, text).alias("key"))
    looked = own.select("key", "doc_id", "text", *[column.alias(kind) for kind, column in base_spans(F.col("text")).items()])

    def seed(number: int, o: Column) -> Column:
        return F.struct(
            F.lit(number).alias("kind"), o["start"].alias("start"), o["end"].alias("end"),
            o["value"].alias("value"), _patterns(o).alias("patterns"),
        )

    def of_kind(number: int, kind: str) -> Column:
        return F.transform(kind, lambda o: seed(number, o))

    seeds = F.concat(*[of_kind(number, kind) for number, kind in enumerate(KINDS)])
    might = F.when(F.col("text").rlike("[0-9@]"), occurrences(F.col("text"), CANDIDATE)).otherwise(
        F.array().cast(f"array<{OCCURRENCE}>")
    )
    seeded = looked.select("key", "doc_id", "text", seeds.alias("seeds"), might.alias("might"))
    plain = F.transform("seeds", lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")))
    based = seeded.select("*", F.array_sort(plain).alias("base"))

    def trimmed(o: Column) -> Column:
        """Without signs around; the start moves along."""
        core = F.regexp_replace(o["value"], SIGNS_BEFORE, "")
        inner = F.regexp_replace(core, SIGNS_BEHIND, "")
        start = o["start"] + F.length(o["value"]) - F.length(core)
        return F.struct(
            F.lit(None).cast("int").alias("kind"), start.alias("start"), (start + F.length(inner)).alias("end"),
            inner.alias("value"), _patterns(o).alias("patterns"),
        )

    free = _searched(_by_start(F.col("base")), lambda near: F.filter(F.transform("might", trimmed), lambda o: _free(o, near)))
    return stage(based.select("key", "doc_id", "text", "base", F.concat("seeds", free).alias("seen")), "pii")


def _free(o: Column, near: Callable[[Column, Column], Column]) -> Column:
    """Whether there is a value, and no span has a part of it."""
    return (F.length(o["value"]) > 0) & ~F.exists(near(o["start"], o["end"]), lambda s: _overlap(s, o))


def _by_start(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))


def _counts(value: Column) -> dict[str, Column]:
    """What likeness compares: digits, letters and other characters of a value."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", "")).cast("double")
    letters = F.length(F.regexp_replace(value, r"\P{L}", "")).cast("double")
    return {"digits": digits, "letters": letters, "others": F.length(value) - digits - letters}


def _contexts(found: DataFrame, listed: DataFrame) -> DataFrame:
    """key, kind, pattern, left, word, first: each place where a listed pattern stands, and the slot's word beside it."""
    plain = words(_plain(F.col("text")))
    pairs = F.zip_with(plain, F.slice(plain, F.lit(2), F.size(plain)), lambda a, b: F.concat_ws(" ", a, b))
    # Before the pairs the first word alone, which is all that stands before the second; the last word ends the pairs.
    context = F.concat(F.slice(plain, 1, 1), pairs)
    nothing = F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))
    around = F.arrays_zip(
        context.alias("context"), F.slice(plain, F.lit(2), F.size(plain)).alias("next"), F.concat(nothing, plain).alias("previous")
    )
    looked = found.select("key", F.posexplode(around).alias("at", "c")).select("key", "at", "c.*")
    own = listed.select(
        "kind", "pattern", F.substring("pattern", 3, 2**31 - 1).alias("context"), F.startswith("pattern", F.lit("<")).alias("left")
    )
    (small,) = fit_broadcast([own])
    met = looked.join(F.broadcast(own) if small else own, "context")
    # `at` is one more than the place of the pair's first word.
    word = F.when(F.col("left"), F.col("at") + 1).otherwise(F.col("at") - 2)
    first = F.when(F.col("left"), F.col("next")).otherwise(F.col("previous"))
    return met.select("key", "kind", "pattern", "left", word.alias("word"), first.alias("first")).where(first.isNotNull())


def _hopeful(found: DataFrame, supported: DataFrame) -> DataFrame:
    """Patterns in whose slots known instances are MIN_SHARE of all different words or more. The others belong to everyday
    language; by this rule they take no part in the rounds."""
    counted = _contexts(found, supported).groupBy("kind", "pattern").agg(F.countDistinct("first").alias("different"))
    kept = supported.join(counted, ["kind", "pattern"]).where(F.col("n") >= MIN_SHARE * F.col("different"))
    return stage(kept.select("kind", "pattern"), "pii")


def _slots(found: DataFrame, hopeful: DataFrame) -> DataFrame:
    """key, text, base and `hits`: where patterns stand, as the first or last word of the slot beside them."""
    flat = stage(_contexts(found, hopeful).select("key", "kind", "pattern", "left", "word"), "pii")
    (few,) = fit_broadcast([flat])
    hits = flat.groupBy("key").agg(F.collect_set(F.struct("kind", "pattern", "left", "word")).alias("hits"))
    # Rows with equal key have equal text.
    return found.select("key", "text", "base").join(F.broadcast(hits) if few else hits, "key")


def _runs(found: DataFrame, supported: DataFrame, seeds: DataFrame, run_words: int) -> DataFrame:
    """key, kind, pattern, start, end, value, likeness, marked: the one run of words in each slot that no seed fills."""
    slots = _slots(found, supported)
    stripped = F.regexp_replace("text", r"^[\x20\x09-\x0D]+", "")
    # Each word with the blanks behind it.
    chunks = F.split(stripped, r"(?<=[\x20\x09-\x0D])(?![\x20\x09-\x0D])", -1)
    lead = (F.length("text") - F.length(stripped)).alias("lead")
    split = slots.select("key", "base", "hits", chunks.alias("chunks"), lead)

    def runs(known: Column, hit: Column) -> Column:
        """The runs of each length that begin, or end, at the slot's word."""
        first = F.when(hit["left"], hit["word"]).otherwise(F.greatest(hit["word"] - run_words + 1, F.lit(0)))
        last = F.when(hit["left"], hit["word"] + run_words - 1).otherwise(hit["word"])
        own = F.slice(known["chunks"], first + 1, last - first + 1)
        window = F.struct(hit.alias("hit"), F.get(known["starts"], first).alias("at"), own.alias("own"))
        return once(window, lambda w: F.transform(F.sequence(F.lit(1), F.size(w["own"])), lambda n: run(w, n)))

    def run(w: Column, n: Column) -> Column:
        skipped = F.when(w["hit"]["left"], F.lit(0)).otherwise(F.size(w["own"]) - n)
        at = w["at"] + F.length(F.array_join(F.slice(w["own"], F.lit(1), skipped), ""))
        raw = F.array_join(F.slice(w["own"], skipped + 1, n), "")
        cored = once(raw, lambda r: F.struct(r.alias("raw"), F.regexp_replace(r, SIGNS_BEFORE, "").alias("core")))
        start = lambda c: at + F.length(c["raw"]) - F.length(c["core"])
        valued = once(cored, lambda c: F.struct(start(c).alias("start"), F.regexp_replace(c["core"], SIGNS_BEHIND, "").alias("value")))
        hit = w["hit"]
        return once(
            valued,
            lambda v: F.struct(
                hit["kind"].alias("kind"), hit["pattern"].alias("pattern"), hit["left"].alias("left"), hit["word"].alias("word"),
                n.alias("n"), v["start"].alias("start"), (v["start"] + F.length(v["value"])).alias("end"), v["value"].alias("value"),
            ),
        )

    def listed(known: Column) -> Column:
        inside = F.filter("hits", lambda hit: hit["word"] < F.size(known["chunks"]))
        return F.flatten(F.transform(inside, lambda hit: runs(known, hit)))

    # Words and where they start are kept in a variable: a column that a lambda names may be computed for every element.
    starts = running(F.transform("chunks", F.length), F.col("lead"), lambda a, b: a + b)
    all_runs = once(F.struct(F.col("chunks").alias("chunks"), starts.alias("starts")), listed)
    open_ = _searched(_by_start(F.col("base")), lambda near: F.filter("runs", lambda r: _free(r, near)))
    free = split.select("key", "base", all_runs.alias("runs")).select("key", F.explode(open_).alias("r")).select("key", "r.*")
    # How a kind's seeds are made up, each value once.
    different = seeds.select("kind", "value").distinct()
    means = different.groupBy("kind").agg(*[F.avg(count).alias(f"mean_{name}") for name, count in _counts(F.col("value")).items()])
    counted = free.withColumns(_counts(F.col("value"))).join(F.broadcast(means), "kind")
    mean_all = F.col("mean_digits") + F.col("mean_letters") + F.col("mean_others")
    common = [F.least(F.col(n) / F.length("value"), F.col(f"mean_{n}") / mean_all) for n in ("digits", "letters", "others")]
    size, mean_size = F.col("digits") + F.col("letters"), F.col("mean_digits") + F.col("mean_letters")
    length = F.sqrt(F.least(size, mean_size) / F.greatest(size, mean_size))
    compared = counted.select(
        "key", "kind", "pattern", "left", "word", "n", "start", "end", F.lower("value").alias("value"),
        ((common[0] + common[1] + common[2]) * length).alias("likeness"), F.col("value").rlike("[0-9@]").alias("marked"),
    )
    place = Window.partitionBy("key", "kind", "start", "end")
    sides = F.size(F.collect_set("left").over(place))
    best = F.max_by(F.struct("start", "end", "value", "likeness", "marked"), F.struct("sides", "likeness", -F.col("n")))
    chosen = compared.withColumn("sides", sides).groupBy("key", "kind", "pattern", "word").agg(best.alias("run"))
    return stage(chosen.select("key", "kind", "pattern", "run.*"), "pii")


def discovered_spans(found: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """key and `more`: spans of runs of up to `run_words` words in high-confidence patterns."""
    seen = found.select("key", F.explode("seen").alias("o")).select("key", "o.*")
    seeds = seen.where(F.col("kind").isNotNull())
    shapes = seeds.groupBy("kind", _shape(F.col("value")).alias("shape")).agg(F.countDistinct("value").alias("n"))
    kinds = shapes.where(F.col("n") >= MIN_SHAPE_SEEDS).groupBy("shape").agg(F.collect_set("kind").alias("kinds"))
    unknown = seen.where(F.col("kind").isNull()).withColumn("shape", _shape(F.col("value")))
    alike = join_lookup(unknown, stage(kinds, "pii"), "shape").withColumn("kind", F.explode("kinds"))
    edge = ["kind", F.lower("value").alias("value"), F.explode("patterns").alias("pattern")]
    from_seeds = stage(seeds.select(*edge).distinct(), "pii")
    support = from_seeds.unionByName(alike.select(*edge)).groupBy("kind", "pattern").agg(F.countDistinct("value").alias("n"))
    nothing = found.sparkSession.createDataFrame([], f"key string, more array<{SPAN}>")
    # A share of the kind's seeds, so that a larger corpus does not lift ever more everyday contexts over the bound.
    sizes = from_seeds.groupBy("kind").agg(F.countDistinct("value").alias("seeds"))
    enough = F.greatest(F.lit(MIN_SUPPORT), F.col("seeds") * MIN_SUPPORT_SHARE)
    supported = stage(support.join(F.broadcast(sizes), "kind").where(F.col("n") >= enough).drop("seeds"), "pii")
    if supported.isEmpty():
        return nothing
    supported = _hopeful(found, supported)
    if supported.isEmpty():
        return nothing
    runs = _runs(found, supported, seeds, run_words)
    soft = F.pow("likeness", F.lit(LIKENESS_POWER))
    edges = stage(
        from_seeds.join(supported, ["kind", "pattern"]).select("kind", "value", "pattern", F.lit(1.0).alias("seed"), F.lit(1.0).alias("soft"))
        .unionByName(runs.select("kind", "value", "pattern", F.lit(0.0).alias("seed"), soft.alias("soft")))
        .groupBy("kind", "value", "pattern")
        .agg(F.max("seed").alias("seed"), F.max("soft").alias("soft")),
        "pii",
    )
    scored = edges.withColumn("known", F.col("seed"))
    for _ in range(ROUNDS):
        patterns = scored.groupBy("kind", "pattern").agg(
            F.count("*").alias("n"), (F.sum("known") / (F.count("*") + 1)).alias("confidence")
        )
        usable = stage(patterns.where(F.col("n") >= MIN_INSTANCES), "pii")
        doubt = F.sum(F.log(1 - F.coalesce(F.col("confidence"), F.lit(0.0))))
        values = (
            edges.join(usable, ["kind", "pattern"], "left")
            .groupBy("kind", "value")
            .agg(F.greatest(F.max("seed"), F.pow((1 - F.exp(doubt)) * F.max("soft"), 2)).alias("known"))
        )
        scored = edges.join(stage(values, "pii"), ["kind", "value"])
    trusted = usable.where(F.col("confidence") >= MIN_CONFIDENCE).select("kind", "pattern", "confidence")
    # A run beside two trusted patterns has two rows.
    around = (
        runs.join(trusted, ["kind", "pattern"])
        .select("key", "kind", "start", "end", "likeness", "marked", "pattern", "confidence")
        .distinct()
        .groupBy("key", "kind", "start", "end", "likeness", "marked")
        .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("sure"), F.count("*").alias("sides"))
    )
    score = F.col("sure") * soft
    good = around.where((score >= MIN_SCORE) & (F.col("marked") | (F.col("sides") > 1)))
    rank = F.struct(F.col("sides"), score.alias("score"), "kind", "start", "end")
    listed = good.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", rank.alias("rank")))).alias("all"))

    def unbeaten(near: Callable[[Column, Column], Column]) -> Column:
        """Of runs that share words, the one with more patterns around, then the higher score, stays."""
        beaten = lambda a: F.exists(near(a["start"], a["end"]), lambda b: _overlap(a, b) & (b["rank"] > a["rank"]))
        return F.filter("all", lambda a: ~beaten(a))

    kept = F.transform(_searched(F.col("all"), unbeaten), lambda a: F.struct(a["rank"]["kind"], a["start"], a["end"]))
    return listed.select("key", kept.cast(f"array<{SPAN}>").alias("more"))


def all_spans(found: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """key, doc_id, base and spans, the latter two ordered by kind, then start."""
    joined = found.select("key", "doc_id", "base").join(stage(discovered_spans(found, run_words), "pii"), "key", "left")
    more = F.coalesce(F.col("more"), F.array().cast(f"array<{SPAN}>"))
    both = F.array_sort(F.concat(F.col("base").cast(f"array<{SPAN}>"), more))
    return joined.select("key", "doc_id", F.array_sort("base").alias("base"), both.alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def count_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def _bracketed(text: Column, spans: Column) -> Column:
    """The text with each span's kind in brackets in its place; of overlapping spans the first one's."""
    names = F.array(*[F.lit(f"[{kind}]") for kind in KINDS])
    by_start = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")))
    )

    def rebuilt(k: Column, between: Callable[[Column, Column], Column]) -> Column:
        def part(s: Column, i: Column) -> Column:
            done = F.get(k["ends"], i)
            return F.when(s["start"] < done, "").otherwise(F.concat(between(done, s["start"]), F.get(names, s["kind"])))

        return F.concat(F.array_join(F.transform(k["spans"], part), ""), between(F.element_at(k["ends"], -1), k["length"]))

    def known(sorted_: Column) -> Column:
        ends = running(F.transform(sorted_, lambda s: -s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        return F.struct(sorted_.alias("spans"), ends.alias("ends"), F.length(text).alias("length"))

    return cut(text, lambda between: once(once(by_start, known), lambda k: rebuilt(k, between)))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans by the first one's.

    Columns stay as they are but for the text. The texts meet a table of the rows that have spans, which is
    broadcast if it is measured to be small; else both are shuffled.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "spans")
    with staged_job(spark):
        some = all_spans(found_spans(docs, doc_id, text)).where(F.size("spans") > 0)
        some.groupBy("key").agg(F.first("spans").alias("spans")).write.parquet(path)
    some = read_parquet(spark, path)
    (small,) = fit_broadcast([some.select("key", spans_text(F.col("spans")).alias("spans"))])
    key, spans, whole = (fresh_name(f"pii_{name}", docs) for name in ("key", "spans", "text"))
    listed = some.select(F.col("key").alias(key), F.col("spans").alias(spans))
    joined = docs.withColumn(key, row_key(doc_id, text)).join(F.broadcast(listed) if small else listed, key, "left")
    redacted = F.when(F.col(spans).isNull(), F.col(text)).otherwise(_bracketed(F.col(whole), F.col(spans)))
    with_text = joined.withColumn(whole, whole_text(text)).withColumn(text, redacted)
    return with_text.select(*[quoted(name) for name in docs.columns])
