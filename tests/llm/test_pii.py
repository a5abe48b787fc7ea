import random
import re
import time

from conftest import own_columns_are_kept
from pyspark.sql import functions as F

from millrace.llm import pii
from millrace.llm.pii import KINDS, all_spans, found_spans, redact, spans_text

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, form in FORMS.items()
        for m in re.finditer(form, text or "")
        if good(kind, m.group())
    ]


def spans_of(df):
    return [(row.doc_id, row.base) for row in all_spans(found_spans(df)).select("doc_id", spans_text(F.col("base")).alias("base")).collect()]


def test_base_spans_match_the_plain_forms(documents):
    rng = random.Random(9)
    parts = [
        "a.b@c.de", "x@y", "x@y.z_w@q.r.s", "@", "é@a.b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.255", "4111111111111111",
        "4111 1111-1111 1111", "4111  1111", "1234567890123", "+1 (234) 567-8901", "+12345678", "+1-2-3-4-5-6-7-8-9-", "+", "0", "-", " ",
        "\n", "😀", "word", ".", "a@b.c-", "++1 23456789012", "00000000000000000000", "0000000000000", "255.255.255.255.", "%+-@a.b.",
    ]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(600)] + [None, "", "none"]
    got = spans_of(documents(*rows))
    assert sorted(got) == sorted((i, ",".join(plain(text))) for i, text in enumerate(rows))


def test_long_runs(documents):
    rows = ["9" * 60_000, "1 " * 30_000, "a" * 60_000 + "@", "1." * 30_000, "+1" * 20_000, "a@b.c " * 500, "x" * 100_000 + " 1.2.3.4"]
    got = dict(spans_of(documents(*rows)))
    assert got == {i: ",".join(plain(text)) for i, text in enumerate(rows)}


def bootstrapped(seeds=30):
    """Numbers after `card no` are cards, but for a few whose check digit is wrong; others are not."""
    rng = random.Random(3)
    number = lambda ok: next(n for n in iter(lambda: str(rng.randrange(10**15, 10**16)), None) if luhn(n) == ok)
    rows = [f"the card no {number(True)} was used" for _ in range(seeds)]
    unseen = [f"the card no {number(False)} was used" for _ in range(2)]
    others = [f"item {rng.choice('abcdef')} {number(False)} x{i} in stock" for i in range(60)]
    return rows, unseen, others


def test_confident_patterns_discover_unseen_numbers(documents):
    rows, unseen, others = bootstrapped()
    got = {r.doc_id: r.spans for r in all_spans(found_spans(documents(*rows, *unseen, *others))).select("doc_id", spans_text(F.col("spans")).alias("spans")).collect()}
    for i, text in enumerate([*rows, *unseen]):
        assert got[i] == f"card:12:{12 + 16}", text
    assert {got[len(rows) + len(unseen) + i] for i in range(len(others))} == {""}


def test_rare_patterns_discover_nothing(documents):
    rows, unseen, others = bootstrapped(seeds=4)
    spans = all_spans(found_spans(documents(*rows, *unseen, *others)))
    assert spans.where("spans <> base").count() == 0


def test_defined_cases(documents):
    assert spans_of(documents()) == []
    assert redact(documents()).collect() == []
    odd = documents((None, "a@b.c"), (None, None), (1, "a@b.c"), (1, "a@b.c"), (1, "no"), clashing=True)
    assert sorted(spans_of(odd), key=str) == sorted(
        [(None, "email:0:5"), (None, ""), (1, "email:0:5"), (1, "email:0:5"), (1, "")], key=str
    )
    clean = redact(odd)
    assert clean.columns == odd.columns
    assert own_columns_are_kept(clean)
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id = 1").collect()) == [(1, "[email]"), (1, "[email]"), (1, "no")]
    assert sorted((str(r.text)) for r in clean.where("doc_id IS NULL").collect()) == ["None", "[email]"]


def test_redaction(documents):
    text = "é mail x.1@y.z, ip 10.0.0.1; call +1 (234) 567-8901 or 4111 1111 1111 1111."
    (row,) = redact(documents(text)).collect()
    assert row.text == "é mail [email], ip [ip]; call [phone] or [card]."
    assert KINDS == ("email", "ip", "card", "phone")
    # Overlapping spans: the first one counts.
    (row,) = redact(documents("+4111 1111 1111 111 1")).collect()
    assert "1111" not in row.text


def spans_by_id(df):
    return {r.doc_id: r.spans for r in all_spans(found_spans(df)).select("doc_id", spans_text(F.col("spans")).alias("spans")).collect()}


def test_trusted_contexts_discover_other_forms(documents):
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cards = lambda: next(n for n in iter(lambda: digits(16), None) if luhn(n))
    calls = [f"please call +1 ({digits(3)}) 555-{digits(4)} before noon" for _ in range(60)]
    mails = [f"please write to u{i}.x@mail{i % 9}.example.com for more" for i in range(60)]
    paid = [f"it was paid with {cards()} in june" for _ in range(60)]
    unseen = [
        ("please call 555-713-7713 before noon", "phone", "555-713-7713"),
        ("please call (017) 555-7713 before noon", "phone", "(017) 555-7713"),
        ("please call 017 555 7714, before noon", "phone", "017 555 7714"),
        ("so please call 555-713-7715 whenever that suits", "phone", "555-713-7715"),
        ("please write to user@host for more", "email", "user@host"),
        ("please write to name at host for more", "email", "name at host"),
        ("it was paid with 4111 1111 1111 1112 in june", "card", "4111 1111 1111 1112"),
    ]
    others = ["please call him before noon", "the item 555-713-7713 is sold out", "write 4111 1111 1111 1112 on it"]
    seeds = [*calls, *mails, *paid]
    got = spans_by_id(documents(*seeds, *[text for text, _, _ in unseen], *others))
    assert all(got[i] == ",".join(plain(text)) for i, text in enumerate(seeds))
    wanted = [f"{kind}:{text.index(value)}:{text.index(value) + len(value)}" for text, kind, value in unseen]
    assert [got[len(seeds) + i] for i in range(len(unseen))] == wanted
    assert [got[len(seeds) + len(unseen) + i] for i in range(len(others))] == [""] * len(others)


def test_contexts_are_the_words_around_whatever_they_are(documents):
    long = "w" * 100
    rows = [
        "unit 7 ip 1.2.3.4 host 9 x", "unit 7 ip 1.2.3.444 host 9 x", "7 8 1.2.3.4", "a@b.c\t8 1.2.3.444 ",
        f"{long} {long} 1.2.3.4 {long} {long}", "x a@b.c,d@e.f 1.2.3.4", " 1.2.3.4 y",
    ]
    seen = {r.doc_id: {o.value: o.patterns for o in r.seen} for r in found_spans(documents(*rows)).collect()}
    assert seen[0]["1.2.3.4"] == seen[1]["1.2.3.444"] == ["< 0 ip", "> host 0"]
    assert seen[0]["7"] == ["< unit", "> ip 0.0.0.0"]
    assert seen[2]["1.2.3.4"] == ["< 0 0"]
    assert seen[3]["1.2.3.444"] == ["< a@b.c 0"]
    assert seen[4]["1.2.3.4"] == [f"< {long} {long}", f"> {long} {long}"]
    assert seen[5]["1.2.3.4"] == ["< x a@b.c,d@e.f"] and seen[5]["d@e.f"] == ["< x", "> 0.0.0.0"]
    assert seen[6]["1.2.3.4"] == ["> y"]


def repeated_contexts(n):
    """Seeds in steady contexts, unseen values in the same ones, and everyday words that grow with the corpus."""
    rng = random.Random(n)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    common = ["the", "of", "and", "to", "in"]
    around = lambda k: " ".join(rng.choice(common) for _ in range(k))
    rows = [f"{around(20)} please call +1 ({digits(3)}) 555-{digits(4)} before noon {around(20)}" for _ in range(n)]
    return rows + [f"{around(20)} please call {digits(3)}-{digits(4)} before noon {around(20)}" for _ in range(n // 20)]


def test_work_grows_with_the_corpus(documents, monkeypatch):
    """Patterns are trusted and find the unseen at both sizes; the places looked at grow no faster than the rows."""
    made, contexts = [], pii._contexts
    monkeypatch.setattr(pii, "_contexts", lambda *a: made.append(contexts(*a)) or made[-1])
    places = []
    for n in (200, 1_000):
        made.clear()
        rows = repeated_contexts(n)
        got = spans_by_id(documents(*rows))
        assert all(spans.count("phone") == 1 for spans in got.values())
        places.append(sum(df.count() for df in made))
    assert 0 < places[1] < 8 * places[0]


def test_many_spans_in_one_text_take_time_in_proportion(documents):
    seconds = []
    for n in (1_000, 1_000, 16_000):
        text = " ".join(f"{i % 200}.1.2.{i % 250} word {i} x" for i in range(n))
        start = time.monotonic()
        (row,) = all_spans(found_spans(documents(text))).select(spans_text(F.col("spans")).alias("spans")).collect()
        (clean,) = redact(documents(text)).collect()
        seconds.append(time.monotonic() - start)
        assert row.spans.split(",") == plain(text)
        assert clean.text == " ".join(f"[ip] word {i} x" for i in range(n))
    assert seconds[2] < 5 * seconds[1]

