import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import periods

BLANKS = " \t\n\x0b\x0c\r"


def plain_runs(words):
    """Every stretch of equal words a lag apart, of those with no smaller period the long ones."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    return words


def plain(doc_id, text):
    own = plain_words(text)
    words, n = list(own), len(own)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            words[i] = own[a + (i - a) % p]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


letters = st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abc"), max_size=80)
blocks = st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 12)), max_size=8).map(
    lambda pairs: list("".join(block * times for block, times in pairs))
)


@settings(max_examples=500, deadline=None)
@given(letters | blocks, st.sampled_from([2, 4, 64]))
def test_runs_equal_plain(words, direct):
    before, periods.DIRECT_LAGS = periods.DIRECT_LAGS, direct
    try:
        assert periods.runs_of(periods.numbered(words)) == plain_runs(words)
    finally:
        periods.DIRECT_LAGS = before


@pytest.mark.parametrize("seed", range(4))
def test_long_periods(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(4):
        block = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 110))]
        words += (block * 9)[: rng.randrange(len(block), 9 * len(block))] + [rng.choice("abc") for _ in range(rng.randrange(30))]
    assert periods.runs_of(periods.numbered(words)) == plain_runs(words)


def test_segments_hold_no_rare_word():
    rng = random.Random(9)
    codes = np.array([int(rng.expovariate(0.3)) for _ in range(1_500)])
    found = periods.segments(codes)
    for start, end in found:
        assert end - start >= 6
        assert np.unique(codes[start:end], return_counts=True)[1].min() >= 4
    inside = [(s, s + length) for s, length, _ in plain_runs(codes.tolist())]
    assert all(any(start <= s and e <= end for start, end in found) for s, e in inside)


def plain_segments(codes):
    """By counting every piece anew."""
    pending, found = [(0, len(codes))], []
    while pending:
        start, end = pending.pop()
        piece = codes[start:end]
        rare = [i for i, c in enumerate(piece) if piece.count(c) < 4]
        if not rare and end - start >= 6:
            found.append((start, end))
        edges = [-1, *rare, end - start] if rare else []
        pending += [(start + a + 1, start + b) for a, b in zip(edges, edges[1:])]
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=120) | st.lists(st.integers(0, 2), max_size=60))
def test_segments_equal_plain(codes):
    assert periods.segments(np.array(codes, dtype=np.int64)) == plain_segments(codes)


def test_deep_recursion_takes_time_in_proportion():
    """Each split takes a few words off the end and makes the next word rare."""
    n = 60_000
    codes = [c for i in range(n) for c in (i, i + 1, i + 2, i + 3)]
    start = time.monotonic()
    assert periods.segments(np.array(codes)) == [] or time.monotonic() - start < 20
    assert time.monotonic() - start < 20


def test_very_long_texts_take_time_in_proportion():
    rng = random.Random(5)
    block = [rng.randrange(50_000) for _ in range(50_000)]
    cases = {
        "one word": [7] * 400_000,
        "long period": block * 8,
        "few words": [rng.randrange(3) for _ in range(400_000)],
        "nested": ([1] * 99 + [2]) * 4_000,
    }
    expected = {"one word": [(0, 400_000, 1)], "long period": [(0, 400_000, 50_000)]}
    for name, words in cases.items():
        start = time.monotonic()
        runs = periods.runs_of(np.array(words))
        assert time.monotonic() - start < 30, name
        if name in expected:
            assert runs == expected[name]
        if name == "nested":
            assert len(runs) == 4_001 and (0, 400_000, 100) in runs


def rows():
    rng = random.Random(6)
    vocabulary = ["the", "of", "né", "x y", "a\x85b"] + [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(120))) for _ in range(150)]
    texts += [("go on " * 30).strip(), "a\tb\nc " * 20, "z " * 500, "", None, " \n ", "a b c d e"] * 4
    return list(enumerate(texts))


def test_equals_plain(documents):
    got = periods.periodic_runs(documents(*rows(), clashing=True), planted=True).collect()
    assert sorted(map(tuple, got)) == [plain(*row) for row in rows()]
    assert sum(r.n_runs > 0 for r in got) > 20


def test_defined_cases(documents):
    odd = [(None, "a " * 9), (None, None), (3, "a " * 9), (3, "a " * 9), (4, "q" * 200_000)]
    got = periods.periodic_runs(documents(*odd), planted=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain(*row) for row in odd), key=str)
    assert periods.periodic_runs(documents()).collect() == []
