import random
import re

import numpy as np
import pytest
from conftest import own_columns_are_kept
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import graph, jaccard
from millrace.llm.jaccard import drop_near_copies, jaccard_components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain(rows, percent, size):
    """Set size and smallest id of the component of every row, by all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    known = lambda ids: min((x for x in ids if x is not None), default=None)
    lowest = {r: known([rows[i][0] for i in range(len(rows)) if find(i) == r]) for r in set(map(find, parent))}
    return sorted(((i, len(s), lowest[find(n)]) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def run(df, percent=90, size=3):
    return sorted((tuple(r) for r in jaccard_components(df, percent, size).drop("group", "key").collect()), key=str)


def corpus(seed=3, n=30):
    """Families of edited texts, a passage that all share, exact copies, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4)))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(n):
        base = [word() for _ in range(rng.randrange(5, 150))] + (passage if rng.random() < 0.6 else [])
        for _ in range(rng.randrange(1, 7)):
            own = base[:]
            for _ in range(rng.randrange(0, 1 + len(own) // 25)):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = [word()]
            rows.append(" ".join(own))
    rows += rows[:20] + ["a b", "A  b\n", "a", "a b c", "a b c d", "", " ", "a b c d e f g h i j k", "a b c d e f g h i j k l"]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("percent", "size"), [(90, 3), (80, 5), (50, 2)])
def test_matches_all_pairs(documents, percent, size):
    rows = list(enumerate(corpus()))
    assert run(documents(*rows), percent, size) == plain(rows, percent, size)


@pytest.fixture
def tiny_limits(monkeypatch):
    """Chunks, bins and hot shingles of a few sets each."""
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 3)
    monkeypatch.setattr(jaccard, "COUNTED_CHUNK_SETS", 3)
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 400)
    monkeypatch.setattr(jaccard, "HOT_SETS", 4)
    monkeypatch.setattr(jaccard, "BIN_ROWS", 200)


def test_chunks_of_large_blocks_lose_no_link(documents, tiny_limits):
    rows = list(enumerate(corpus(5, 15)))
    assert run(documents(*rows), 80, 3) == plain(rows, 80, 3)


def link_counts(rows, percent, size):
    """With how many other rows each is linked, by all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    linked = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    return sorted((i, sum(bool(linked(a, b)) for m, b in enumerate(sets) if m != n)) for n, ((i, _), a) in enumerate(zip(rows, sets)))


def counted(df, percent, size):
    return sorted((r.doc_id, r.n_links) for r in jaccard_components(df, percent, size, count_links=True).collect())


@pytest.mark.parametrize(("percent", "size"), [(90, 3), (50, 2)])
def test_links_are_counted(documents, percent, size):
    rows = list(enumerate(corpus()))
    assert counted(documents(*rows), percent, size) == link_counts(rows, percent, size)
    assert max(n for _, n in link_counts(rows, percent, size)) > 3


def test_links_across_chunks_are_counted_once(documents, tiny_limits):
    rows = list(enumerate(corpus(5, 15)))
    assert counted(documents(*rows), 80, 3) == link_counts(rows, 80, 3)
    result = jaccard_components(documents(*rows), 80, 3, count_links=True)
    assert sorted((tuple(r)[:3] for r in result.collect()), key=str) == plain(rows, 80, 3)


def test_links_of_a_triangle_and_of_copies(documents):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base, "x"]), " ".join([*base, "y"]), " ".join(base), "", None, "other words here"]
    assert counted(documents(*texts), 90, 3) == [(0, 3), (1, 3), (2, 3), (3, 3), (4, 0), (5, 0), (6, 0)]


def test_the_sketch_grows_with_the_texts_within_bounds(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 4)
    monkeypatch.setattr(jaccard, "MOST_BITS", 9)
    monkeypatch.setattr(jaccard, "TEXT_PER_CELL", 8)
    bits = [jaccard._sketch_bits(documents(*["word " * n]).select("text")) for n in (1, 60, 10_000)]
    assert bits[0] == 4 and 4 < bits[1] < 9 and bits[2] == 9
    rows = list(enumerate(corpus(8, 12)))
    assert run(documents(*rows), 80, 3) == plain(rows, 80, 3)


def test_a_chain_of_near_copies_is_one_component(documents):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words[rng.randrange(120)] = f"x{i}"
        rows.append((200 - i, " ".join(words)))
    assert run(documents(*rows), 80, 3) == plain(rows, 80, 3)


def test_many_near_copies_of_one_text(documents):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        own = base[:]
        own[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(own)))
    got = run(documents(*rows), 80, 3)
    assert {component for _, _, component in got} == {0}


def test_defined_cases(documents):
    assert run(documents()) == []
    rows = [(None, "a b c d"), (None, None), (9, "a b c d"), (9, "a b c d"), (9, "x"), (4, ""), (4, ""), (5, "A B C D"), (6, "é É"), (7, "é é")]
    assert run(documents(*rows, clashing=True)) == plain(rows, 90, 3)
    long = "w1 w2 w3 " * 50_000
    assert run(documents((1, long), (2, long + "w1"), (3, " ".join(f"v{i}" for i in range(30_000))))) == [(1, 3, 1), (2, 3, 1), (3, 29_998, 3)]


def test_one_of_each_group_stays(documents):
    rows = list(enumerate(corpus(7, 12)))
    df = documents(*rows, clashing=True)
    kept = drop_near_copies(df, 80, 3)
    assert kept.columns == df.columns
    assert own_columns_are_kept(kept)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, component in plain(rows, 80, 3) if component == i)


def test_repeated_and_unknown_ids_leave_one_row(documents):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "x y z"), (2, "p q r"), (3, None), (3, None), (None, "k l m"), (None, "k l m")]
    kept = sorted(((r.doc_id, r.text) for r in drop_near_copies(documents(*rows), 80, 3).collect()), key=str)
    assert kept == sorted([(1, "a b c d e"), (2, "x y z"), (2, "p q r"), (3, None), (3, None), (None, "k l m")], key=str)
    assert drop_near_copies(documents()).collect() == []


SETS = st.lists(st.integers(0, 40), min_size=9, max_size=40, unique=True)


@settings(max_examples=200, deadline=None)
@given(SETS, SETS, st.sampled_from([50, 80, 90]))
def test_no_filter_drops_a_link(a, b, percent):
    hashes = jaccard._mixed(np.arange(50, dtype=np.uint64) + np.uint64(7))
    one, two = (np.sort(hashes[x]) for x in (a, b))
    both = len(set(a) & set(b))
    linked = 100 * both >= percent * len(set(a) | set(b))
    assert linked == (both >= jaccard.needed(len(a), len(b), percent))
    if linked:
        assert len(set(a) ^ set(b)) <= max(jaccard.differences(len(x), percent) for x in (a, b))
        first = [set(x[: jaccard.prefix_length(len(x), percent)].tolist()) for x in (one, two)]
        assert first[0] & first[1]
        maps = [jaccard.parity_bits(x, percent) for x in (one, two)]
        close = jaccard._Bitmaps(maps, np.array([len(a), len(b)]), percent).close(np.array([0]), np.array([1]))
        assert close.all()
        assert a == b or all(jaccard.can_differ(len(x), percent) for x in (a, b)) or set(a) == set(b)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {i: 200 for i in range(201, 260)} | {301: 300, 302: 300}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
