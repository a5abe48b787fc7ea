from conftest import own_columns_are_kept

from millrace.llm.mixing import copies_per_document, mix


def plain_targets(sizes):
    """Sources by weight, the excess over thrice a size shared again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    bounded, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in bounded]
        level = (total - sum(bounded.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not above:
            return bounded | {s: weight[s] * level for s in free}
        bounded |= {s: 3.0 * sizes[s] for s in above}


def build(documents):
    rows, i = [], 0
    for source, n, words in (("b", 300, 10), ("a", 40, 3), (None, 200, 20), ("é", 5, 1), ("Z", 900, 30)):
        for _ in range(n):
            rows.append((i, " w" * (1 + (i * 7 + words) % (2 * words)), source))
            i += 1
    return rows


def test_targets_and_copies(documents):
    rows = build(documents)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = plain_targets(sizes)
    source_of = {i: source for i, _, source in rows}
    got = copies_per_document(documents(*rows)).collect()
    taken = {}
    for row in got:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source]
        assert abs(row.target - want[source]) < 1e-6 * want[source]
        rate = row.target / row.source_size
        assert int(rate) <= row.copies <= min(3, int(rate) + 1)
        taken[source] = taken.get(source, 0) + row.size * row.copies
    for source in ("b", None, "Z"):
        assert abs(taken[source] - want[source]) < 0.12 * want[source]
    assert sorted(got) == sorted(copies_per_document(documents(*reversed(rows))).collect())


def test_mixed_rows_are_those_taken(documents):
    df = documents(*build(documents), clashing=True)
    copies = {row.doc_id: row.copies for row in copies_per_document(df).collect() if row.copies}
    mixed = mix(df)
    assert mixed.columns == df.columns
    assert own_columns_are_kept(mixed)
    assert {row.doc_id: row["count"] for row in mixed.groupBy("doc_id").count().collect()} == copies


def test_defined_cases(documents):
    assert copies_per_document(documents()).collect() == []
    assert mix(documents()).collect() == []
    empty = copies_per_document(documents((1, None), (2, ""), (3, " \n", None))).collect()
    assert {(row.size, row.target, row.copies) for row in empty} == {(0, 0.0, 0)}
    odd = documents((None, "a b"), (None, "a b"), (None, "c"), (7, "d"), (7, "d"), (8, "w " * 200_000))
    got = copies_per_document(odd).collect()
    assert len(got) == 6
    assert len({row.copies for row in got if row.doc_id is None and row["size"] == 2}) == 1
    assert len({row.copies for row in got if row.doc_id == 7}) == 1
    assert max(row["size"] for row in got) == 200_000
