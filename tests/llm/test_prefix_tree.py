import hashlib
import random
import zlib

import pytest

from millrace.llm import prefix_tree

TURN = "conv_id bigint, turn bigint, role string, text string, key string, task string"


def plain(rows):
    """Nodes by listing every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(head, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = {}
    for prefix in sorted(members, key=len, reverse=True):
        ids = sorted(members[prefix])
        saved = (len(ids) - 1) * (len(prefix[-1][1]) if prefix else 0)
        ends = ",".join(str(c) for c in ids if len(rebuilt[c]) == len(prefix))
        kids = found.pop(("kids", prefix), [0, 0, 0])
        total = [kids[0], kids[1] or 1, kids[2] + saved]
        if prefix:
            up = found.setdefault(("kids", prefix[:-1]), [0, 0, 0])
            up[0], up[1], up[2] = up[0] + 1, up[1] + total[1], up[2] + total[2]
        parent = min(members[prefix[:-1]]) if prefix else None
        found[prefix] = (ids[0], len(prefix), parent, len(ids), *total, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(found.values(), key=str)


def result(spark, rows, parts=3):
    df = spark.createDataFrame([(*row, "own key", "own task") for row in rows], TURN).repartition(parts)
    nodes = prefix_tree.prefix_nodes(*prefix_tree.shared_starts(prefix_tree.numbered_turns(df)))
    assert nodes.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return sorted(map(tuple, nodes.collect()), key=str)


def conversations(seed, ids, turns, alphabet):
    rng = random.Random(seed)
    return [
        (c, t, "user" if t % 2 == 0 else "assistant", rng.choice(alphabet) * rng.randrange(1, 3))
        for c in ids
        for t in range(rng.randrange(1, turns))
    ]


def test_equals_plain(spark):
    rows = conversations(1, [*range(150), 205, 1_000, 1_003], 9, ["a", "bé", ""])
    assert result(spark, rows) == plain(rows)


def test_two_texts_only(spark):
    rows = conversations(2, range(0, 300, 3), 6, ["x"])
    assert result(spark, rows) == plain(rows)


def test_deep_conversations(spark):
    """Long chains, some with branches on the way, are gone in few rounds."""
    rng = random.Random(3)
    rows = [(c, t, "user", str(t) if t < 40 * c else f"{c}:{t}") for c in range(1, 5) for t in range(rng.randrange(200, 300))]
    rows += [(0, t, "user", str(t)) for t in range(3)]
    assert result(spark, rows) == plain(rows)


def test_hot_conversation_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(prefix_tree, "HOT_CHILDREN", 2)
    rows = conversations(4, range(60), 5, ["a", "b", "c", "d"]) + [(7, 100 + t, "user", "same") for t in range(150)]
    assert result(spark, rows) == plain(rows)


def test_defined_cases(spark):
    rows = [
        (None, 1, "user", "nobody"), (100, None, None, None), (100, 2, "user", "a"), (100, 2, "assistant", "a"),
        (100, 2, "user", "a"), (101, 1, "", ""), (101, None, "user", None), (-5, 1, "user", "b"), (0, 1, "user", "b"),
        (102, 1, "user", "x" * 100_000), (103, 1, "user", "x" * 100_000 + "y"), (399, 0, "user", "headless"),
    ]
    assert result(spark, rows) == plain(rows)
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "a")]) == []


def test_rounds_follow_the_logarithm(spark, monkeypatch):
    """A chain of a thousand nodes, a star and a caterpillar in few rounds, with right totals."""
    written = []
    original = prefix_tree.stage
    monkeypatch.setattr(prefix_tree, "stage", lambda df, label="stage": written.append(label) or original(df, label))
    chain = [(i, i - 1 if i else None, i, 1 if i < 999 else 0) for i in range(1_000)]
    df = spark.createDataFrame([(*row, 1) for row in chain], "id bigint, parent bigint, depth bigint, n_children bigint, v bigint")
    got = {r.id: r.v for r in prefix_tree.subtree_totals(df, ["v"]).collect()}
    assert got == {i: 1_000 - i for i in range(1_000)}
    assert len(written) < 4 * 13
    legs = [(1_000 + i, i, i + 1, 0) for i in range(200)]
    spine = [(i, i - 1 if i else None, i, 2 if i < 199 else 1) for i in range(200)]
    df = spark.createDataFrame([(*row, 1) for row in legs + spine], df.schema)
    got = {r.id: r.v for r in prefix_tree.subtree_totals(df, ["v"]).collect()}
    assert got == {i: 2 * (200 - i) for i in range(200)} | {1_000 + i: 1 for i in range(200)}


@pytest.mark.parametrize("seed", range(3))
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    parent = [None] + [rng.randrange(max(0, i - rng.choice([1, 2, 30])), i) for i in range(1, 400)]
    depth, kids, total = [0] * 400, [0] * 400, [0] * 400
    for i in range(1, 400):
        depth[i] = depth[parent[i]] + 1
        kids[parent[i]] += 1
    for i in range(399, -1, -1):
        total[i] += i
        if i:
            total[parent[i]] += total[i]
    df = spark.createDataFrame(
        [(i, parent[i], depth[i], kids[i], i) for i in range(400)],
        "id bigint, parent bigint, depth bigint, n_children bigint, v bigint",
    )
    assert {r.id: r.v for r in prefix_tree.subtree_totals(df, ["v"]).collect()} == dict(enumerate(total))
