"""Exact duplicates by Patricia tries that own byte strings.

Every task first inserts the texts it reads into a trie of its own, so that of a group of copies one string a task
goes on, whatever the group's size. Those strings are dealt by length and content hash; each partition inserts them
whole into a compressed radix trie, whose terminal nodes hold the group: its rows and the identifier that stays. Texts are
compared byte by byte: hashes only deal them. Where so many tasks send one string that they would fill a partition, they
are first merged within salted parts of it.

A trie holds TRIE_BYTES. Beyond that its largest subtree is spilled: the strings below it, and all that come for it
later, are written to the shared folder and meet again in a later round, dealt by subtree. A subtree has fewer strings
than the trie it was cut from, so the rounds end; a single string is never spilled.

Defined cases: a null text is empty; of rows with the identifier that stays one is kept; a null identifier stays
only where a group has no other; an empty table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Callable, Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BATCH_BYTES, in_small_batches, slices, whole_text
from millrace.operators import fit_broadcast
from millrace.sources import stage

TRIE_BYTES = 64 * 1024 * 1024  # of labels and nodes, in one task
PART_BYTES = 32 * 1024 * 1024  # of strings that a partition is dealt, about
FAN_IN = 64  # strings of one length and hash, before they are merged by salted parts
NODE_BYTES = 400
BATCH_ROWS = 4_096


class Node:
    __slots__ = ("label", "kids", "group", "spilled")

    def __init__(self, label: bytes):
        self.label, self.kids, self.group, self.spilled = label, {}, None, None


def common_prefix(a: bytes, b: bytes) -> int:
    """How many bytes two strings share at their start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Byte strings by their common prefixes; a node's label is what its string adds to the one above."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, text: bytes) -> Node:
        """The terminal node of a text, or the mark of a spilled subtree that it belongs to."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            kid = node.kids.get(text[at])
            if kid is None:
                kid = node.kids[text[at]] = Node(text[at:])
                self.size += end - at + NODE_BYTES
                return kid
            if kid.spilled is not None:
                return kid
            if not text.startswith(kid.label, at):
                same = common_prefix(kid.label, text[at : at + len(kid.label)])
                fork = node.kids[text[at]] = Node(kid.label[:same])
                kid.label = kid.label[same:]
                fork.kids[kid.label[0]] = kid
                self.size += NODE_BYTES
                kid = fork
            node, at = kid, at + len(kid.label)
        return node

    @staticmethod
    def groups(top: Node, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """Strings and groups of the terminal nodes from `top` on; `prefix` is what stands above it."""
        pending = [(top, prefix)]
        while pending:
            node, above = pending.pop()
            text = above + node.label
            if node.group is not None:
                yield text, node.group
            pending += [(kid, text) for kid in node.kids.values()]

    def cut_largest(self, mark: int | None = None) -> tuple[Node, bytes] | None:
        """Take out the heaviest subtree of no more than half the trie, or the lightest of all if each is heavier, and
        return it with the string above it; None if there is but one group. With a mark its place stays closed, and
        texts that belong there meet the mark; a subtree with such a place in it stays."""
        order, parents, pending = [], {}, [self.root]
        while pending:
            node = pending.pop()
            order.append(node)
            pending += node.kids.values()
            parents.update((id(kid), node) for kid in node.kids.values())
        weights, groups, whole = {}, {}, {}
        for node in reversed(order):
            kids = [id(kid) for kid in node.kids.values()]
            weights[id(node)] = len(node.label) + NODE_BYTES + sum(weights[kid] for kid in kids)
            groups[id(node)] = (node.group is not None) + sum(groups[kid] for kid in kids)
            whole[id(node)] = node.spilled is None and all(whole[kid] for kid in kids)
        several = [n for n in order if whole[id(n)] and 0 < groups[id(n)] < groups[id(self.root)]]
        if not several:
            return None
        light = [n for n in several if 2 * weights[id(n)] <= weights[id(self.root)]]
        top = max(light, key=lambda n: weights[id(n)]) if light else min(several, key=lambda n: weights[id(n)])
        above, node = [], parents[id(top)]
        while node is not self.root:
            above.append(node.label)
            node = parents[id(node)]
        first = top.label[0]
        del parents[id(top)].kids[first]
        self.size -= weights[id(top)]
        if mark is not None:
            closed = parents[id(top)].kids[first] = Node(b"")
            closed.spilled = mark
        return top, b"".join(reversed(above))


class _Rows:
    """Rows for the output, handed on in batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, text: bytes | None = None) -> Iterator[pa.RecordBatch]:
        self.rows.append((*row, text))
        self.size += len(text or b"")
        if len(self.rows) >= BATCH_ROWS or self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(values, field.type) for values, field in zip(zip(*self.rows), self.schema)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _better(largest: bool) -> Callable[[tuple, tuple], tuple]:
    """Which of two (identifier, task, row) stays; an identifier beats none."""
    if largest:
        return lambda a, b: max(a, b, key=lambda x: (x[0] is not None, *x))
    return lambda a, b: min(a, b, key=lambda x: (x[0] is None, *x))


def _schema(id_type: pa.DataType, **fields: object) -> tuple[pa.Schema, str]:
    """Arrow fields and their Spark names; True stands for the identifier's type."""
    spark = {pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    kinds = {name: id_type if kind is True else kind for name, kind in fields.items()}
    return pa.schema(kinds.items()), ", ".join(f"{name} {spark.get(kind, '@')}" for name, kind in kinds.items())


def _local(own: DataFrame, id_type: pa.DataType, id_kind: str, largest: bool, limit: int) -> DataFrame:
    """Rows (identifier, at, node) and, with a text, the strings of the task's trie: node, owner, owner_at, n, size."""
    long = pa.int64()
    schema, spelled = _schema(
        id_type, id=True, at=long, task=long, node=long, owner=True, owner_at=long, n=long, size=long, text=pa.binary()
    )
    better = _better(largest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, trie, out, at, nodes = TaskContext.get().partitionId(), Trie(), _Rows(schema), 0, 0

        def hand_on(top: Node, above: bytes) -> Iterator[pa.RecordBatch]:
            for text, (node, best, n) in Trie.groups(top, above):
                yield from out.add((None, None, task, node, best[0], best[2], n, len(text)), text)

        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for key, text in zip(batch.column(0).to_pylist(), texts):
                terminal, own_place = trie.insert(text), (key, task, at)
                if terminal.group is None:
                    terminal.group = (nodes, own_place, 1)
                    nodes += 1
                else:
                    node, best, n = terminal.group
                    terminal.group = (node, better(best, own_place), n + 1)
                yield from out.add((key, at, task, terminal.group[0], None, None, None, None))
                at += 1
                while trie.size > limit and (cut := trie.cut_largest()):
                    yield from hand_on(*cut)
        yield from hand_on(trie.root, b"")
        yield from out.flush()

    return in_small_batches(own).mapInArrow(run, spelled.replace("@", id_kind))


def _merge(strings: DataFrame, id_type: pa.DataType, id_kind: str, largest: bool, limit: int, last: bool) -> DataFrame:
    """One trie for each subtree in a partition. A string (task, node) comes out in one of three ways:

    - with `digest` and its whole group, if the trie kept its terminal node;
    - with `rep_task` and `rep_node`, the string it is equal to, if that one goes on to the next round;
    - with `text`, itself the one that goes on, its subtree and what the group holds so far.
    """
    long = pa.int64()
    schema, spelled = _schema(
        id_type, task=long, node=long, owner=True, owner_task=long, owner_at=long, n=long, digest=pa.string(),
        rep_task=long, rep_node=long, subtree=long, size=long, text=pa.binary(),
    )
    better = _better(largest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, trie, out, current, marks = TaskContext.get().partitionId(), Trie(), _Rows(schema), None, 0

        def hand_on(top: Node, above: bytes, subtree: int) -> Iterator[pa.RecordBatch]:
            for text, (best, n, members) in Trie.groups(top, above):
                first = members[0]
                yield from out.add((*first, *best, n, None, None, None, subtree, len(text)), text)
                for member in members[1:]:
                    yield from out.add((*member, None, None, None, None, None, *first, None, None))

        def finish() -> Iterator[pa.RecordBatch]:
            if not last:
                yield from hand_on(trie.root, b"", 0)
                return
            for text, (best, n, members) in Trie.groups(trie.root):
                digest = hashlib.sha256(text).hexdigest()
                for member in members:
                    yield from out.add((*member, *best, n, digest, None, None, None, None))

        for batch in slices(batches):
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for task, node, owner, owner_task, owner_at, n, subtree, text in zip(*columns):
                if subtree != current:
                    yield from finish()
                    trie, current = Trie(), subtree
                terminal, best = trie.insert(text), (owner, owner_task, owner_at)
                if terminal.spilled is not None:
                    yield from out.add((task, node, *best, n, None, None, None, terminal.spilled, len(text)), text)
                elif terminal.group is None:
                    terminal.group = (best, n, [(task, node)])
                else:
                    other, sum_, members = terminal.group
                    members.append((task, node))
                    terminal.group = (better(other, best), sum_ + n, members)
                while trie.size > limit and (cut := trie.cut_largest(mark := (part << 32) + marks)):
                    marks += 1
                    yield from hand_on(*cut, mark)
        yield from finish()
        yield from out.flush()

    columns = ["task", "node", "owner", "owner_task", "owner_at", "n", "subtree", "text"]
    return in_small_batches(strings.select(*columns)).mapInArrow(run, spelled.replace("@", id_kind))


def _parts(strings: DataFrame, part_bytes: int) -> int:
    return max(1, ceil((strings.agg(F.sum("size")).first()[0] or 0) / part_bytes))


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    largest: bool = False,
    normalize: Callable[[Column], Column] = lambda text: text,
    trie_bytes: int = TRIE_BYTES,
    part_bytes: int = PART_BYTES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row; texts are equal if identical once normalized.

    Of equal texts the row with the smallest identifier stays, or the largest. Texts are shuffled once, a string a
    task; the rows follow as numbers, dealt by their own task and node, so no group is hot there.
    """
    own = docs.select(F.col(doc_id).alias("id"), normalize(whole_text(text)).alias("text"))
    id_kind = own.schema["id"].dataType.simpleString()
    id_type = own.select("id").limit(0).toArrow().schema.field(0).type
    options = (id_type, id_kind, largest, trie_bytes)
    # Staged, as the numbers of tasks and nodes must not change once they are in use.
    local = stage(_local(own, *options).withColumn("hash", F.xxhash64("text")), "strings")
    strings = local.where(F.col("text").isNotNull()).select(
        "task", "node", "owner", F.col("task").alias("owner_task"), "owner_at", "n", "size", "hash", "text",
        F.lit(0).cast("bigint").alias("subtree"),
    )
    passes = []
    hot = stage(strings.groupBy("size", "hash").agg(F.count("*").alias("many")).where(F.col("many") > fan_in), "hot")
    if not hot.isEmpty():
        (few,) = fit_broadcast([hot])
        told = strings.join(F.broadcast(hot) if few else hot, ["size", "hash"], "left")
        salted = told.where("many is not null").withColumn("salt", F.col("task") % F.ceil(F.sqrt("many")))
        parts = _parts(salted, part_bytes)
        passes.append(stage(_merge(salted.repartition(parts, "size", "hash", "salt"), *options, last=False), "strings"))
        fewer = passes[-1].where(F.col("text").isNotNull()).withColumn("hash", F.xxhash64("text"))
        strings = told.where("many is null").drop("many").unionByName(fewer, allowMissingColumns=True)
    dealt = strings.repartition(_parts(strings, part_bytes), "size", "hash")
    while True:
        passes.append(stage(_merge(dealt, *options, last=True), "strings"))
        spilled = passes[-1].where(F.col("text").isNotNull())
        if spilled.isEmpty():
            break
        dealt = spilled.repartition(_parts(spilled, part_bytes), "subtree").sortWithinPartitions("subtree")

    group = ["owner", "owner_task", "owner_at", "n", "digest"]
    ended = [p.where(F.col("digest").isNotNull()).select("task", "node", *group) for p in passes]
    known = ended.pop()
    for earlier, own_end in zip(reversed(passes[:-1]), reversed(ended)):
        told = earlier.where(F.col("rep_node").isNotNull()).select("task", "node", "rep_task", "rep_node")
        reps = known.select(F.col("task").alias("rep_task"), F.col("node").alias("rep_node"), *group)
        through = told.join(reps, ["rep_task", "rep_node"]).drop("rep_task", "rep_node")
        known = stage(known.unionByName(own_end).unionByName(through), "strings")
    rows = local.where(F.col("at").isNotNull()).select("id", "at", "task", "node")
    return rows.join(known, ["task", "node"]).select(
        F.col("id").alias("doc_id"),
        F.col("owner").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("task") == F.col("owner_task")) & (F.col("at") == F.col("owner_at"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
