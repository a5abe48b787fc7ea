"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns, known by its depth and a 128-bit sum of hashes of its turns with their
places; such sums are running totals, so no task needs a whole conversation. The node's name is its depth and its
smallest member.

Totals over subtrees come by contraction. In a round the leaves are raked: each adds what it has to its parent and is
done. Then unary chains are compressed: a node with one child is taken out, its own part put on the edge from the child
to its parent, and noted; chosen are nodes with a given bit of the depth set whose child is not chosen itself, which
halves a chain of any length. A tree of N nodes is gone in about log N rounds, whether deep or wide. The notes are then
read backwards, and every node that was taken out gets its child's total and the part between them. Each round is a few
joins on unique keys and one aggregate, staged.

Defined cases: rows without a conversation id take no part; a null role or text is empty; turns are ordered by turn
(null first), then role, then text (by their first 64 characters before the whole); repeated rows are turns of
their own; an empty table has no node, not even a root; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import in_small_batches
from millrace.operators import fit_broadcast, join_lookup
from millrace.sources import stage

ROWS_PER_TASK = 500_000
MIN_ROWS_PER_TASK = 2_000
SHARED_TURNS = 6  # a conversation shares fewer turns than this
FAMILY = 100
HOT_CHILDREN = 100_000  # nodes with more children are broadcast to them; there is one among so many nodes at most
PLACE_BITS = 33

SUMS = ["s0", "s1", "s2", "s3"]
KEY = ["depth", *SUMS]


def running(rows: DataFrame, group: str, order: Sequence[Column], sums: Sequence[str], keep: Sequence[str], tasks: int = 0) -> DataFrame:
    """`keep` columns of the rows, and running totals of `sums` within the group, in the order given.

    Rows are dealt by ranges of the whole order, so a large group spreads over tasks; the totals of a group's rows in
    earlier tasks are added, which only the first group of a task has, so there is one such row a task.
    """
    if not tasks:
        n = rows.count()
        small = min(2 * rows.sparkSession.sparkContext.defaultParallelism, n // MIN_ROWS_PER_TASK)
        tasks = max(1, ceil(n / ROWS_PER_TASK), small)
    # Equal rows are told apart by their place in the input, and may change places.
    ranged = rows.withColumn("own_row", F.monotonically_increasing_id()).repartitionByRange(tasks, group, *order, "own_row")
    ordered = ranged.sortWithinPartitions(group, *order)
    numbered = ordered.select(group, *keep, *sums, F.monotonically_increasing_id().alias("place"))
    placed = stage(numbered, "running").withColumn("task", F.shiftright("place", PLACE_BITS))
    inside = Window.partitionBy("task", group).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.groupBy("task", group).agg(*[F.sum(name).alias(name) for name in sums])
    earlier = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("task", group, *[F.sum(name).over(earlier).alias(f"{name}_before") for name in sums])
    offsets = before.where(F.col(f"{sums[0]}_before").isNotNull())
    own = placed.select("task", group, *keep, *[F.sum(name).over(inside).alias(name) for name in sums])
    joined = own.join(F.broadcast(offsets), ["task", group], "left")
    added = [(F.col(name) + F.coalesce(F.col(f"{name}_before"), F.lit(0))).alias(name) for name in sums]
    return joined.select(group, *keep, *added)


def numbered_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, pos (from 1), two hashes of role and text, and the text's length; staged."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.lit(1).cast("bigint").alias("pos"),
    )
    hashed = rows.select(
        "*", F.xxhash64("role", "text").alias("first"), F.xxhash64(F.lit(7), "text", "role").alias("second"),
        F.length("text").cast("bigint").alias("chars"),
    )
    order = [F.col("turn"), F.left("role", F.lit(64)), F.left("text", F.lit(64)), F.xxhash64("role", "text")]
    return stage(running(hashed, "conv_id", order, ["pos"], ["first", "second", "chars"]), "turns")


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first turns of the one that heads their hundred: rebuilt turns (conv_id, depth, first,
    second, chars, last), and conversations (conv_id, total). `turns` comes from `numbered_turns`."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = stage(counted.select("conv_id", "n", shared.alias("shared"), head.alias("head")), "conversations")
    # No more than two hundred conversations have one head.
    heads = own.where(F.col("conv_id") == F.col("head")).select("head", F.col("n").alias("head_n"))
    taken = F.least("shared", F.coalesce("head_n", F.lit(0)))
    total = taken + F.greatest(F.col("n") - F.col("shared"), F.lit(0))
    sized = own.join(heads, "head", "left").select("conv_id", "head", "shared", taken.alias("taken"), total.alias("total"))
    convs = stage(sized, "conversations")
    of_heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED_TURNS))
    given = of_heads.withColumnRenamed("conv_id", "head").join(convs, "head").where(F.col("pos") <= F.col("shared"))
    columns = ["conv_id", "depth", "first", "second", "chars", (F.col("depth") == F.col("total")).alias("last")]
    rest = join_lookup(turns.where(F.col("pos") > shared), convs, "conv_id")
    moved = rest.withColumn("depth", F.col("pos") - F.col("shared") + F.col("taken"))
    return given.withColumn("depth", F.col("pos")).select(*columns).unionByName(moved.select(*columns)), convs.select("conv_id", "total")


def _nodes(rebuilt: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every node, staged, with its key, its parent's key and its members; and the node that each conversation ends at."""
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))
    one, two = F.xxhash64("depth", "first", "second"), F.xxhash64(F.lit(7), "second", "first", "depth")
    # Sums of halves fit 64 bits for two thousand million turns.
    halves = [low(one), F.shiftrightunsigned(one, 32), low(two), F.shiftrightunsigned(two, 32)]
    hashed = rebuilt.select("*", *[half.alias(name) for half, name in zip(halves, SUMS)])
    own = [F.col(name).alias(f"own_{name}") for name in SUMS]
    keep = ["depth", "chars", "last", *[f"own_{name}" for name in SUMS]]
    summed = stage(running(hashed.select("*", *own), "conv_id", [F.col("depth")], SUMS, keep), "prefixes")
    above = [F.max(F.col(name) - F.col(f"own_{name}")).alias(f"up_{name}") for name in SUMS]
    members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    below = summed.groupBy(*KEY).agg(*members, F.max("chars").alias("chars"), *above)
    zeros = [F.lit(0).cast("bigint").alias(name) for name in KEY]
    nothing = [F.lit(None).cast("bigint").alias(f"up_{name}") for name in SUMS]
    root = convs.agg(*members).where("n_convs > 0").select(*zeros, "conv_id", "n_convs", zeros[0].alias("chars"), *nothing)
    ends = summed.where("last").select(*KEY, "conv_id")
    turnless = convs.where("total = 0").select(*zeros, "conv_id")
    return stage(below.unionByName(root), "nodes"), ends.unionByName(turnless)


def _related(nodes: DataFrame) -> DataFrame:
    """The nodes with n_children and parent_conv_id, staged."""
    up = ((F.col("depth") - 1).alias("depth"), *[F.col(f"up_{name}").alias(name) for name in SUMS])
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    counted = stage(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    up_key = [f"up_{name}" for name in KEY]
    below = counted.withColumn("up_depth", F.col("depth") - 1)
    parents = counted.select(*[F.col(n).alias(f"up_{n}") for n in KEY], F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = parents.where(F.col("n_children") > HOT_CHILDREN).drop("n_children")
    cold = parents.where(F.col("n_children").between(1, HOT_CHILDREN)).drop("n_children")
    (few,) = fit_broadcast([hot])
    # Of the two joins one finds the parent, none the root's.
    first = below.join(F.broadcast(hot) if few else hot, up_key, "left")
    found = first.where(F.col("parent_conv_id").isNotNull() | (F.col("depth") == 0))
    missing = first.where(F.col("parent_conv_id").isNull() & (F.col("depth") > 0)).drop("parent_conv_id")
    return stage(found.unionByName(missing.join(cold, up_key)).drop(*up_key), "nodes")


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """id and the totals of `values` over each node's subtree, by rake and compress.

    `tree`: id, parent (null at a root), depth (greater than the parent's), n_children and the values, bigint.
    """
    edge = [f"edge_{name}" for name in values]
    state = tree.select(
        "id", "parent", "depth", F.col("n_children").alias("kids"), *values, *[F.lit(0).cast("bigint").alias(e) for e in edge]
    )
    bits = max(1, int(tree.agg(F.max("depth")).first()[0] or 0).bit_length())
    state = stage(state, "contraction")
    done, notes, rounds = [], [], 0
    while not state.isEmpty():
        # Rake.
        leaf = F.col("kids") == 0
        done.append(state.where(leaf).select("id", *values))
        given = [F.sum(F.col(name) + F.col(e)).alias(f"given_{name}") for name, e in zip(values, edge)]
        raked = state.where(leaf & F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("gone"), *given)
        more = [(F.col(name) + F.coalesce(f"given_{name}", F.lit(0))).alias(name) for name in values]
        left = (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids")
        rest = stage(state.where(~leaf).join(raked, "id", "left").select("id", "parent", "depth", left, *more, *edge), "contraction")
        # Compress.
        unary = (F.col("kids") == 1) & F.col("parent").isNotNull()
        heads = F.shiftright("depth", rounds % bits) % 2 == 1
        chosen = rest.where(unary & heads).select(
            F.col("id").alias("parent"), F.col("parent").alias("up"), *[F.col(name).alias(f"up_{name}") for name in values],
            *[F.col(e).alias(f"up_{e}") for e in edge],
        )
        pairs = rest.where(~(unary & heads)).join(chosen, "parent")
        between = [(F.col(f"up_{name}") + F.col(e)).alias(name) for name, e in zip(values, edge)]
        shift = [(F.col(f"up_{name}") + F.col(f"up_{e}")).alias(f"shift_{name}") for name, e in zip(values, edge)]
        note = stage(pairs.select(F.col("parent").alias("id"), F.col("id").alias("child"), "up", *between, *shift), "contraction")
        out, moved = note.select("id"), note.select(F.col("child").alias("id"), "up", *[f"shift_{name}" for name in values])
        longer = [(F.col(e) + F.coalesce(f"shift_{name}", F.lit(0))).alias(e) for name, e in zip(values, edge)]
        state = stage(
            rest.join(out, "id", "left_anti").join(moved, "id", "left")
            .select("id", F.coalesce("up", "parent").alias("parent"), "depth", "kids", *values, *longer),
            "contraction",
        )
        notes.append(note)
        rounds += 1
    if not done:
        return tree.select("id", *values)
    # Expand: a node that was taken out has its child's total and what lay between.
    for note in reversed(notes):
        if note.isEmpty():
            continue
        totals = reduce(DataFrame.unionByName, done).select(F.col("id").alias("child"), *[F.col(v).alias(f"sub_{v}") for v in values])
        sums = [(F.col(v) + F.col(f"sub_{v}")).alias(v) for v in values]
        done.append(stage(note.join(totals, "child").select("id", *sums), "contraction"))
    return reduce(DataFrame.unionByName, done)


def _ends(ends: DataFrame) -> DataFrame:
    """The node's key and the hash of its conversations' ids in ascending order. A hash is made in one go, so a
    node's ids pass through one task, one after the other and never together."""
    schema = pa.schema([*[(name, pa.int64()) for name in KEY], ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            *columns, ids = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            found = []
            for key, conv in zip(zip(*columns), ids):
                if key == current:
                    digest.update(b",%d" % conv)
                    continue
                if current is not None:
                    found.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(b"%d" % conv)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*current, digest.hexdigest()), schema)], schema=schema)

    sorted_ends = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return in_small_batches(sorted_ends).mapInArrow(run, ", ".join(f"{name} bigint" for name in KEY) + ", ends_sha256 string")


def prefix_nodes(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. `rebuilt` and `convs` as `shared_starts` gives them."""
    keyed, ends = _nodes(rebuilt, convs)
    nodes = _related(keyed)
    name = lambda conv, depth: F.struct(F.col(conv).alias("conv_id"), depth.alias("depth"))
    parent = F.when(F.col("parent_conv_id").isNotNull(), name("parent_conv_id", F.col("depth") - 1))
    tree = nodes.select(
        name("conv_id", F.col("depth")).alias("id"), parent.alias("parent"), "depth", "n_children",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"]).select("id.conv_id", "id.depth", "n_leaves", "saved_tokens")
    joined = nodes.join(totals, ["conv_id", "depth"]).join(_ends(ends), KEY, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
