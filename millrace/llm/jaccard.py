"""N-gram Jaccard join: links between texts whose sets of word shingles overlap enough, and their components.

1. Every text becomes a set of hashed shingles. A sketch, sized by the texts within bounds and summed over all of
   them, says about how frequent a shingle is; it orders all shingles, rare ones first. Any order gives right results.
2. Texts with equal sets fall together. Two linked sets share a shingle among the first few of either. Of
   the sets that share one, those stay candidates whose parity bitmaps differ in no more bits than linked
   sets can differ in shingles; the bits never differ in more. The components over the candidates, the
   blocks, hold every link.
3. The sets of a block are joined in a prefix tree: ordered by their frequency within the block, sets with
   a common beginning share its nodes. A set goes down the tree with the overlap so far and leaves a
   subtree when what remains cannot reach the overlap it needs, when the sizes do not fit, or when it is
   linked to everything in it already. Blocks too large for one task are cut into chunks, and every pair
   of chunks is joined. Where links are to be counted, no subtree is left for being linked: every pair of
   different sets is tested once, and a set's links are weighed by the partners' copies.

Texts are read three times rather than shuffled; sets are shuffled only for blocks of two and more.
Shingles are compared by 64-bit hashes, sets by 128-bit ones.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; with
fewer words than a shingle has, the whole sequence is one shingle; repeated rows are copies and linked; a
null id counts as larger than every other; an empty table gives no rows; further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, in_small_batches, quoted, row_key, slices, whole_text
from millrace.llm.graph import components
from millrace.operators import fresh_name
from millrace.sources import read_parquet, stage, staged_job, staging_path

SKETCH_BITS = 20  # cells of the frequency sketch, 4 MB broadcast; MOST_BITS for a large corpus, 64 MB
MOST_BITS = 24
TEXT_PER_CELL = 512  # bytes of text for which a cell is added
SKETCH_PARTS = 8
SKETCHES_AT_ONCE = 64  # summed in one group
FILTER_BYTES = 3  # of a signature; as many bits tell which sets a block needs: 2 MB are broadcast
CHUNK_SHINGLES = 500_000  # in one task, times two
CHUNK_SETS = 2_000
COUNTED_CHUNK_SETS = 500  # where links are counted, as all pairs of a chunk are then looked at
BITS_PER_DIFFERENCE = 4  # of a parity bitmap, for each shingle in which linked sets can differ
BIN_ROWS = 200_000  # shared shingles that one task looks at
HOT_SETS = 4_096  # with one shingle; more are cut into chunks
SMALL_SETS = 32  # with one shingle; all their pairs are taken at once
PAIRS_AT_ONCE = 200_000
LABELS = 8  # components a tree node keeps track of

def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct shingles' hashes, ascending; words are those between ASCII blanks, A-Z in lower case."""
    # In bytes, only A-Z turn to lower case, and only ASCII blanks split.
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), dtype="<u8")
    width = min(size, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, np.uint64(width))
    with np.errstate(over="ignore"):
        for i in range(width):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return np.unique(total)


def needed(a: int, b: int, percent: int) -> int:
    """The smallest overlap of sets of these sizes whose Jaccard similarity is `percent` or more."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Two linked sets share one of so many first shingles of either."""
    return n - -(-percent * n // 100) + 1


def differences(n: int, percent: int) -> int:
    """In how many shingles a set of this size and one linked with it can differ."""
    largest = 100 * n // percent
    return n + largest - 2 * needed(n, largest, percent)


def parity_bits(hashes: np.ndarray, percent: int) -> np.ndarray:
    """One bit per cell: whether an odd number of the shingles falls into it. Sets that differ in d shingles
    differ in d bits at most. The number of bits, a power of two, grows with the set."""
    size = max(64, 1 << (BITS_PER_DIFFERENCE * differences(len(hashes), percent) - 1).bit_length())
    cells = ((hashes >> np.uint64(8)) % np.uint64(size)).astype(np.int64)
    odd = np.bincount(cells, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def can_differ(n: int, percent: int) -> bool:
    """Whether a set of this size can be linked with another than its equal: one shingle more or less."""
    return 100 * n >= percent * (n + 1) or 100 * (n - 1) >= percent * n


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _sketch_bits(own: DataFrame) -> int:
    """The size of the sketch: with the texts, within bounds."""
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(SKETCH_BITS, (total // TEXT_PER_CELL).bit_length()), MOST_BITS)


def _text_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The rows and their shingle sets, some hundred at a time."""
    for part in slices(batches):
        yield part, [shingle_set(text, size) for text in part.column("text").to_pylist()]


def frequency_sketch(own: DataFrame, size: int) -> np.ndarray:
    """How many texts have a shingle in each cell, over all texts; partial sketches are summed in rounds."""
    bits = _sketch_bits(own)
    width = (1 << bits) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for _, sets in _text_batches(batches, size):
            np.add.at(total, _cells(np.concatenate(sets), bits), 1)
        if total.any():
            task = TaskContext.get().partitionId()
            parts = [zstandard.compress(part.tobytes(), 1) for part in total.reshape(SKETCH_PARTS, width)]
            columns = [range(SKETCH_PARTS), [task] * SKETCH_PARTS, parts]
            types = [pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "task", "cells"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for cells in rows["cells"]:
            total += np.frombuffer(zstandard.decompress(cells), dtype=np.int64)
        return pd.DataFrame(
            {"part": [rows["part"].iloc[0]], "task": [rows["task"].iloc[0]], "cells": [zstandard.compress(total.tobytes(), 1)]}
        )

    kinds = "part bigint, task bigint, cells binary"
    sketches = stage(own.select("text").mapInArrow(count, kinds), "sketch")
    tasks = (sketches.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        sketches = sketches.withColumn("task", F.floor(F.col("task") / SKETCHES_AT_ONCE))
        sketches = stage(sketches.groupBy("part", "task").applyInPandas(add, kinds), "sketch")
        tasks = -(-tasks // SKETCHES_AT_ONCE)
        if tasks == 1:
            break
    found = np.zeros((SKETCH_PARTS, width), dtype=np.int64)
    for row in sketches.collect():  # a few parts
        found[row["part"]] = np.frombuffer(zstandard.decompress(row["cells"]), dtype=np.int64)
    return np.minimum(found.ravel(), 2**31 - 1).astype(np.int32)


class _Links:
    """Which sets are linked already, as a forest."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return int(x)

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[a] = b
        return a != b

    def roots(self, numbers: np.ndarray) -> np.ndarray:
        found = self.parent[numbers]
        while (above := self.parent[found]).tobytes() != found.tobytes():
            found = above
        return found


class _Bitmaps:
    """Parity bitmaps of many sets. A bitmap folds to half its size, so sets of neighbouring sizes compare."""

    def __init__(self, bitmaps: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.sizes, self.percent = sizes, percent
        self.widths = np.array([len(b) for b in bitmaps])
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in np.unique(self.widths).tolist():
            own, double = np.flatnonzero(self.widths == width), np.flatnonzero(self.widths == 2 * width)
            rows = [bitmaps[i] for i in own] + [bitmaps[i][:width] ^ bitmaps[i][width:] for i in double]
            place = np.full(len(bitmaps), -1)
            place[np.concatenate([own, double])] = np.arange(len(rows))
            self.by_width[width] = (np.array(rows), place)

    def close(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of pairs, whether they can be linked, by their sizes and bits."""
        na, nb = self.sizes[a], self.sizes[b]
        most = na + nb - 2 * -(-self.percent * (na + nb) // (100 + self.percent))
        can = (100 * np.minimum(na, nb) >= self.percent * np.maximum(na, nb)) & (most >= 0)
        width = np.minimum(self.widths[a], self.widths[b])
        for w, (rows, place) in self.by_width.items():
            at = np.flatnonzero(can & (width == w))
            pa_, pb_ = place[a[at]], place[b[at]]
            # Widths further apart are not compared; sizes that fit never have them.
            both = (pa_ >= 0) & (pb_ >= 0)
            at, pa_, pb_ = at[both], pa_[both], pb_[both]
            for start in range(0, len(at), PAIRS_AT_ONCE // max(1, w // 8)):
                part = slice(start, start + PAIRS_AT_ONCE // max(1, w // 8))
                bits = np.bitwise_count(rows[pa_[part]] ^ rows[pb_[part]]).sum(axis=1, dtype=np.int64)
                can[at[part]] = bits <= most[at[part]]
        return can


def candidate_links(rows: pd.DataFrame, sets: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between sets that share a prefix shingle and may be similar enough, as many as connect them.

    `rows`: token, low, high and id; sets of one token meet, or those of its chunks low and high.
    """
    none = pd.DataFrame({"a": [], "b": []}, dtype="int64")
    if rows.empty:
        return none
    sets = sets.sort_values("set", kind="stable")
    ids = sets["set"].to_numpy()
    bitmaps = _Bitmaps([np.frombuffer(x, dtype=np.uint64) for x in sets["bits"]], sets["n"].to_numpy(), percent)
    links, found = _Links(len(ids)), []
    rows = rows.sort_values(["token", "low", "high", "id"], kind="stable")
    numbers = np.searchsorted(ids, rows["id"].to_numpy())
    keys = rows[["token", "low", "high"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    counts = np.diff(np.r_[starts, len(rows)])

    def connect(a: np.ndarray, b: np.ndarray) -> None:
        can = bitmaps.close(a, b)
        for x, y in zip(a[can].tolist(), b[can].tolist()):
            if links.link(x, y):
                found.append((ids[x], ids[y]))

    # Few sets with one shingle: all pairs of all such shingles, each pair once.
    few = np.repeat(counts <= SMALL_SETS, counts)
    left = np.repeat(starts + counts, counts) - np.arange(len(rows))  # rows from this one to the end of its shingle
    pairs = []
    for step in range(1, SMALL_SETS):
        at = np.flatnonzero(few & (left > step))
        if not len(at):
            break
        pairs.append(np.unique(numbers[at] * len(ids) + numbers[at + step]))
    if pairs:
        unique = np.unique(np.concatenate(pairs))
        connect(unique // len(ids), unique % len(ids))
    # Many sets: one after the other against those it is not connected with.
    for start, count in zip(starts[counts > SMALL_SETS], counts[counts > SMALL_SETS]):
        own = numbers[start : start + count]
        for i, number in enumerate(own):
            roots = links.roots(own)
            if (roots == roots[0]).all():
                break
            others = own[i + 1 :][roots[i + 1 :] != roots[i]]
            connect(np.full(len(others), number), others)
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64") if found else none


class _Node:
    """A run of shingles that the sets below share, and what bounds those sets."""

    __slots__ = ("run", "children", "ends", "smallest", "largest", "rest", "labels")

    def __init__(self, run: np.ndarray):
        self.run, self.children, self.ends = run, {}, []
        self.smallest, self.largest, self.rest, self.labels = 1 << 60, 0, 0, set()

    def widen(self, size: int, rest: int, label: int) -> None:
        self.smallest, self.largest, self.rest = min(self.smallest, size), max(self.largest, size), max(self.rest, rest)
        if self.labels is not None:
            self.labels.add(label)
            if len(self.labels) > LABELS:
                self.labels = None  # too mixed to tell


class PrefixTree:
    """Sets as ascending ranks; a probe finds the sets it is newly linked to."""

    def __init__(self, links: _Links, sizes: list[int], percent: int):
        self.links, self.sizes, self.percent = links, sizes, percent
        self.root = _Node(np.empty(0, dtype=np.int64))

    def insert(self, number: int, ranks: np.ndarray) -> None:
        size, node, at = self.sizes[number], self.root, 0
        node.widen(size, len(ranks), number)
        while at < len(ranks):
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = node.children[int(ranks[at])] = _Node(ranks[at:])
                child.widen(size, 0, number)
                child.ends.append(number)
                return
            run = child.run
            length = min(len(run), len(ranks) - at)
            differ = np.flatnonzero(run[:length] != ranks[at : at + length])
            same = int(differ[0]) if len(differ) else length
            if same < len(run):
                # The run splits: its beginning becomes a node above.
                upper = _Node(run[:same])
                upper.smallest, upper.largest, upper.rest = child.smallest, child.largest, child.rest + len(run) - same
                upper.labels = None if child.labels is None else set(child.labels)
                child.run = run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(ranks[at])] = upper
                child = upper
            at += same
            child.widen(size, len(ranks) - at, number)
            node = child
        node.ends.append(number)

    def probe(self, number: int, member: np.ndarray, up_to: np.ndarray, every: bool = False) -> Iterator[int]:
        """Numbers of linked sets: every one, or as many as connect what is linked. `member` tells the probe's ranks,
        `up_to` how many of them are lower than a rank."""
        size, total, percent = self.sizes[number], int(up_to[-1]), self.percent
        links, sizes = self.links, self.sizes
        pending = [(self.root, 0)]
        while pending:
            node, overlap = pending.pop()
            if 100 * node.largest < percent * size or percent * node.smallest > 100 * size:
                continue
            if not every and node.labels is not None:
                node.labels = {links.find(label) for label in node.labels}
                if len(node.labels) == 1 and links.find(number) in node.labels:
                    continue
            left = total
            if len(node.run):
                overlap += int(np.count_nonzero(member[node.run]))
                left = total - int(up_to[node.run[-1] + 1])
            partner = max(node.smallest, -(-percent * size // 100))
            if overlap + min(left, node.rest) < needed(size, partner, percent):
                continue
            for other in node.ends:
                if overlap >= needed(size, sizes[other], percent) and (links.link(number, other) or every):
                    yield other
            pending.extend((child, overlap) for child in node.children.values())


def join_blocks(rows: pd.DataFrame, percent: int, counted: bool = False) -> pd.DataFrame:
    """`join_block` for every block of a group: links (a, b) and, if they are counted, rows (a, n_links) without b."""
    rows = rows.sort_values(["block", "n", "id"], kind="stable")
    starts = np.flatnonzero(np.diff(rows["block"].to_numpy(), prepend=np.int64(-1)))
    ends = [*starts[1:], len(rows)]
    found = [row for start, end in zip(starts, ends) for row in join_block(rows.iloc[start:end], percent, counted)]
    columns = list(zip(*found)) or [(), (), ()]
    return pd.DataFrame({name: pd.array(values, dtype="Int64") for name, values in zip(("a", "b", "n_links"), columns)})


def join_block(rows: pd.DataFrame, percent: int, counted: bool = False) -> list[tuple[int, int | None, int | None]]:
    """Links between the sets of a block, or of two chunks of one: as many as connect what is linked, and, if counted,
    for every set with any the number of texts that it is linked with here."""
    sizes, ids = rows["n"].tolist(), rows["id"].tolist()
    sets = [np.frombuffer(value, dtype="<u8") for value in rows["shingles"]]
    shared, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Frequent shingles come first, so that the tree shares nodes; those of one set alone cannot overlap.
    rank_of = np.empty(len(shared), dtype=np.int64)
    rank_of[np.lexsort((shared, -counts))] = np.arange(len(shared))
    usable = int((counts > 1).sum())
    bounds = np.cumsum([0, *map(len, sets)])
    ranks = [np.sort(rank_of[inverse[start:end]]) for start, end in zip(bounds, bounds[1:])]
    ranks = [r[: int(np.searchsorted(r, usable))] for r in ranks]
    links = _Links(len(ids))
    # A block in one piece has one tree; of two chunks, each set looks into the other's.
    low, high = rows["low"].iloc[0], rows["high"].iloc[0]
    chunks = rows["chunk"].tolist()
    own = low == high
    trees = {c: PrefixTree(links, sizes, percent) for c in {low, high}}
    found: list[tuple[int, int | None, int | None]] = []
    copies, partners = rows["copies"].tolist(), [0] * len(ids)
    linked = _Links(len(ids))
    member = np.zeros(usable + 1, dtype=bool)
    for number, own_ranks in enumerate(ranks):
        member[own_ranks] = True
        up_to = np.concatenate([[0], np.cumsum(member[:usable])])
        tree = trees[low if own else (high if chunks[number] == low else low)]
        for other in tree.probe(number, member, up_to, counted):
            partners[number] += copies[other]
            partners[other] += copies[number]
            if linked.link(number, other):
                found.append((ids[number], ids[other], None))
        member[own_ranks] = False
        trees[chunks[number] if not own else low].insert(number, own_ranks)
    if counted:
        found += [(i, None, n) for i, n in zip(ids, partners) if n]
    return found


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all candidate pairs: a table of shared prefix shingles, dealt to bins by shingle,
    meets the bitmaps of the sets in each bin. A shingle of very many sets is cut into pairs of chunks."""
    tokens = sets.select("id", F.explode("prefix").alias("token"))
    chunks = F.ceil(F.col("sets") / HOT_SETS).alias("chunks")
    shared = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select("token", chunks)
    chunked = tokens.join(shared, "token").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    each = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = stage(
        each.select("token", "id", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")),
        "shared",
    )
    bins = max(1, -(-rows.count() // BIN_ROWS))
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("token", "low", "high"), F.lit(bins)))
    wanted = rows.select(F.col("bin").alias("to"), F.col("id").alias("set")).distinct()
    bitmaps = sets.select(F.col("id").alias("set"), "n", "bits").join(wanted, "set")
    return (
        rows.groupBy("bin")
        .cogroup(bitmaps.groupBy("to"))
        .applyInPandas(lambda rows, own: candidate_links(rows, own, percent), "a bigint, b bigint")
    )


def _needed_filter(members: DataFrame) -> np.ndarray:
    """One bit for each set that a block needs, by its signature; a set too many costs its shuffle only."""
    place = F.conv(F.hex(F.substring("signature", 1, FILTER_BYTES)), 16, 10).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    bits = members.select(F.floor(place / 64).alias("word"), bit.alias("bit"))
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # 16 bytes for 64 bits at most
    words = np.zeros((1 << 8 * FILTER_BYTES) // 64, dtype=np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint8)


def _is_needed(bits: np.ndarray, signature: bytes) -> bool:
    place = int.from_bytes(signature[:FILTER_BYTES], "big")
    return bool(bits[place >> 3] >> (place & 7) & 1)


def _in_groups(members: DataFrame, chunk_sets: int) -> DataFrame:
    """Deal the sets of blocks to tasks: small blocks several to a group, large ones by pairs of chunks."""
    totals = stage(members.groupBy("block").agg(F.sum("n").alias("shingles"), F.count("*").alias("sets")), "blocks")
    chunks = F.ceil(F.greatest(F.col("shingles") / CHUNK_SHINGLES, F.col("sets") / chunk_sets)).alias("chunks")
    small = totals.agg(F.sum(F.when(F.col("shingles") <= CHUNK_SHINGLES, F.col("shingles")))).first()[0] or 0
    groups = max(1, -(-small // CHUNK_SHINGLES))
    sized = members.join(totals.select("block", chunks), "block")
    own = F.pmod(F.xxhash64("id"), F.col("chunks"))
    dealt = sized.withColumn("chunk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    alone = F.col("chunks") == 1
    return dealt.select(
        "signature", "id", "n", "copies", "block", "chunk",
        F.when(alone, F.pmod(F.xxhash64("block"), F.lit(groups))).otherwise(F.col("block")).alias("group"),
        F.when(alone, -1).otherwise(F.least("chunk", "other")).alias("low"),
        F.when(alone, -1).otherwise(F.greatest("chunk", "other")).alias("high"),
    )


def jaccard_components(
    docs: DataFrame, percent: int = 90, size: int = 3, doc_id: str = "doc_id", text: str = "text", count_links: bool = False
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), group (null for an empty set) and
    key (of id and text) of every row; linked rows share their group. With `count_links` also n_links, with how many
    other rows it is linked: then all pairs within a block are tested, else only what may connect something.

    The result is written; what the steps before it staged is removed."""
    spark = docs.sparkSession
    path = staging_path(spark, "jaccard")
    with staged_job(spark):
        _components(docs, percent, size, doc_id, text, count_links).write.parquet(path)
    return read_parquet(spark, path)


def _components(docs: DataFrame, percent: int, size: int, doc_id: str, text: str, count_links: bool) -> DataFrame:
    spark = docs.sparkSession
    own = in_small_batches(docs).select(
        F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), row_key(doc_id, text).alias("key")
    )
    kind = own.schema["doc_id"].dataType.simpleString()
    sketch = spark.sparkContext.broadcast(frequency_sketch(own, size))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = sketch.value
        for batch, sets in _text_batches(batches, size):
            signatures, firsts, bitmaps = [], [], []
            for hashes in sets:
                signatures.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                first = hashes[:0]
                if can_differ(len(hashes), percent):
                    length = prefix_length(len(hashes), percent)
                    first = hashes[np.lexsort((hashes, estimate[_cells(hashes, len(estimate).bit_length() - 1)]))[:length]]
                firsts.append(first.view(np.int64))
                bitmaps.append(parity_bits(hashes, percent).tobytes() if len(first) else None)
            columns = [
                batch.column("doc_id"),
                batch.column("key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(signatures, pa.binary()),
                pa.array(firsts, pa.list_(pa.int64())),
                pa.array(bitmaps, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "signature", "prefix", "bits"])

    columns = f"doc_id {kind}, key string, n bigint, signature binary, prefix array<bigint>, bits binary"
    rows = stage(own.mapInArrow(prefixes, columns), "prefixes")
    # Equal sets fall together; copies shrink within their tasks. Staging fixes the numbers.
    distinct = rows.where(F.col("signature").isNotNull()).groupBy("signature")
    first = [F.first(name).alias(name) for name in ("n", "prefix", "bits")]
    first.append(F.count("*").alias("copies"))
    sets = stage(
        distinct.agg(F.min("doc_id").alias("first_id"), *first).withColumn("id", F.monotonically_increasing_id()), "sets"
    )
    blocks = components(_candidates(sets, percent))
    roots = blocks.select(F.col("root").alias("id")).distinct().withColumn("block", F.col("id"))
    members = stage(
        blocks.select(F.col("node").alias("id"), F.col("root").alias("block"))
        .unionByName(roots)
        .join(sets.select("id", "signature", "n", "copies"), "id"),
        "blocks",
    )
    wanted = spark.sparkContext.broadcast(_needed_filter(members))

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed_bits = wanted.value
        for _, found in _text_batches(batches, size):
            signed = {xxhash.xxh3_128_digest(s.tobytes()): s for s in found if can_differ(len(s), percent)}
            kept = {k: s for k, s in signed.items() if _is_needed(needed_bits, k)}
            columns = [pa.array(list(kept), pa.binary()), pa.array([s.tobytes() for s in kept.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["signature", "shingles"])

    shingles = own.select("text").mapInArrow(whole_sets, "signature binary, shingles binary")
    chunk_sets = COUNTED_CHUNK_SETS if count_links else CHUNK_SETS
    blocks_with_sets = _in_groups(members, chunk_sets).join(shingles.dropDuplicates(["signature"]), "signature")
    found = stage(
        blocks_with_sets.groupBy("group", "low", "high").applyInPandas(
            lambda group: join_blocks(group, percent, count_links), "a bigint, b bigint, n_links bigint"
        ),
        "links",
    )
    joined = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    rooted = sets.join(joined, sets["id"] == joined["node"], "left").select(
        "signature", "first_id", F.coalesce("root", "id").alias("root")
    )
    labels = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_signature = rooted.join(labels, "root").select("signature", "component_id", "root")
    if count_links:
        counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("n_links").alias("n_links"))
        own = sets.join(counts, "id", "left").select("signature", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
        by_signature = by_signature.join(own, "signature")
    component = F.when(F.col("signature").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("root").alias("group"), "key"]
    if count_links:
        columns.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(by_signature, "signature", "left").select(*columns)


def drop_near_copies(
    docs: DataFrame, percent: int = 80, size: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents, but of each group of linked ones only that with the smallest id (null last, then by key).

    Rows keep their columns, whatever their names; texts without words are linked with nothing and all stay.
    Repeated rows shrink within their tasks before the texts are shuffled by key.
    """
    found = jaccard_components(docs, percent, size, doc_id, text).where(F.col("group").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    keepers = stage(found.groupBy("group").agg(F.min(order).alias("first")).select("first.key"), "keepers")
    key = fresh_name("jaccard_key", docs)
    keyed = docs.withColumn(key, row_key(doc_id, text))
    worded = whole_text(text).rlike(WORD)
    kept = keyed.where(worded).dropDuplicates([key]).join(keepers.withColumnRenamed("key", key), key, "left_semi")
    return kept.unionByName(keyed.where(~worded)).select(*[quoted(name) for name in docs.columns])
