"""BPE encoding by longest matches with backtracking, and decoding through an offset table.

The merges of a byte-level BPE are replayed without replaying them: a sequence of tokens is the one that
merging would give exactly when every neighbouring pair is compatible, that is, when merging their two
byte strings together would have kept the border between them. The encoder takes the longest token that
an Aho-Corasick automaton found at a position, steps to shorter ones and back over earlier choices while
the pair is not compatible, and marks positions that led nowhere, so each is left once at most.
"""

import json
import weakref
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from millrace.llm.common import in_small_batches, quoted, slices, whole_text

CACHED_PIECES = 250_000  # per Python worker; further pieces are encoded each time
CACHED_PAIRS = 150_000

# The split pattern of byte-level BPE, with Unicode's white space spelled out.
_SPACE = (
    r"\t-\r \x85\xa0\N{OGHAM SPACE MARK}\N{EN QUAD}-\N{HAIR SPACE}\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}"
    r"\N{NARROW NO-BREAK SPACE}\N{MEDIUM MATHEMATICAL SPACE}\N{IDEOGRAPHIC SPACE}"
)
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def byte_alphabet() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BoundedCache(dict):
    """Computes a missing value, and keeps it while there is room. Long keys, which rarely come again, are not kept, so
    the bytes are bounded as well."""

    def __init__(self, compute, room: int, longest: int = 64):
        super().__init__()
        self.compute, self.room, self.longest = compute, room, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.room and (not hasattr(key, "__len__") or len(key) <= self.longest):
            self[key] = value
        return value


class BacktrackingBpe:
    """Tables and methods for one vocabulary; tokens are handled by merge order, byte tokens first."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, alphabet = spec["model"], byte_alphabet()
        pre = spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not any(
            model.get(key) for key in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        if not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE")
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        texts = sorted(alphabet, key=alphabet.get) + [left + right for left, right in merges]
        if len(set(texts)) < len(texts):
            raise ValueError("two merges make the same token")
        order = {text: i for i, text in enumerate(texts)}
        self.tokens = [bytes(alphabet[c] for c in text) for text in texts]
        self.ids = np.array([vocab[text] for text in texts], dtype="<u4")
        self.parts = [(i, i) for i in range(256)] + [(order[left], order[right]) for left, right in merges]
        self.merged = {pair: 256 + i for i, pair in enumerate(self.parts[256:])}
        known = {token: i for i, token in enumerate(self.tokens)}
        self.shorter = [self._longest_prefix(token, known) for token in self.tokens]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in known.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        # Weakly, as tables in a cycle would wait for the garbage collector.
        own = weakref.proxy(self)
        # A pair is kept as one number, which takes half the memory of a tuple.
        self.compatible = BoundedCache(lambda pair: own._compatible(*divmod(pair, len(own.tokens))), CACHED_PAIRS)
        self.pieces = BoundedCache(lambda piece: own.encode_piece(piece.encode()), CACHED_PIECES)
        self.find_pieces = regex.compile(PATTERN).findall
        # Added tokens are cut out of the text before anything else.
        self.added = {a["content"]: np.array([a["id"]], dtype="<u4").tobytes() for a in spec.get("added_tokens", [])}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec.get("added_tokens", [])):
            raise ValueError("added tokens with conditions are not supported")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if self.added else None

    @staticmethod
    def _longest_prefix(token: bytes, known: dict[bytes, int]) -> int:
        return next((known[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in known), -1)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the border between two tokens.

        Undoes the later of the two merges step by step: at each step the parts that touch must not have
        had a merge of their own that comes before the one undone.
        """
        limit = len(self.tokens)
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < limit:
                return False
            # The right token of two equally late ones was merged after the left.
            if left > right:
                if left < 256:
                    return True
                limit, left = left, self.parts[left][1]
            else:
                if right < 256:
                    return True
                limit, right = right + 1, self.parts[right][0]

    def encode_piece(self, piece: bytes) -> bytes:
        """The ids of one piece, little-endian, 32 bits each."""
        size = len(piece)
        longest = [-1] * size
        lengths, base = self.tokens, len(self.tokens)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            # Ends ascend, so the last token seen for a start is its longest.
            longest[end + 1 - len(lengths[token])] = token
        out: list[int] = []
        dead = bytearray(size + 1)
        at, token = 0, longest[0] if size else -1
        while token >= 0:
            end = at + len(lengths[token])
            if not dead[end] and (not out or self.compatible[out[-1] * base + token]):
                out.append(token)
                at = end
                token = longest[at] if at < size else -1
                continue
            token = self.shorter[token]
            if token < 0:
                dead[at] = 1
                token = out.pop()
                at -= len(lengths[token])
        return self.ids[out].tobytes() if out else b""

    def encode(self, text: str) -> bytes:
        if self.split_added is None:
            return b"".join(map(self.pieces.__getitem__, self.find_pieces(text)))
        parts = []
        for n, part in enumerate(self.split_added(text)):
            if n % 2:
                parts.append(self.added[part])
            else:
                parts.extend(map(self.pieces.__getitem__, self.find_pieces(part)))
        return b"".join(parts)


class OffsetTable:
    """The bytes of all tokens in the order of their ids, and where each begins."""

    def __init__(self, definition: str):
        spec, alphabet = json.loads(definition), byte_alphabet()
        by_id = {i: bytes(alphabet[c] for c in text) for text, i in spec["model"]["vocab"].items() if set(text) <= set(alphabet)}
        by_id |= {a["id"]: a["content"].encode() for a in spec.get("added_tokens", [])}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, tokens)])

    def decode(self, ids: bytes) -> str:
        """Gathers each id's bytes through the offset table; invalid UTF-8 gives replacement characters."""
        numbers = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        numbers = numbers[numbers < len(self.offsets) - 1]  # an id outside the vocabulary has no text
        starts = self.offsets[numbers]
        sizes = self.offsets[numbers + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        gathered = self.bytes[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
        return gathered.tobytes().decode("utf-8", "replace")


class Vocabulary:
    """A tokenizer file, and its tables, which each Python worker makes when it needs them.

    They belong to the broadcast, so a worker keeps them from task to task of one operator, and lets go of them when
    it gets a task of another.
    """

    def __init__(self, definition: str):
        self.definition = definition

    @cached_property
    def encoder(self) -> BacktrackingBpe:
        return BacktrackingBpe(self.definition)

    @cached_property
    def offsets(self) -> OffsetTable:
        return OffsetTable(self.definition)


def read_definition(path: str) -> str:
    """The tokenizer file, read by the driver and sent to the tasks: a few MB, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    decoded: str | None = None,
) -> DataFrame:
    """doc_id, the columns in `keep`, and `ids` (binary, little-endian unsigned 32 bit) of every row.

    `vocabulary` is a tokenizer file's path. With `decoded`, a column of that name holds the text that the ids
    decode to, made by the same task.

    Defined cases: a null text is empty and has no ids; every row is encoded by itself, so repeated rows
    and null ids stay as they are; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_definition(vocabulary)))
    own = docs.select(whole_text(text).alias("whole"), quoted(doc_id).alias("doc_id"), *[quoted(name) for name in keep])
    added = [StructField("ids", BinaryType())] + ([StructField(decoded, StringType())] if decoded else [])
    schema = StructType([*own.schema.fields[1:], *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, offsets = shared.value.encoder, shared.value.offsets if decoded else None
        for batch in slices(batches):
            ids = [tables.encode(value) for value in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array(ids, pa.binary())]
            if offsets:
                columns.append(pa.array(map(offsets.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return in_small_batches(own).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, *keep: str) -> DataFrame:
    """doc_id, `text` and the columns in `keep` from `encode`'s result; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(read_definition(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.offsets
        for batch in slices(batches):
            texts = [tables.decode(value or b"") for value in batch.column("ids").to_pylist()]
            kept = [batch.column(name) for name in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], ["doc_id", *keep, "text"])

    kept = [encoded.schema[name] for name in ("doc_id", *keep)]
    return in_small_batches(encoded).mapInArrow(run, StructType([*kept, StructField("text", StringType())]))
