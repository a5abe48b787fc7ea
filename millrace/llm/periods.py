"""Runs of words that repeat with a period, found by recursive frequency splitting and a scan of lags.

A word of a run of period q and at least 4 q words (6 for q = 1) stands in it four times or more. So a word that is
rarer within a segment joins no run there and splits the segment; counting is repeated on the pieces until no
word is that rare. What survives is scanned: words a lag apart are compared, and stretches where they stay equal are
runs. Lags up to DIRECT_LAGS are scanned one by one. For longer ones, twice as long each time, equal blocks of words
have equal names, and only lags at which two neighbouring blocks come again are followed up, which keeps the scan of
a segment of L words near L log L.

Defined cases: a null or empty text has no words and no run; a null id counts as one that leaves the words as they are;
repeated rows are judged each; an empty table gives no rows; other columns are ignored.
"""

import hashlib
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_small_batches, slices, whole_text

MIN_WORDS, MIN_REPEATS = 6, 4  # of a run
DIRECT_LAGS = 64

Run = tuple[int, int, int]  # start, length, period


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each different word."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), dtype=np.int64, count=len(words))


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of MIN_WORDS words or more, in each of which every word stands MIN_REPEATS times or more."""
    if len(codes) < MIN_WORDS:
        return []
    _, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    # The first split leaves little of most texts.
    edges = np.concatenate(([-1], np.flatnonzero(counts[place] < MIN_REPEATS), [len(codes)]))
    long = np.flatnonzero(np.diff(edges) > MIN_WORDS)
    found = []
    for i in long:
        start, end = int(edges[i]) + 1, int(edges[i + 1])
        found += [(start + a, start + b) for a, b in _split(codes[start:end].tolist())]
    return found


def _split(codes: list[int]) -> list[tuple[int, int]]:
    """The segments of one stretch. When it is split, the largest piece keeps the counts, less those of the others: a
    word is counted again only where its piece is less than half, so L words take L log L steps however deep it goes."""
    places: dict[int, list[int]] = {}
    for i, code in enumerate(codes):
        places.setdefault(code, []).append(i)
    pending = [(0, len(codes), Counter(codes), None)]
    stable = []
    while pending:
        start, end, counts, fewer = pending.pop()
        rare = [c for c in (counts if fewer is None else fewer) if 0 < counts[c] < MIN_REPEATS]
        if not rare:
            stable.append((start, end))
            continue
        cuts = []
        for c in rare:
            first = bisect_left(places[c], start)
            cuts += places[c][first : first + counts[c]]
            counts[c] = 0
        edges = [start - 1, *sorted(cuts), end]
        pieces = [(a + 1, b) for a, b in zip(edges, edges[1:])]
        largest = max(pieces, key=lambda p: p[1] - p[0])
        keep = 2 * (largest[1] - largest[0]) > end - start and largest[1] - largest[0] >= MIN_WORDS
        gone: Counter = Counter()
        for a, b in pieces:
            if keep and (a, b) == largest:
                continue
            own = Counter(codes[a:b]) if keep or b - a >= MIN_WORDS else None
            if keep:
                gone.update(own)
            if b - a >= MIN_WORDS:
                pending.append((a, b, own, None))
        if keep:
            counts.subtract(gone)
            pending.append((*largest, counts, list(gone)))
    return sorted(stable)


def _least(period: int) -> int:
    return max(MIN_WORDS, MIN_REPEATS * period)


class _Found:
    """Runs of one segment. A stretch that also has a smaller period is the run of that period, from end to end."""

    def __init__(self):
        self.runs: list[Run] = []
        self.extents: set[tuple[int, int]] = set()

    def add(self, start: int, end: int, period: int) -> None:
        if end - start >= _least(period) and (start, end) not in self.extents:
            self.extents.add((start, end))
            self.runs.append((start, end - start, period))

    def reach(self, words: int) -> np.ndarray:
        """For every word, how far the runs that start there or before it go."""
        far = np.zeros(words, dtype=np.int64)
        for start, length, _ in self.runs:
            far[start] = max(far[start], start + length)
        return np.maximum.accumulate(far)


def _scan_lag(codes: np.ndarray, lag: int, found: _Found) -> None:
    breaks = np.concatenate(([-1], np.flatnonzero(codes[lag:] != codes[:-lag]), [len(codes) - lag]))
    equal = np.diff(breaks) - 1
    for i in np.flatnonzero(equal >= _least(lag) - lag).tolist():
        start = int(breaks[i]) + 1
        found.add(start, start + int(equal[i]) + lag, lag)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two stretches share at their start."""
    n = min(len(a), len(b))
    different = np.flatnonzero(a[:n] != b[:n])
    return int(different[0]) if len(different) else n


def _scan_long_lags(codes: np.ndarray, block: int, names: np.ndarray, found: _Found) -> None:
    """Lags from `block` up to twice that; `names` tells the blocks that start at each word apart."""
    last = len(names) - 1
    starts = np.arange(0, last + 1, block)
    far = found.reach(len(codes))
    hits: dict[int, list[int]] = {}
    for first, second in zip(starts[:-1].tolist(), starts[1:].tolist()):
        # A run holds four periods, so two neighbouring blocks of it come again one period on. Where they lie in a
        # run of a smaller period, that one is the run.
        lags = np.arange(max(block, int(far[first]) - second - block + 1), min(2 * block, last - second + 1))
        for lag in lags[(names[first + lags] == names[first]) & (names[second + lags] == names[second])].tolist():
            hits.setdefault(lag, []).append(first)
    for lag in sorted(hits):
        known = 0
        for first in hits[lag]:
            if first < known:
                continue
            # To the right, then to the left, as far as words a lag apart are equal.
            start, end, size = first, first + 2 * block + lag, 4 * block
            while (more := _shared(codes[end : end + size], codes[end - lag : end - lag + size])) == size:
                end, size = end + more, 2 * size
            end, size = end + more, 4 * block
            while start:
                size = min(size, start)
                more = _shared(codes[start - size : start][::-1], codes[start - size + lag : start + lag][::-1])
                start -= more
                if more < size:
                    break
                size *= 2
            found.add(start, end, lag)
            known = end - lag - 2 * block + 1


def lag_scan(codes: np.ndarray) -> list[Run]:
    """All runs in a segment."""
    found = _Found()
    longest = len(codes) // MIN_REPEATS
    for lag in range(1, min(DIRECT_LAGS, longest + 1)):
        _scan_lag(codes, lag, found)
    names, block = codes, 1
    while block <= longest:
        if block >= DIRECT_LAGS:
            _scan_long_lags(codes, block, names, found)
        if 2 * block > longest:
            break
        pairs = names[:-block] * np.int64(len(codes) + 1) + names[block:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        block *= 2
    return found.runs


def runs_of(codes: np.ndarray) -> list[Run]:
    """All runs, by start and then period."""
    found = []
    for start, end in segments(codes):
        piece = np.unique(codes[start:end], return_inverse=True)[1].astype(np.int64)
        found += [(start + s, length, period) for s, length, period in lag_scan(piece)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray | None:
    """Whether each of n words is kept; a word behind the first period of any run is not. None if all are."""
    if not runs:
        return None
    kept = np.ones(n, dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return kept


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, for one id in ten with a tail that repeats: which, where and how long follows from the id."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


_LONGS = ["n_runs", "start", "length", "period", "exponent_milli"]
OUTPUT = ", ".join(f"{name} bigint" for name in _LONGS) + ", runs_sha256 string, collapsed_sha256 string"


def _judged(words: list[bytes]) -> tuple:
    runs = runs_of(numbered(words)) if len(words) >= MIN_WORDS else []
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = kept_words(len(words), runs)
    collapsed = b" ".join(words if kept is None else [words[i] for i in np.flatnonzero(kept)])
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; null without one), and hashes of all runs and
    of the text without repeats. `planted` makes the tails of some texts repeat first."""
    own = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = value.split()  # bytes split at ASCII's blanks alone
                rows.append(_judged(repeated_tail(words, key) if planted else words))
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 5 + [pa.string()] * 2
            arrays = [pa.array(values, type_) for values, type_ in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *_LONGS, "runs_sha256", "collapsed_sha256"])

    return in_small_batches(own).mapInArrow(run, f"doc_id {kind}, {OUTPUT}")
