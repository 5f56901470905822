"""Benchmark decontamination by an FM-index of each shard of the documents.

Words outside the benchmark's vocabulary are one symbol that no phrase contains.
The words of a shard form one sequence, with a separator after each document; its
suffix array gives the Burrows-Wheeler transform, kept as a wavelet tree with rank
counts.  All windows of the benchmark are searched backwards at once, one word a
step; occurrences are located by walking to the next sampled suffix, and the spans
of each document are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import flat_utf8, slices

WINDOW = 10
#: Words of a shard, about; a longer document is a shard of its own.
SHARD_WORDS = 1 << 19
#: Every so many positions of the sequence keep their place.
SAMPLED = 8
#: Bytes of benchmark text that are searched for at a time; more take more passes.
BLOCK_BYTES = 16 << 20
#: Occurrences located at a time.
AT_ONCE = 1 << 18

_WORD = np.zeros(256, np.uint8)
for _b in range(256):
    _WORD[_b] = _b + 32 if 65 <= _b <= 90 else _b if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128 else 32
_WORD_TABLE = _WORD.tobytes()

#: Symbols: end of sequence, separator, a word that no phrase has; then the vocabulary.
END, BREAK, OTHER, FIRST = 0, 1, 2, 3


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters and bytes beyond ASCII, with A-Z
    lower-cased."""
    return text.translate(_WORD_TABLE).split()


@dataclass
class Phrases:
    """Distinct windows as word numbers, and the items that have them.

    ``by_length`` holds (codes, first window number) for each length; ``owners`` and
    ``owner_bounds`` list the items of each window.
    """

    vocabulary: dict[bytes, int]
    by_length: list[tuple[np.ndarray, int]]
    owners: np.ndarray
    owner_bounds: np.ndarray
    items: list[str]
    lengths: np.ndarray

    @staticmethod
    def of(rows: list[tuple[str | None, bytes]], window: int = WINDOW) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[int]] = {}
        names = sorted({item for item, _ in rows if item is not None})
        number = {item: i for i, item in enumerate(names)}
        for item, text in rows:
            codes = [vocabulary.setdefault(w, FIRST + len(vocabulary)) for w in words(text)]
            for at in range(max(1, len(codes) - window + 1) if codes else 0):
                owners = seen.setdefault(tuple(codes[at : at + window]), set())
                if item is not None:
                    owners.add(number[item])
        phrases = sorted(seen, key=lambda p: (len(p), p))
        by_length, at = [], 0
        for length in sorted({len(p) for p in phrases}):
            same = [p for p in phrases if len(p) == length]
            by_length.append((np.array(same, np.int32), at))
            at += len(same)
        owners = [sorted(seen[p]) for p in phrases]
        return Phrases(
            vocabulary, by_length,
            np.array([o for own in owners for o in own], np.int64),
            np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64),
            names, np.array([len(p) for p in phrases], np.int64),
        )


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``codes``, whose last symbol is its only smallest one,
    by doubling the length compared; only suffixes still alike are sorted again."""
    n = len(codes)
    width = int(codes.max()).bit_length() if n else 1
    packed = max(1, 62 // width)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(packed, np.int64)])
    for i in range(packed):
        key = (key << width) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    # Rank of a suffix: the place where the group of those alike begins.
    places = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = places
    length = packed
    while True:
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.concatenate((starts, [n])))
        alike = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(alike)
        if not len(at):
            return order
        suffix = order[at]
        after = np.minimum(suffix + length, n - 1)
        group, second = rank[suffix], rank[after]
        again = np.lexsort((second, group))
        order[at] = suffix[again]
        group, second = group[again], second[again]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        fresh[at] = new
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        length *= 2


class Wavelet:
    """Ranks of symbols in a sequence: one bit vector for each bit of a symbol, sorted
    stably by that bit from level to level, with running counts of its ones."""

    def __init__(self, codes: np.ndarray) -> None:
        self.bits = max(1, int(codes.max()).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        rest = codes
        for level in range(self.bits - 1, -1, -1):
            bit = (rest >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(codes) - int(self.ones[-1][-1]))
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))
        self.start = {}

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """For each array of places, how many of the symbols come before them; places
        are compared with the begin of the symbol's run at the last level."""
        begin = np.zeros(len(symbol), np.int64)
        ends = [e.copy() for e in ends]
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.bits - 1 - i)) & 1).astype(bool)
            for x in (begin, *ends):
                one = ones[x]
                x[:] = np.where(bit, zeros + one, x - one)
        return [e - begin for e in ends]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at these places."""
        at, symbol = at.copy(), np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[at]
            bit = ones[at + 1] - one
            symbol = (symbol << 1) | bit
            at = np.where(bit == 1, zeros + one, at - one)
        return symbol


class FMIndex:
    """Backward search and location over one sequence of symbols."""

    def __init__(self, codes: np.ndarray) -> None:
        order = suffix_array(codes)
        self.size = len(codes)
        self.wavelet = Wavelet(codes[order - 1])
        counts = np.bincount(codes, minlength=int(codes.max()) + 1)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.sampled = order % SAMPLED == 0
        self.samples = order[self.sampled]
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each of these phrases of one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        top = len(self.before) - 1
        for column in phrases.T[::-1]:
            symbol = column[alive].astype(np.int64)
            here = symbol < top
            low[alive[~here]] = high[alive[~here]] = 0
            alive, symbol = alive[here], symbol[here]
            if not len(alive):
                break
            a, b = self.wavelet.rank(symbol, low[alive], high[alive])
            low[alive], high[alive] = self.before[symbol] + a, self.before[symbol] + b
            alive = alive[a < b]
        return low, np.maximum(low, high)

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Places in the sequence of these suffixes."""
        place = np.zeros(len(at), np.int64)
        todo, here, steps = np.arange(len(at)), at.copy(), 0
        while len(todo):
            done = self.sampled[here]
            place[todo[done]] = self.samples[self.sample_rank[here[done]]] + steps
            todo, here = todo[~done], here[~done]
            if len(todo):
                symbol = self.wavelet.access(here)
                here = self.before[symbol] + self.wavelet.rank(symbol, here)[0]
            steps += 1
        return place


def occurrences(
    shard: list[np.ndarray], phrases: Phrases
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first word, window) of every occurrence in a shard, in blocks."""
    parts = []
    for codes in shard:
        parts += [codes, np.array([BREAK], np.int32)]
    codes = np.concatenate([*parts, np.array([END], np.int32)])
    starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in shard])))
    index = FMIndex(codes)
    for table, first in phrases.by_length:
        low, high = index.search(table)
        found = np.flatnonzero(high > low)
        sizes = (high - low)[found]
        ends = np.cumsum(sizes)
        for begin in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
            k = np.arange(begin, min(begin + AT_ONCE, int(ends[-1])))
            which = np.searchsorted(ends, k, side="right")
            at = low[found[which]] + k - (ends - sizes)[which]
            place = index.locate(at)
            doc = np.searchsorted(starts, place, side="right") - 1
            yield doc, place - starts[doc], first + found[which]


def merged(first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
    """Spans (first, one past the last) joined where they touch or overlap."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > last[:-1]))
    ends = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(last) - 1]))
    return first[new].tolist(), last[ends].tolist()


def searched(shard: list[np.ndarray], phrases: Phrases) -> dict[int, tuple[list, list, list[int]]]:
    """For each document of a shard that is hit: its spans and its items."""
    docs, firsts, windows = [], [], []
    for d, f, w in occurrences(shard, phrases):
        docs.append(d)
        firsts.append(f)
        windows.append(w)
    if not docs:
        return {}
    doc, first, window = map(np.concatenate, (docs, firsts, windows))
    order = np.argsort(doc, kind="stable")
    doc, first, window = doc[order], first[order], window[order]
    out = {}
    cuts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True])))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        begin, end = merged(first[a:b], first[a:b] + phrases.lengths[window[a:b]])
        owners = [
            phrases.owners[phrases.owner_bounds[w] : phrases.owner_bounds[w + 1]]
            for w in np.unique(window[a:b]).tolist()
        ]
        out[int(doc[a])] = (begin, end, np.unique(np.concatenate(owners)).tolist())
    return out


def numbered(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    found = words(text)
    get = vocabulary.get
    return np.fromiter((get(w, OTHER) for w in found), np.int32, len(found))


SCHEMA = (
    "n_words bigint, begins array<bigint>, ends array<bigint>, items array<string>"
)
_LISTS = pa.struct(
    [("n_words", pa.int64()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
     ("items", pa.list_(pa.string()))]
)


def finder(phrases: Phrases):
    """A function for a column of texts: a struct of ``n_words``, the merged spans of
    hit words (``begins``, ``ends`` one past) and the sorted ``items`` that occur."""

    def found(shard: list[np.ndarray]) -> pa.Array:
        hits = searched(shard, phrases) if shard else {}
        rows = []
        for at, codes in enumerate(shard):
            begin, end, items = hits.get(at, ([], [], []))
            rows.append((len(codes), begin, end, sorted(phrases.items[i] for i in items)))
        columns = [[r[i] for r in rows] for i in range(4)]
        return pa.StructArray.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _LISTS)], [f.name for f in _LISTS]
        )

    @F.arrow_udf(f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    def contamination(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done, shard, size = [], [], 0
            for piece in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 4000):
                flat, bounds = flat_utf8(piece.column(0))
                data = flat.tobytes()
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    shard.append(numbered(data[a:b], phrases.vocabulary))
                    size += len(shard[-1])
                    if size >= SHARD_WORDS:
                        done.append(found(shard))
                        shard, size = [], 0
            done.append(found(shard))
            yield pa.concat_arrays(done)

    return contamination


def blocks(benchmark: DataFrame, item_id: str, text: str) -> list[Phrases]:
    """The benchmark's phrases, in blocks of at most about ``BLOCK_BYTES`` of text, so
    that what is sent to the tasks is bounded.  Items without words and null texts
    have no phrases; repeated ids are united.  Passages of items without an id are found
    like any other, but there is no id to name them by."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")
    ).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64(F.coalesce("item", "text")), F.lit(n))
    return [
        Phrases.of([(r[0], r[1].encode()) for r in items.filter(block == i).collect()])
        for i in range(n)
    ]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``n_words``, the merged ``spans`` of hit
    words as an array of (first, past) word numbers, and the sorted ``items`` with a
    window in the text.

    A null or empty text has no words and no hit; rows repeat as they are repeated.
    """
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        *[
            finder(p)(F.col(text)).alias(f"block{i}")
            for i, p in enumerate(blocks(benchmark, item_id, item_text))
        ],
    )
    names = [c for c in found.columns if c != "doc_id"]
    pairs = [
        F.arrays_zip(F.col(f"{c}.begins").alias("first"), F.col(f"{c}.ends").alias("past"))
        for c in names
    ]
    spans = pairs[0]
    if len(pairs) > 1:
        # Spans of several blocks are merged once more, in order.
        every = F.array_sort(F.concat(*pairs))
        spans = F.aggregate(
            every,
            F.slice(every, 1, 0),
            lambda done, x: F.when(
                (F.size(done) > 0) & (F.element_at(done, -1)["past"] >= x["first"]),
                F.concat(
                    F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                    F.array(
                        F.struct(
                            F.element_at(done, -1)["first"].alias("first"),
                            F.greatest(F.element_at(done, -1)["past"], x["past"]).alias("past"),
                        )
                    ),
                ),
            ).otherwise(F.concat(done, F.array(x))),
        )
    items = F.array_sort(F.concat(*[F.col(f"{c}.items") for c in names]))
    return found.select(
        "doc_id", F.col(f"{names[0]}.n_words").alias("n_words"), spans.alias("spans"),
        items.alias("items"),
    )


