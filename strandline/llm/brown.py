"""Language model scores by classes of words, found by exchange clustering.

The most frequent words are moved between classes one by one, as long as the likelihood
of class bigrams grows.  All other words that are not rare by count join the class that
fits their neighbours best, and are then exchanged together: each goes where its
neighbours' classes are likeliest under the counts of all others.  Their counts of
neighbouring classes stay in Spark; the driver holds the classes of words and the table
of class pairs.  Rare words are one class.  A token has the probability

    (1 - mix) * p(word) + mix * p(class | class before) * p(word | class)

where both p(word) and p(word | class) are add-one estimates.  So a word's own count
is a factor of its own, and only the counts of rare words have to be joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, written

#: Words that tasks know by their letters and counts, at most: the most frequent ones of
#: up to 64 bytes.  Others are known by a 64-bit hash; their counts are joined.  What a
#: word is known by makes no difference to the model.
HEAD = 60_000
HEAD_BYTES = 64
#: A word has a class if it occurs so often, however many words there are (16 bytes for
#: each one in a task).
LEAST = 3
#: Classes and words exchanged one by one, at least; both follow the number of words.
CLASSES = 32
CLUSTERED = 1000
ROUNDS = 8
#: Times that all other words are exchanged after they have found a class.
EXCHANGES = 1
MIX = 0.9
#: Distinct words that a task counts before it passes them on.
AT_ONCE = 200_000
#: Pairs that a task counts before it passes them on.
PAIRS_AT_ONCE = 1 << 21
#: The end of a text is a token of its own that no word equals.
END = b""


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (between white space, A-Z lower-cased) of the texts in line, and where
    those of each text begin and end.  Null reads as empty."""
    # A copy: Arrow cuts a slice of a larger array wrongly.
    own = texts.take(pa.array(np.arange(len(texts))))
    whole = own.cast(pa.large_string()).fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    flat = lists.flatten()
    # White space at the ends of a text leaves empty words there.
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    cuts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
    return flat.filter(real), before[cuts]


def as_bytes(found: pa.Array) -> pa.Array:
    return found.cast(pa.large_binary()).cast(pa.binary())


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` for every token of the column ``text``, the ends included.

    Counted in the tasks first, so frequent words cost the shuffle nothing.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for whole in batches:
            for batch in slices(whole, 1000):
                each = words(batch.column(0))[0].value_counts()
                for word, n in zip(as_bytes(each.field(0)).to_pylist(), each.field(1).to_pylist()):
                    seen[word] += n
                seen[END] += batch.num_rows
                if len(seen) > AT_ONCE:
                    yield passed()
                    seen.clear()
        yield passed()

    return texts.mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Coder:
    """Numbers of words: those of the ``head`` first, then those of sorted ``hashes``,
    else -1."""

    head: dict[bytes, int]
    hashes: np.ndarray

    def numbers(self, found: list[bytes]) -> np.ndarray:
        get = self.head.get
        out = np.fromiter((get(word, -1) for word in found), np.int32, len(found))
        rest = np.flatnonzero(out < 0)
        if len(rest) and len(self.hashes):
            digest = xxhash.xxh64_intdigest
            hashed = (digest(found[i], 42) for i in rest)
            hashed = np.fromiter(hashed, np.uint64, len(rest)).view(np.int64)
            at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
            out[rest] = np.where(self.hashes[at] == hashed, len(self.head) + at, -1)
        return out

    def __getitem__(self, word: bytes) -> int:
        return int(self.numbers([word])[0])


def coded(docs: DataFrame, head: dict[bytes, int], hashes: np.ndarray) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``learn``) as a table of numbers: ``row``,
    ``doc_id``, ``learn``, ``codes`` of the words, and the words beyond the head as
    ``others``.  Texts are cut into words here once; all that follows reads numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(head, hashes)
        for whole in batches:
            for batch in slices(whole, 1000):
                found, cuts = words(batch.column(3))
                # Each different word of the batch is looked up once.
                found = found.dictionary_encode()
                which, different = found.indices.to_numpy(), as_bytes(found.dictionary)
                numbers = coder.numbers(different.to_pylist())[which]
                text = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
                beyond = (numbers < 0) | (numbers >= len(head))
                others, times = np.unique(
                    text[beyond] << 32 | which[beyond].astype(np.int64), return_counts=True
                )
                ends = np.searchsorted(others >> 32, np.arange(batch.num_rows + 1))
                pairs = pa.StructArray.from_arrays(
                    [different.take(pa.array(others & 0xFFFFFFFF)), pa.array(times, pa.int64())],
                    ["word", "times"],
                )
                lists = (
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], *lists], ["row", "doc_id", "learn", "codes", "others"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "learn", "text").mapInArrow(
            run,
            f"row bigint, doc_id {kind}, learn boolean, codes array<int>, "
            "others array<struct<word:binary,times:bigint>>",
        ),
        "lm-coded",
    )


def in_line(codes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in one line with an end (0) before each text and after the last, and
    the places of these ends."""
    sizes = codes.value_lengths().to_numpy().astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes + 1)))
    flat = np.zeros(ends[-1] + 1, np.int64)
    inside = np.ones(len(flat), bool)
    inside[ends] = False
    flat[inside] = codes.flatten().to_numpy()
    return flat, ends


def pair_counts(learned: DataFrame, keys) -> DataFrame:
    """How often each pair of small numbers occurs: ``keys`` turns the numbers of texts in
    line into two arrays.  Rows ``a``, ``b``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def passed() -> pa.RecordBatch:
            packed, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(packed >> 32), pa.array(packed & 0xFFFFFFFF), pa.array(n, pa.int64())],
                ["a", "b", "n"],
            )

        for whole in batches:
            for batch in slices(whole, 10_000):
                a, b = keys(in_line(batch.column(0))[0])
                held.append(a << 32 | b)
                if sum(map(len, held)) > PAIRS_AT_ONCE:
                    yield passed()
        if held:
            yield passed()

    found = learned.select("codes").mapInArrow(run, "a bigint, b bigint, n bigint")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def rows_of(counts: DataFrame) -> np.ndarray:
    """Rows (a, b, n) of pairs whose numbers are bounded by classes or a few words."""
    found = written(counts, "lm-pairs").toArrow()
    return np.column_stack([found.column(c).to_numpy() for c in ("a", "b", "n")]).astype(np.int64)


def neighbour_counts(
    learned: DataFrame, of: np.ndarray, few: int, size: int, other: int
) -> DataFrame:
    """For each word from number ``few``, how often each class stands before it (``b``
    from 0) and after it (``b`` from ``size``).  Words without a number are of class
    ``other``; words of class -1 are no neighbours."""

    def keys(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.where(flat >= 0, of[flat], other)
        before = (flat[1:] >= few) & (own[:-1] >= 0)
        after = (flat[:-1] >= few) & (own[1:] >= 0)
        word = np.concatenate((flat[1:][before], flat[:-1][after]))
        return word, np.concatenate((own[:-1][before], own[1:][after] + size))

    return pair_counts(learned, keys)


def fitting(before: np.ndarray, after: np.ndarray, table: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The class (neither the end nor the rare ones) that makes the neighbours of each
    word likeliest.  What a word adds to its ``own`` class (-1: none) is left out there."""
    out = np.log(table / table.sum(axis=1, keepdims=True))
    into = np.log(table / table.sum(axis=0, keepdims=True))
    fit = before @ into + after @ out.T
    at = np.flatnonzero(own >= 0)
    rest_out = np.maximum(table[own[at]] - after[at], table.min())
    rest_into = np.maximum(table.T[own[at]] - before[at], table.min())
    fit[at, own[at]] = (
        after[at] * np.log(rest_out / rest_out.sum(axis=1, keepdims=True))
        + before[at] * np.log(rest_into / rest_into.sum(axis=1, keepdims=True))
    ).sum(axis=1)
    return 1 + fit[:, 1:-1].argmax(axis=1)


def exchanged(counts: DataFrame, table: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``of`` after each word of ``counts`` (see ``neighbour_counts``) has moved to the
    class that fits it.  A word has at most two rows for each class, so groups are small."""
    size = len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                word = batch.column(0).to_numpy()
                lists = batch.column(1)
                slot, n = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                row = np.repeat(np.arange(len(word)), lists.value_lengths().to_numpy())
                seen = np.zeros((len(word), 2 * size))
                seen[row, slot] = n
                best = fitting(seen[:, :size], seen[:, size:], table, of[word])
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(best)], ["a", "b"])

    grouped = counts.groupBy("a").agg(F.collect_list(F.struct("b", "n")).alias("near"))
    found = written(grouped.mapInArrow(run, "a bigint, b bigint"), "lm-moves").toArrow()
    of = of.copy()
    of[found.column("a").to_numpy()] = found.column("b").to_numpy()
    return of


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, n: int, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """A class for each of ``n`` words, by moving one word at a time to where the
    likelihood of class bigrams grows most, until none moves."""
    of = np.arange(n) % classes
    a, b, times = bigrams.T
    right = [[] for _ in range(n)]
    left = [[] for _ in range(n)]
    for rows, at, other in ((right, a, b), (left, b, a)):
        order = np.argsort(at, kind="stable")
        cut = np.searchsorted(at[order], np.arange(n + 1))
        for w in range(n):
            mine = order[cut[w] : cut[w + 1]]
            rows[w] = (other[mine], times[mine])
    table = np.zeros((classes, classes))
    np.add.at(table, (of[a], of[b]), times)
    for _ in range(rounds):
        moved = 0
        for w in range(n):
            g = of[w]
            after = np.bincount(of[right[w][0]], right[w][1], classes)
            before = np.bincount(of[left[w][0]], left[w][1], classes)
            same = float(right[w][1][right[w][0] == w].sum())
            after[g] -= same
            before[g] -= same
            table[g] -= after
            table[:, g] -= before
            table[g, g] -= same
            out, into = table.sum(axis=1), table.sum(axis=0)
            gain = (_f(table + after[None]) - _f(table)).sum(axis=1)
            gain += (_f(table + before[:, None]) - _f(table)).sum(axis=0)
            d = np.diag(table)
            gain -= _f(d + after) + _f(d + before) - _f(d)
            gain += _f(d + after + before + same)
            gain -= _f(out + after.sum() + same) - _f(out)
            gain -= _f(into + before.sum() + same) - _f(into)
            h = int(gain.argmax())
            if gain[h] <= gain[g] + 1e-9:
                h = g
            table[h] += after
            table[:, h] += before
            table[h, h] += same
            of[w] = h
            moved += h != g
        if not moved:
            break
    return of


@dataclass
class Vocabulary:
    """``codes``: numbers of the head, ``n`` their counts; ``hashes``: sorted hashes of the
    words numbered after it; ``mass``: count + 1 of each number, added up over words of
    one hash; ``total``, ``distinct``: all tokens of training, all different ones;
    ``rare``: tokens, and different tokens, without a number."""

    codes: dict[bytes, int]
    n: np.ndarray
    hashes: np.ndarray
    mass: np.ndarray
    total: int
    distinct: int
    rare: tuple[int, int]


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Words that get a class, of the ``counts`` of training."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    plain = F.col("word") != F.lit(END)
    short = F.octet_length("word") <= HEAD_BYTES
    often = F.col("n") >= LEAST
    top = counts.filter(short & plain & often).orderBy(F.desc("n"), "word").limit(HEAD).collect()
    ends = counts.filter(~plain).first()
    head = [END] + [bytes(r["word"]) for r in top]
    n = np.array([ends["n"] if ends else 0] + [r["n"] for r in top], np.int64)
    beyond = ~short
    if len(top) == HEAD:
        last = top[-1]
        after_last = (F.col("n") == last["n"]) & (F.col("word") > F.lit(bytes(last["word"])))
        beyond = beyond | (F.col("n") < last["n"]) | after_last
    more = counts.filter(plain & beyond & often).select(F.xxhash64("word").alias("h"), "n").toArrow()
    # Words of one hash are one word here.
    hashes, same = np.unique(more.column("h").to_numpy(), return_inverse=True)
    times = more.column("n").to_numpy().astype(np.int64)
    mass = np.concatenate((n + 1, np.bincount(same, times + 1, len(hashes))))
    rare = (int(total - n.sum() - times.sum()), int(distinct - (n > 0).sum() - len(times)))
    return Vocabulary({w: i for i, w in enumerate(head)}, n, hashes, mass, total, distinct, rare)


@dataclass
class Model:
    """``log_count``: log10(count + 1) of the head; ``of``: the class of each number;
    ``step``: log10 of what a class adds after another; ``train_tokens``, ``log_all``:
    log10 of the base's denominator; ``outside``: share of the training tokens that are
    rare words."""

    log_count: np.ndarray
    of: np.ndarray
    step: np.ndarray
    train_tokens: int
    log_all: float
    outside: float


def train(learned: DataFrame, known: Vocabulary) -> Model:
    """A model of the ``codes`` of ``learned``.  No texts give one that knows no word."""
    numbers = len(known.mass)
    classes = max(CLASSES, round(numbers ** (1 / 3)))
    few = min(max(CLUSTERED, 16 * classes), len(known.codes))
    classes = min(classes, few)
    # The end is class 0 alone; words have classes from 1; the rare ones the last.
    rare = classes + 1

    def both_few(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        listed = (flat >= 0) & (flat < few)
        both = listed[:-1] & listed[1:]
        return flat[:-1][both], flat[1:][both]

    bigrams = rows_of(pair_counts(learned, both_few))
    of = np.full(numbers, -1)
    of[:few] = 1 + exchange(bigrams, few, classes)
    of[0] = 0
    if numbers > few:
        table = np.full((rare + 1, rare + 1), 0.1)
        np.add.at(table, (of[bigrams[:, 0]], of[bigrams[:, 1]]), bigrams[:, 2])
        # The rare words' neighbours are not counted yet.
        of = exchanged(neighbour_counts(learned, of, few, rare + 1, -1), table, of)
        # Words that have met no word with a class.
        of = np.where(of < 0, 1 + np.arange(numbers) % classes, of)
        for _ in range(EXCHANGES):
            table = class_pairs(learned, of, rare) + 0.1
            of = exchanged(neighbour_counts(learned, of, few, rare + 1, rare), table, of)
    between = class_pairs(learned, of, rare)
    # Each text is preceded by an end: that of the one before it, or the first.
    mass = np.bincount(of, known.mass, rare + 1)
    mass[rare] = sum(known.rare) + 1
    everything = known.total + known.distinct + 1
    smooth = (between + mass / everything) / (between.sum(axis=1, keepdims=True) + 1)
    step = np.log10(MIX * smooth / np.maximum(mass, 1) + (1 - MIX) / everything)
    return Model(
        np.log10(known.n + 1), of, step, int(known.total), float(np.log10(everything)),
        known.rare[0] / max(known.total, 1),
    )


def class_pairs(learned: DataFrame, of: np.ndarray, rare: int) -> np.ndarray:
    """How often each class follows each other one."""

    def keys(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.where(flat >= 0, of[flat], rare)
        return own[:-1], own[1:]

    table = np.zeros((rare + 1, rare + 1))
    rows = rows_of(pair_counts(learned, keys))
    table[rows[:, 0], rows[:, 1]] = rows[:, 2]
    return table


def scored(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """For every row of the table of numbers ``rows``: ``doc_id``, ``n_tokens``,
    ``n_known``, ``base_score`` and ``score``, in log10.

    What the head and the classes say is added up in the tasks.  Other words are joined
    with their counts; none of them is frequent, so no key of that join is busy.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, size = len(model.step) - 1, len(model.log_count)
        for whole in batches:
            for batch in slices(whole, 10_000):
                flat, ends = in_line(batch.column(2))
                own = np.where(flat >= 0, model.of[flat], rare)
                head = (flat >= 0) & (flat < size)
                counted = np.where(head, model.log_count[np.where(head, flat, 0)], 0.0)
                # A token counts with the end that closes its text.
                each = [counted > 0, counted, np.concatenate(([0.0], model.step[own[:-1], own[1:]]))]
                known, counted, stepped = (np.add.reduceat(x.astype(float)[1:], ends[:-1]) for x in each)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(np.diff(ends)),
                        pa.array(known.astype(np.int64)), pa.array(counted), pa.array(stepped),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "counted", "stepped"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.select("row", "doc_id", "codes").mapInArrow(
        run,
        f"row bigint, doc_id {kind}, n_tokens bigint, known bigint, counted double, stepped double",
    )
    rare = (
        rows.select("row", F.explode("others").alias("other"))
        .select("row", "other.word", "other.times").join(counts, "word")
        .groupBy("row").agg(
            F.sum("times").alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_counted"),
        )
    )
    log_counts = F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))
    return marked.join(rare, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (log_counts - F.col("n_tokens") * F.lit(model.log_all)).alias("base_score"),
        (log_counts + F.col("stepped")).alias("score"),
    )


def language_model(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Scores of every row of ``docs`` under a model of the rows where ``learn`` holds.

    Returns ``doc_id``, ``n_tokens`` (words and the end), ``n_known`` (those seen in
    training), ``train_tokens``, ``base_score`` (of single words, add one) and
    ``score`` (of the class model), both as log10 of the probability of the text.
    Null texts read as empty: only the end.  An empty table gives no rows; if nothing
    is learned, no token is known.
    """
    learns = F.coalesce(learn, F.lit(False))
    picked = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), learns.alias("learn")
    )
    counts = written(word_counts(picked.filter("learn").select("text")), "lm-counts")
    known = vocabulary(counts)
    rows = coded(picked, known.codes, known.hashes)
    model = train(rows.filter("learn"), known)
    return scored(rows, model, counts).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
