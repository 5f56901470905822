"""Toxicity by maximum-scoring segments of token log-odds.

Pieces of words get log-odds between toxic and other documents, with an informative
Dirichlet prior, so rare pieces stay near zero, and a word gets those of its surest
toxic piece, unless it is well known as a whole.  The k-th copy of a word within one
document counts a k-th, or one long repetition would pass for evidence.  A linear scan over a document
finds every maximal segment of positive evidence.  A segment's score becomes an
E-value by the extreme-value law of such scores (Karlin and Altschul): how many
segments as good a clean text of this length would have by chance.  What is
significant is summed up and mapped to a probability on labelled rows that took no
part in the token counts.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, smallest_by_hash, utf8, written

#: Labelled rows that the model is fitted on, at most (those of smallest hash).
TRAIN_ROWS = 24_000
#: Of these, one in so many calibrates, the others count pieces.
CALIBRATE = 3
#: Lengths of the pieces, in characters, word marks included.
PIECES = (4, 6)
#: Pieces in fewer toxic documents have no weight.
MIN_DOCS = 4
#: Words in so many documents are judged as a whole, not by their pieces.
WELL_KNOWN = 25
#: Weight of the prior for each of the two classes, as a share of all documents.
PRIOR = 0.02
#: Log-odds are taken so many standard deviations nearer to zero.
SURE = 1.0
#: Words whose weight a task keeps at a time.
REMEMBER = 100_000
#: What every token costs a segment, so that chance does not add up.
DRIFT = 0.5
#: Segments with an E-value below this are significant.
E_VALUE = 0.05
TOXIC_AT = 0.7
EULER = 0.5772156649

_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Runs of letters, A-Z lower-cased; every byte beyond ASCII counts as a letter."""
    return text.translate(_KEEP).split()


def spelled(text: Column) -> Column:
    """The ``tokens`` of a text with a space between them: equal for texts that the
    model cannot tell apart."""
    letters = F.trim(F.regexp_replace(text, r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", " "))
    return F.translate(letters, string.ascii_uppercase, string.ascii_lowercase)


def pieces(word: bytes) -> set[str]:
    """The word and its short runs of characters, its begin and end marked."""
    marked = f"^{word.decode('utf-8', 'replace')}$"
    found = {marked[i : i + n] for n in PIECES for i in range(len(marked) - n + 1)}
    return found | {marked}


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, last), in text order, in
    linear time (Ruzzo and Tompa)."""
    ahead = np.concatenate(([0.0], np.cumsum(scores)))
    low: list[float] = []
    high: list[float] = []
    begin: list[int] = []
    end: list[int] = []
    smaller: list[int] = []  # the nearest earlier candidate that starts lower
    for at in np.flatnonzero(scores > 0).tolist():
        left, right, start = float(ahead[at]), float(ahead[at + 1]), at
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= left:
                j = smaller[j]
            if j < 0 or high[j] >= right:
                low.append(left)
                high.append(right)
                begin.append(start)
                end.append(at)
                smaller.append(j)
                break
            left, start = low[j], begin[j]
            del low[j:], high[j:], begin[j:], end[j:], smaller[j:]
    return [(h - x, b, e) for x, h, b, e in zip(low, high, begin, end)]


@dataclass
class Model:
    """Token weights, the extreme-value law, and the map to a probability."""

    weight: dict[str, float] = field(default_factory=dict)
    unit: float = 1.0  # lambda of the law
    log_k: float = 0.0
    beta: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)
    known: dict[bytes, float] = field(default_factory=dict, repr=False)

    def of(self, word: bytes) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            found = self.weight.get(f"^{word.decode('utf-8', 'replace')}$")
            if found is None:
                found = max(self.weight.get(x, 0.0) for x in pieces(word))
            self.known[word] = found
        return found

    def scores(self, text: bytes) -> np.ndarray:
        words = tokens(text)
        scores = np.fromiter(map(self.of, words), np.float64, len(words))
        copies: dict[bytes, int] = {}
        for at in np.flatnonzero(scores).tolist():
            copies[words[at]] = k = copies.get(words[at], 0) + 1
            scores[at] /= k
        return scores - DRIFT

    def scan(self, text: bytes) -> tuple[int, list[tuple[float, int, int]]]:
        scores = self.scores(text)
        return len(scores), segments(scores)

    def surprise(self, score: float, n: int) -> float:
        """Minus the logarithm of the E-value of a segment among ``n`` tokens."""
        return self.unit * score - math.log(max(n, 1)) - self.log_k

    def features(self, text: bytes) -> tuple[float, float, float]:
        """The best segment, the sum of all significant ones, and their share."""
        n, found = self.scan(text)
        sure = [self.surprise(s, n) for s, _, _ in found]
        good = [x for x in sure if x > -math.log(E_VALUE)]
        best = max(sure, default=-math.log(max(n, 1)) - self.log_k)
        return best, math.log1p(sum(good)), math.log1p(1000 * len(good) / max(n, 1))

    def probability(self, features: np.ndarray) -> np.ndarray:
        x = np.clip(features, -30, 60) @ np.array(self.beta[1:]) + self.beta[0]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def log_odds(rows: list[tuple[str, int, int]], total: tuple[int, int]) -> dict[str, float]:
    """Log-odds of each piece that surely speaks for toxicity, by their lower bound,
    given the toxic and other documents that have it, and how many of each there are;
    0 for whole words that are well known and don't."""
    out = {}
    weight = 1 + PRIOR * sum(total)
    for piece, toxic, other in rows:
        prior = 0.5 + PRIOR * (toxic + other)
        a, b = toxic + prior, other + prior
        odds = math.log(a / (total[0] + weight - a)) - math.log(b / (total[1] + weight - b))
        sure = odds - SURE * math.sqrt(1 / a + 1 / b)
        if sure > DRIFT:
            out[piece] = sure
        elif piece[0] == "^" and piece[-1] == "$" and toxic + other >= WELL_KNOWN:
            out[piece] = 0.0
    return out


def law(scores: np.ndarray, times: np.ndarray) -> float:
    """The positive root of E[exp(unit * score)] = 1, for the scores of the words of
    clean documents; a steep one if none of them is positive."""
    low, high = 1e-3, 5.0
    for _ in range(60):
        unit = (low + high) / 2
        value = (times * np.exp(unit * scores)).sum() / max(times.sum(), 1)
        low, high = (unit, high) if value < 1 else (low, unit)
    return low


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the constant first, by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + keep, x.T @ (p - y) + keep @ beta)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``usable`` restricts the labels that may be seen, by an expression over doc_id.
    Of these at most ``TRAIN_ROWS`` are used.  Null ids, texts and labels are left
    out; an id labelled twice counts as toxic if one label says so.  Without both
    kinds of documents every text gets the same low score.
    """
    known = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if usable is not None:
        known = known.filter(usable)
    picked = smallest_by_hash(
        known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), F.col("doc_id"), TRAIN_ROWS
    )
    # At most TRAIN_ROWS pairs of numbers: broadcast is safe at any size.
    rows = (
        docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
        .select(
            "text", "toxic", F.sha2(spelled(F.col("text")), 256).alias("spelled"),
            F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATE)).alias("part"),
            F.xxhash64("doc_id").alias("h"),
        )
    )
    # Of copies, by their whole text, always the same one counts, so the same rows make
    # the same model.
    rows = (
        rows.groupBy("toxic", "spelled").agg(F.min_by(F.struct("text", "part"), "h").alias("row"))
        .select("row.text", "toxic", "row.part")
    )
    rows = written(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                for piece in set().union(*map(pieces, set(tokens(text)))):
                    seen.setdefault(piece, [0, 0])[0 if toxic == 1 else 1] += 1
        columns = [pa.array(list(seen), pa.string())]
        columns += [pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(2)]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "toxic", "other"])

    counting = rows.filter("part <> 0").select("text", "toxic")
    size = counting.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not size[0] or not size[1]:
        return Model()
    counts = (
        counting.mapInArrow(counted, "piece string, toxic bigint, other bigint")
        .groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(
            (F.col("toxic") >= MIN_DOCS)
            | (F.col("toxic") + F.col("other") >= WELL_KNOWN) & F.col("piece").rlike(r"^\^.*\$$")
        )
    )
    model = Model(weight=log_odds([tuple(r) for r in counts.collect()], tuple(size)))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in utf8(batch.column(0)):
                scores = model.scores(text)
                values, times = np.unique(scores, return_counts=True)
                found.append((len(scores), [s for s, _, _ in segments(scores)], values, times))
            lists = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x[0] for x in found], pa.int64())]
                + [pa.array([list(x[i]) for x in found], lists) for i in (1, 2, 3)],
                ["toxic", "n", "segments", "scores", "times"],
            )

    kind = rows.schema["toxic"].dataType.simpleString()
    lists = ", ".join(f"{c} array<double>" for c in ("segments", "scores", "times"))
    held = (
        rows.filter("part = 0").select("text", "toxic")
        .mapInArrow(measured, f"toxic {kind}, n bigint, {lists}").collect()
    )
    clean = [r for r in held if r["toxic"] != 1]
    flat = [np.concatenate([[0.0], *(r[c] for r in clean)]) for c in ("scores", "times")]
    model.unit = law(*flat)
    return calibrated(model, [(int(r["toxic"] == 1), r["n"], r["segments"]) for r in held])


def calibrated(model: Model, held: list[tuple[int, int, list[float]]]) -> Model:
    """``model`` with the law's constant from clean rows and its map to a probability."""
    clean = [model.unit * max(s) - math.log(n) for t, n, s in held if not t and n and s]
    if not clean or len({t for t, _, _ in held}) < 2:
        return model
    # The median of the law, so that clean-labelled outliers have no say.
    model.log_k = float(np.median(clean)) + math.log(math.log(2))
    x = []
    for _, n, found in held:
        sure = [model.surprise(s, n) for s in found]
        good = [v for v in sure if v > -math.log(E_VALUE)]
        best = max(sure, default=-math.log(max(n, 1)) - model.log_k)
        x.append((best, math.log1p(sum(good)), math.log1p(1000 * len(good) / max(n, 1))))
    y = np.array([t for t, _, _ in held], np.float64)
    model.beta = tuple(logistic(np.clip(np.array(x), -30, 60), y))
    return model


def scorer(model: Model):
    """A function for a column of texts: the probability that each is toxic (null
    reads as empty)."""

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for piece in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 1000):
                found += [model.features(x) for x in utf8(piece.column(0))]
            yield pa.array(model.probability(np.array(found).reshape(-1, 3)), pa.float64())

    return toxicity


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``first_word``, ``last_word`` (of the runs of letters of the text,
    from 0), ``score`` and ``e_value`` of every significant passage.

    Null and empty texts have none; repeated rows repeat theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                rows: list[tuple[int, int, int, float, float]] = []
                for at, text in enumerate(utf8(batch.column(1))):
                    n, found = model.scan(text)
                    for score, first, last in found:
                        sure = model.surprise(score, n)
                        if sure > -math.log(E_VALUE):
                            rows.append((at, first, last, score, math.exp(-sure)))
                columns = [list(c) for c in zip(*rows)] if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64()))]
                    + [pa.array(columns[i], pa.int64()) for i in (1, 2)]
                    + [pa.array(columns[i], pa.float64()) for i in (3, 4)],
                    ["doc_id", "first_word", "last_word", "score", "e_value"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, first_word bigint, last_word bigint, score double, e_value double",
    )
