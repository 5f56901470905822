"""Language identification by a convolutional network over bytes, trained in numpy.

A text is cut into windows of a fixed length.  Every byte is embedded, filters of
several widths slide over a window, the maximum of each filter is kept and a softmax
turns the maxima into languages.  The probabilities of the windows are averaged.

Embedding and filters are linear, so for prediction they are multiplied out once
into tables that say what one or two bytes add to each filter: sliding a filter is
then looking up its bytes and adding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import flat_utf8, slices

#: Labelled documents the network is trained on, at most for each language.
TRAIN_ROWS = 1500
#: Characters taken of each of them, from a hashed place.
TRAIN_CHARS = 240
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
EPOCHS = 6
BATCH = 64
RATE = 0.01
#: Windows scored at a time.
AT_ONCE = 1024
#: Byte classes: letters keep theirs, A-Z become a-z, digits one, the rest of ASCII one.
_CLASS = np.array(
    [
        b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else 27 if 48 <= b <= 57
        else b - 100 if b >= 128 else 0
        for b in range(256)
    ],
    np.uint8,
)
CLASSES = 156


@dataclass
class Network:
    """Weights: ``embed`` (class, e), ``filters`` by width (width, e, f), ``out``."""

    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    tables: list[list[np.ndarray]] = field(default_factory=list)

    def compiled(self) -> Network:
        """With what each pair of bytes, or last odd byte, adds to the filters."""
        self.tables = []
        for kernel in self.filters:
            single = [(self.embed @ k).astype(np.float32) for k in kernel]
            pairs = [
                (single[i][:, None, :] + single[i + 1][None, :, :]).reshape(CLASSES**2, -1)
                for i in range(0, len(kernel) - 1, 2)
            ]
            self.tables.append(pairs + ([single[-1]] if len(kernel) % 2 else []))
        return self

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """For windows of byte classes, one row of language probabilities each."""
        codes = windows[:, :-1].astype(np.int32) * CLASSES + windows[:, 1:]
        pooled = []
        for width, tables in zip(WIDTHS, self.tables):
            n = windows.shape[1] - width + 1
            total = tables[0].take(codes[:, :n], axis=0)
            for i, more in enumerate(tables[1:], 1):
                at = windows if len(more) == CLASSES else codes
                total += more.take(at[:, 2 * i : 2 * i + n], axis=0)
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return softmax(hidden @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, target: np.ndarray, languages: list[str]) -> Network:
    """A network trained by Adam on windows of byte classes; always the same for the
    same rows."""
    rng = np.random.default_rng(7)
    k = len(languages)
    width = len(WIDTHS) * FILTERS
    net = Network(
        languages,
        rng.normal(0, 0.5, (CLASSES, EMBED)),
        [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS],
        np.zeros(width),
        rng.normal(0, 1 / np.sqrt(width), (width, k)),
        np.zeros(k),
    )
    weights = [net.embed, *net.filters, net.bias, net.out, net.out_bias]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = windows[rows].astype(np.int64), target[rows]
            embedded = net.embed[x]
            pooled, where = [], []
            for w, kernel in zip(WIDTHS, net.filters):
                n = x.shape[1] - w + 1
                total = sum(embedded[:, j : j + n] @ kernel[j] for j in range(w))
                where.append(total.argmax(axis=1))
                pooled.append(total.max(axis=1))
            hidden = np.concatenate(pooled, axis=1) + net.bias
            active = np.maximum(hidden, 0)
            delta = softmax(active @ net.out + net.out_bias)
            delta[np.arange(len(y)), y] -= 1
            delta /= len(y)
            back = (delta @ net.out.T) * (hidden > 0)
            d_embed = np.zeros_like(net.embed)
            d_filters = []
            b = np.arange(len(y))[:, None]
            for i, (w, kernel) in enumerate(zip(WIDTHS, net.filters)):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                d_kernel = np.zeros_like(kernel)
                for j in range(w):
                    cls = x[b, where[i] + j]
                    d_kernel[j] = np.einsum("bf,bfe->ef", g, net.embed[cls])
                    np.add.at(d_embed, cls, g[:, :, None] * kernel[j].T[None])
                d_filters.append(d_kernel)
            grads = [d_embed, *d_filters, back.sum(0), active.T @ delta, delta.sum(0)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def windows_of(classes: np.ndarray) -> np.ndarray:
    """Windows of fixed length that cover a text; neighbours share the bytes that the
    widest filter needs, the last one is padded with spaces."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(classes) - max(WIDTHS) + 1) // step))
    padded = np.zeros((n - 1) * step + WINDOW, np.uint8)
    padded[: len(classes)] = classes[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


def train(docs: DataFrame, usable: Column | None = None) -> Network | None:
    """A network from ``text`` and ``lang`` of ``docs`` (with ``doc_id``).

    At most ``TRAIN_ROWS`` documents of each language are used, those of smallest
    hashed text, and ``TRAIN_CHARS`` characters of each.  Rows without text, without
    a letter, or without a language are left out.  No usable row: None.
    """
    known = docs.filter("lang IS NOT NULL")
    if usable is not None:
        known = known.filter(usable)
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    hashed = F.xxhash64("text", "doc_id")
    # Hashes below a share of all values, half as many rows again as needed.
    wanted = F.lit(False)
    for lang, size in sizes.items():
        share = 1.5 * TRAIN_ROWS / size
        few = F.lit(True) if share >= 1 else hashed < F.lit(int(-(2**63) + share * 2**64))
        wanted = wanted | ((F.col("lang") == lang) & few)
    place = F.pmod(F.xxhash64("text", F.lit(1)), F.length("text")) - TRAIN_CHARS
    taken = F.substring("text", F.greatest(F.lit(1), place).cast("int"), F.lit(TRAIN_CHARS))
    found = (
        known.filter(F.col("text").isNotNull() & wanted & F.col("text").rlike(r"\p{L}"))
        .select("lang", hashed.alias("h"), taken.alias("taken")).collect()
    )
    rows: list[tuple[str, str]] = []
    for lang in sorted(sizes):
        mine = sorted((r["h"], r["taken"]) for r in found if r["lang"] == lang)
        rows += [(text, lang) for _, text in mine[:TRAIN_ROWS]]
    if not rows:
        return None
    languages = sorted(sizes)
    flat = [_CLASS[np.frombuffer(t.encode()[:WINDOW], np.uint8)] for t, _ in rows]
    windows = np.stack([np.pad(x, (0, WINDOW - len(x))) for x in flat])
    target = np.array([languages.index(lang) for _, lang in rows])
    return fit(windows, target, languages).compiled()


def averaged(net: Network, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Language probabilities of each text: the mean over its windows, windows with
    more letters counting more."""
    classes = _CLASS[flat]
    sums = np.zeros((len(bounds) - 1, len(net.languages)))
    pending: list[np.ndarray] = []
    owner: list[int] = []

    def score() -> None:
        block = np.concatenate(pending)
        letters = 1e-6 + ((block > 0) & (block != 27)).mean(axis=1)
        found = net.probabilities(block) * letters[:, None]
        np.add.at(sums, np.array(owner), found)
        pending.clear()
        owner.clear()

    for at in range(len(bounds) - 1):
        windows = windows_of(classes[bounds[at] : bounds[at + 1]])
        for begin in range(0, len(windows), AT_ONCE):
            some = windows[begin : begin + AT_ONCE]
            pending.append(some)
            owner += [at] * len(some)
            if len(owner) >= AT_ONCE:
                score()
    if owner:
        score()
    return sums / sums.sum(axis=1, keepdims=True)


def identifier(net: Network | None):
    """A function for a column of texts: a struct of ``lang`` and ``score``, the share
    of the language among the averaged probabilities.

    Null texts, texts without a letter and any text without a network: ``und``, 0.
    """
    undecided = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for piece in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 2000):
                share = averaged(net, *flat_utf8(piece.column(0)))
                best = share.argmax(axis=1)
                named = pa.array([net.languages[i] for i in best], pa.string())
                score = pa.array(np.clip(share.max(axis=1), 0, 1), pa.float64())
                parts.append(pa.StructArray.from_arrays([named, score], ["lang", "score"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], undecided)

    def column(text: Column) -> Column:
        und = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
        if net is None:
            return und
        return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), language(text)).otherwise(und)

    return column
