"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no piece can reach across (before a run of spaces, and around
characters that no longer piece has); equal words are encoded once.  The words of a
block lie in one flat array of symbols.  A round looks up the rank of every
neighbouring pair, takes the least one of each word, merges its occurrences from the
left, and closes the gaps, until no word has a pair left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices

SPACE = "▁"
NONE = np.iinfo(np.int64).max
#: Words, and characters of words, whose ids a worker keeps at a time.
REMEMBER = 300_000
REMEMBER_LETTERS = 8_000_000

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass
class Vocabulary:
    """Pieces of a BPE model with byte fallback, and which pairs make a longer one.

    Symbols are piece ids; characters that only occur inside pieces, and then all
    other characters, get numbers beyond them.
    """

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    number: dict[str, int] = field(init=False)
    pair_keys: np.ndarray = field(init=False)
    pair_ranks: np.ndarray = field(init=False)
    pair_made: np.ndarray = field(init=False)
    safe: np.ndarray = field(init=False)
    of_point: np.ndarray = field(init=False)

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file; only plain BPE models without further normalisation,
        with a dummy prefix and byte fallback, are understood."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces
        kinds = [p.type for p in model.pieces]
        if (
            not plain or spec.remove_extra_whitespaces or not model.trainer_spec.byte_fallback
            or model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix
            or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}
            or any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces)
        ):
            raise ValueError(f"not a plain BPE model: {path}")
        return Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], kinds)

    def __post_init__(self) -> None:
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.number = dict(normal)
        for piece in normal:
            for c in piece:
                self.number.setdefault(c, len(self.pieces) + len(self.number))
        self.of_point = np.full(0x110000, -1)
        for c, i in self.number.items():
            if len(c) == 1:
                self.of_point[ord(c)] = i
        # Equal scores have equal ranks: the leftmost of them goes first.
        order = {s: r for r, s in enumerate(sorted({-self.scores[i] for i in normal.values()}))}
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = self.number.get(piece[:cut]), self.number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (order[-self.scores[i]], i)
        keys = sorted(pairs)
        self.pair_keys = np.array(keys, np.int64)
        self.pair_ranks = np.array([pairs[k][0] for k in keys], np.int64)
        self.pair_made = np.array([pairs[k][1] for k in keys], np.int64)
        # A rank is safe to merge everywhere at once if what it makes has no pair of
        # the same or a smaller rank, which would have to go in between.
        least = np.full(len(self.pieces) + len(self.number) + 1, NONE)
        np.minimum.at(least, self.pair_keys >> 32, self.pair_ranks)
        np.minimum.at(least, self.pair_keys & 0xFFFFFFFF, self.pair_ranks)
        self.safe = np.ones(len(order), bool)
        np.logical_and.at(self.safe, self.pair_ranks, least[self.pair_made] > self.pair_ranks)
        inner = sorted({c for p in normal if len(p) > 1 for c in p} - {SPACE})
        letters = "".join(map(re.escape, inner))
        self._cut = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|.", re.DOTALL)
        byte_ids = [i for i, k in enumerate(self.kinds) if k == BYTE]
        self._byte = {int(self.pieces[i][3:5], 16): i for i in byte_ids}
        self._value = {i: b for b, i in self._byte.items()}

    def words(self, text: str) -> list[str]:
        """The text as the model sees it, cut where no piece reaches across."""
        if not text:
            return []
        return self._cut.findall(SPACE + text.replace(" ", SPACE))

    def pair_index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where each pair stands in the table, -1 for none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, at, -1)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of all words in one array, and where each word begins (and the
        last ends); characters without a number are -1."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_point[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [symbols[:0]], [word[:0]]
        found = np.full(len(symbols), -1)
        if len(symbols) > 1:
            found[:-1] = self.pair_index(symbols[:-1], symbols[1:])
            found[:-1][(word[:-1] != word[1:]) | (symbols[:-1] < 0) | (symbols[1:] < 0)] = -1
        while len(symbols):
            rank = np.where(found >= 0, self.pair_ranks[found], NONE)
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.concatenate((begin, [len(word)])))
            least = np.minimum.reduceat(rank, begin)
            done = least == NONE
            if done.any():
                rest = np.repeat(~done, size)
                done_symbols.append(symbols[~rest])
                done_words.append(word[~rest])
                symbols, word, found, rank = symbols[rest], word[rest], found[rest], rank[rest]
                size, least = size[~done], least[~done]
                if not len(symbols):
                    break
            mine = np.repeat(least, size)
            hit = np.flatnonzero(rank == mine)
            # Of neighbours that overlap every other one counts, from the left.
            apart = np.concatenate(([True], np.diff(hit) > 1))
            start = np.maximum.accumulate(np.where(apart, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            first = np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))
            hit = hit[first | self.safe[mine[hit]]]
            symbols[hit] = self.pair_made[found[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, found = symbols[keep], word[keep], found[keep]
            hit = place[hit]
            near = np.zeros(len(symbols) + 1, bool)
            near[hit] = near[hit - 1] = True
            again = np.flatnonzero(near[:-1])
            found[again] = -1
            again = again[again + 1 < len(symbols)]
            again = again[
                (word[again] == word[again + 1]) & (symbols[again] >= 0) & (symbols[again + 1] >= 0)
            ]
            found[again] = self.pair_index(symbols[again], symbols[again + 1])
        owner = np.concatenate(done_words)
        bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(words)))))
        return np.concatenate(done_symbols)[np.argsort(owner, kind="stable")], bounds

    def ids_of(self, word: str, symbols: list[int]) -> list[int]:
        """Piece ids of a word; characters that are no piece become their bytes."""
        ids: list[int] = []
        at = 0
        for s in symbols:
            if 0 <= s < len(self.pieces):
                ids.append(s)
                at += len(self.pieces[s])
            else:
                ids += [self._byte[b] for b in word[at].encode()]
                at += 1
        return ids

    def flat_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has."""
        symbols, bounds = self.merged(words)
        sizes = np.diff(bounds)
        odd = (symbols < 0) | (symbols >= len(self.pieces))
        if not odd.any():
            return symbols.astype(np.int32), sizes
        parts, done = [], 0
        for w in np.unique(np.searchsorted(bounds, np.flatnonzero(odd), side="right") - 1).tolist():
            ids = self.ids_of(words[w], symbols[bounds[w] : bounds[w + 1]].tolist())
            parts += [symbols[done : bounds[w]], np.array(ids)]
            done, sizes[w] = bounds[w + 1], len(ids)
        parts.append(symbols[done:])
        return np.concatenate(parts).astype(np.int32), sizes

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return self.flat_ids(self.words(text))[0].tolist()

    def spelling(self, i: int) -> bytes:
        """What one id adds to the decoded text, as bytes."""
        if i in self._value:
            return bytes([self._value[i]])
        return {NORMAL: self.pieces[i].replace(SPACE, " ").encode(), UNKNOWN: " ⁇ ".encode()}.get(
            self.kinds[i], b""
        )

    def spell(self, ids: list[int]) -> str:
        """What the ids stand for: runs of bytes are read as UTF-8 (broken ones as
        U+FFFD), control pieces are silent."""
        parts: list[str] = []
        pending = bytearray()
        for i in [*ids, -1]:
            if i in self._value:
                pending.append(self._value[i])
                continue
            if pending:
                parts.append(_read(bytes(pending)))
                pending.clear()
            if i >= 0 and self.kinds[i] == NORMAL:
                parts.append(self.pieces[i].replace(SPACE, " "))
            elif i >= 0 and self.kinds[i] == UNKNOWN:
                parts.append(" ⁇ ")
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the space that encoding puts first."""
        text = self.spell(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        spaced = first is not None and self.kinds[first] == NORMAL and text.startswith(" ")
        return text[1:] if spaced else text


def _read(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class Memory:
    """Ids of words in one flat array that grows, and where those of each word lie.

    When it is full it keeps the words that came more than once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        numbers = range(len(vocabulary.pieces))
        self.names = pa.array([b"%d" % i for i in numbers], pa.binary())
        self.spellings = pa.array([vocabulary.spelling(i) for i in numbers], pa.binary())
        self._keep([], np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place = dict(zip(words, range(len(words))))
        self.letters = sum(map(len, words))
        self.ids, self.sizes = ids, sizes
        self.begins = np.cumsum(sizes) - sizes
        self.uses = np.zeros(len(words), np.int64)

    def _ranges(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by their places, one after the other, and their sizes."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.begins[at] - ends + sizes, sizes) + np.arange(total)], sizes

    def _learn(self, needed: set[str]) -> None:
        words = list(needed.difference(self.place))
        if len(self.place) + len(words) > REMEMBER or self.letters > REMEMBER_LETTERS:
            often = np.flatnonzero(self.uses > 1)
            if 2 * len(often) > REMEMBER or self.letters > REMEMBER_LETTERS:
                often = often[:0]
            kept = set(often.tolist())
            names = [w for w, i in self.place.items() if i in kept]
            self._keep(names, *self._ranges(often))
            words = list(needed.difference(self.place))
        ids, sizes = self.vocabulary.flat_ids(words)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.letters += sum(map(len, words))
        self.begins = np.concatenate((self.begins, len(self.ids) + np.cumsum(sizes) - sizes))
        self.ids = np.concatenate((self.ids, ids))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int64)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where those of each text begin (and end)."""
        cut = [self.vocabulary.words(t) for t in texts]
        words = [w for part in cut for w in part]
        needed = set(words)
        if not needed <= self.place.keys():
            self._learn(needed)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        self.uses += np.bincount(at, minlength=len(self.uses))
        ids, sizes = self._ranges(at)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, ends[np.concatenate(([0], np.cumsum([len(part) for part in cut])))]

    def joined(self, table: pa.Array, ids: np.ndarray, bounds: np.ndarray, mark: bytes) -> list[bytes]:
        """For each text what ``table`` has for its ids, with ``mark`` in between."""
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), table.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(mark, pa.binary())).to_pylist()

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The decoded text (UTF-8) of each text's ids."""
        out = []
        for i, spelt in enumerate(self.joined(self.spellings, ids, bounds, b"")):
            try:
                spelt.decode()
            except UnicodeDecodeError:
                spelt = self.vocabulary.spell(ids[bounds[i] : bounds[i + 1]].tolist()).encode()
            out.append(spelt[1:])
        return out


#: What a Python worker remembers, by model: it serves all its tasks.
_BUILT: dict[str, Memory] = {}


def memory_of(key: str, vocabulary: Vocabulary) -> Memory:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Memory(vocabulary)
    return _BUILT[key]


def encoded(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row of ``docs``: ``doc_id``, the ``ids`` of its whole text by the model
    file ``model``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas)
    and ``decoded_sha256`` (of the decoded text).

    Null and empty texts have no ids.  Repeated rows stay repeated.
    """
    vocabulary = Vocabulary.load(model)

    def sha256(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of(model, vocabulary)
        for whole in batches:
            for batch in slices(whole, 2000, 2 << 20):
                ids, bounds = memory.encode([t or "" for t in batch.column(1).to_pylist()])
                names = memory.joined(memory.names, ids, bounds, b",")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(map(sha256, names), pa.string()),
                        pa.array(map(sha256, memory.decoded(ids, bounds)), pa.string()),
                    ],
                    ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run,
        f"doc_id {kind}, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
