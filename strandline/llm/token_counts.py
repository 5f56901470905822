"""Token counts of byte-level BPE by finite-state transducers.

Two transducers follow each other.  The first cuts a text into words, as the
tokenizer's pattern does: it reads character classes and says where a word begins.
Its state after a piece of text is a function of the state before, so pieces are
summarised as maps from state to state, the maps are composed in a parallel prefix
scan, and then all pieces are read at once.

The second reads the bytes of a word and emits tokens.  Whether tokens in a row are
what BPE makes depends on neighbouring pairs only, so a state is the set of ways in
which the last bytes may go on: (token before, place in the trie of tokens, tokens so
far).  These sets are made deterministic when first met: what all ways have in common
is emitted on the transition, and a state says what is left if a word ends there.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices

#: Characters in a piece of the prefix scan.
PIECE = 64
#: States of the second transducer that a task keeps at a time.
STATES = 100_000

#: Tokens below a place in the trie, up to which tokens before are told apart exactly.
MANY = 80

# Character classes of the first transducer.  FULL: letters that end a contraction
# at once; R, V, LL begin one of two letters, which E, E, LL end.
FULL, R, E, V, LL, LETTER, NUMBER, OTHER, QUOTE, SPACE, BLANK = range(11)
CLASSES = 11
# Its states: in a word of letters, numbers or others; after a quote that begins a
# word, and after r, v, l behind it; after a contraction; after one blank, or more,
# of which the last is a space or not; before any text.
(IN_L, IN_N, IN_O, AFTER_Q, AFTER_QR, AFTER_QV, AFTER_QL, DONE,
 ONE_SPACE, ONE_BLANK, SPACES, BLANKS, START) = range(13)
N_STATES = 13
#: What a transition says: a word begins here, or at the character before.
HERE, BEFORE = 1, 2
#: The characters with the property White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _alone(c: int) -> int:
    """State after a character that begins a word of its own."""
    if c <= LETTER:
        return IN_L
    return {NUMBER: IN_N, OTHER: IN_O, QUOTE: AFTER_Q, SPACE: ONE_SPACE, BLANK: ONE_BLANK}[c]


def _transition(state: int, c: int) -> tuple[int, int]:
    """(next state, where words begin) for one character of class ``c``."""
    late = {AFTER_QR: E, AFTER_QV: E, AFTER_QL: LL}
    if state in late:
        if c == late[state]:
            return DONE, 0
        # The quote was a word, and the letter behind it began another one.
        after, begins = _transition(IN_L, c)
        return after, begins | BEFORE
    blank = c in (SPACE, BLANK)
    if state in (ONE_SPACE, ONE_BLANK, SPACES, BLANKS):
        if blank:
            return (SPACES if c == SPACE else BLANKS), 0
        split = BEFORE if state in (SPACES, BLANKS) else 0
        if state in (ONE_SPACE, SPACES):
            return (IN_O if c == QUOTE else _alone(c)), split
        return _alone(c), split | HERE
    if state == AFTER_Q:
        begun = {FULL: DONE, R: AFTER_QR, V: AFTER_QV, LL: AFTER_QL, OTHER: IN_O, QUOTE: IN_O}
        if c in begun:
            return begun[c], 0
        return _alone(c), HERE
    goes_on = {IN_L: c <= LETTER, IN_N: c == NUMBER, IN_O: c in (OTHER, QUOTE)}.get(state, False)
    return (state, 0) if goes_on else (_alone(c), HERE)


def cutter() -> tuple[np.ndarray, np.ndarray]:
    """Tables (input, state) -> next state and output; inputs from ``CLASSES`` on are
    the first characters of texts, which forget what came before."""
    after = np.zeros((2 * CLASSES, N_STATES), np.uint8)
    says = np.zeros((2 * CLASSES, N_STATES), np.uint8)
    for c in range(CLASSES):
        for s in range(N_STATES):
            after[c, s], says[c, s] = _transition(s, c)
            after[c + CLASSES, s] = _alone(c)
            says[c + CLASSES, s] = HERE | (BEFORE if s in (AFTER_QR, AFTER_QV, AFTER_QL) else 0)
    return after, says


def character_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = BLANK
    out[32] = SPACE
    out[39] = QUOTE
    for letters, c in (("stmd", FULL), ("r", R), ("e", E), ("v", V), ("l", LL)):
        out[[ord(x) for x in letters]] = c
    return out


def begins(classes: np.ndarray, first: np.ndarray, after: np.ndarray, says: np.ndarray) -> np.ndarray:
    """Where words begin in texts one after another; ``first`` marks first characters.

    Pieces of fixed length are read in step, once from every state to get their maps
    and, after the maps are composed from the left, once from the state they meet.
    """
    n = len(classes)
    rows = -(-(n + 1) // PIECE)
    # The padding looks like new texts, so what is open at the end is closed.
    given = np.full(rows * PIECE, CLASSES, np.uint8)
    given[:n] = classes + CLASSES * first.astype(np.uint8)
    given = given.reshape(rows, PIECE).T.astype(np.intp) * N_STATES
    flat_after, flat_says = after.ravel(), says.ravel()
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (rows, 1))
    for step in given:
        maps = flat_after.take(step[:, None] + maps)
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.concatenate(([START], maps[:-1, START])).astype(np.intp)
    out = np.zeros((PIECE, rows), np.uint8)
    for i, step in enumerate(given):
        out[i] = flat_says.take(step + state)
        state = flat_after.take(step + state)
    told = out.T.ravel()[: n + 1]
    return ((told[:n] & HERE) > 0) | ((told[1:] & BEFORE) > 0)


@dataclass
class Vocabulary:
    """Tokens as bytes, merge ranks, and special strings, of a tokenizer file."""

    tokens: list[bytes]
    ranks: dict[tuple[bytes, bytes], int]
    special: list[str]

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a tokenizers file; only byte-level BPE with its usual pattern, without
        normaliser or prefix, is understood."""
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model, cut = given["model"], given["pre_tokenizer"]
        if (
            given["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
            or not cut.get("use_regex", True) or model["type"] != "BPE" or model.get("ignore_merges")
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"])
        ):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        spell = lambda t: bytes(byte[c] for c in t)
        special = [t["content"] for t in given["added_tokens"]]
        return Vocabulary(
            [spell(t) for t in model["vocab"] if t not in special],
            {(spell(a), spell(b)): i for i, (a, b) in enumerate(merges)},
            special,
        )


@dataclass
class Transducer:
    """The second transducer, grown as it is used."""

    vocabulary: Vocabulary
    limit: int = STATES
    after: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.tokens: list[bytes] = []
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.pair: dict[tuple[int, int], bool] = {}
        # How BPE makes each token: of which two, and at which rank.
        halves: list[tuple[bytes, bytes] | None] = []
        below: list[list[int]] = [[1 << 30, 0]]  # tokens under a node, as a range
        for token in sorted(self.vocabulary.tokens):
            last = self.made_of(token)
            if len(token) > 1 and last is None:
                continue  # BPE never makes it
            node, number = 0, len(self.tokens)
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                    below.append([number, 0])
                node = nxt
                below[node][1] = number + 1
            self.token_at[node] = number
            self.tokens.append(token)
            halves.append(last)
        self.below = below
        number = {t: i for i, t in enumerate(self.tokens)}
        self.half = [(number[h[0]], number[h[1]]) if h else None for h in halves]
        self.born = [self.vocabulary.ranks[h] if h else -1 for h in halves]
        self.rank = {
            (number[a], number[b]): r
            for (a, b), r in self.vocabulary.ranks.items() if a in number and b in number
        }
        self.clear()

    def clear(self) -> None:
        self.after = np.full((1024, 256), -1, np.int32)
        self.emits = np.zeros((1024, 256), np.uint8)
        self.rest = np.zeros(1024, np.int32)
        self.stands: dict[int, int | None] = {}
        self.first: dict[tuple, int] = {}
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.state(((-1, 0, 0),))

    def made_of(self, data: bytes) -> tuple[bytes, bytes] | None:
        """The last merge of plain BPE (the best-ranked pair, leftmost, first) if it
        makes these bytes one token."""
        rank = self.vocabulary.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        last = None
        while len(parts) > 1:
            best, at = min((rank.get(p, 1 << 40), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == 1 << 40:
                return None
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE leaves these tokens side by side.

        Going back in time, the token that was made later falls apart into its halves.
        A pair across the border would have been merged if its rank comes before what
        next happens to either half; of equal ranks the left one goes first.
        """
        if a < 0:
            return True
        known = self.pair.get((a, b))
        if known is None:
            if len(self.pair) > 300_000:
                self.pair.clear()
            left, right, known = a, b, True
            left_ends = right_ends = 1 << 40
            while True:
                rank = self.rank.get((left, right), 1 << 40)
                if rank < left_ends and rank <= right_ends and rank < 1 << 40:
                    known = False
                    break
                later_left = self.born[left] > self.born[right]
                if later_left:
                    left_ends, left = self.born[left], self.half[left][1]
                elif self.half[right]:
                    right_ends, right = self.born[right], self.half[right][0]
                else:
                    break
            self.pair[a, b] = known
        return known

    def same(self, a: int, node: int) -> int | None:
        """A token that may stand for ``a`` as the one before, as far as tokens below
        ``node`` are concerned; None if none of them can follow."""
        if a < 0:
            return a
        key = a << 20 | node
        found = self.stands.get(key, -2)
        if found == -2:
            low, high = self.below[node]
            if high - low > MANY:
                found = a if any(self.fits(a, t) for t in range(low, high)) else None
            else:
                fitting = tuple(t for t in range(low, high) if self.fits(a, t))
                found = self.first.setdefault((node, fitting), a) if fitting else None
            self.stands[key] = found
        return found

    def follow(self, ways: tuple, byte: int) -> tuple[tuple, int]:
        """The ways after one more byte, and the tokens they have in common."""
        out = []
        end = None
        for a, node, n in ways:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token_at[node]
            if end is None and token >= 0 and self.fits(a, token):
                end = (token, 0, n + 1)
            a = self.same(a, node)
            if a is not None:
                out.append((a, node, n))
        out.append(end)
        common = min(n for _, _, n in out)
        return tuple((a, node, n - common) for a, node, n in out), common

    def state(self, ways: tuple) -> int:
        at = self.number.get(ways)
        if at is None:
            at = self.number[ways] = len(self.states)
            self.states.append(ways)
            if at >= len(self.rest):
                grow = len(self.rest)
                self.after = np.concatenate((self.after, np.full((grow, 256), -1, np.int32)))
                self.emits = np.concatenate((self.emits, np.zeros((grow, 256), np.uint8)))
                self.rest = np.concatenate((self.rest, np.zeros(grow, np.int32)))
            self.rest[at] = ways[-1][2]
        return at

    def learn(self, state: int, byte: int) -> None:
        ways, common = self.follow(self.states[state], byte)
        self.after[state, byte] = self.state(ways)
        self.emits[state, byte] = common

    def counts(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each word data[start : start + length], all words read in step."""
        if len(self.states) > self.limit:
            self.clear()
        order = np.argsort(-length, kind="stable")
        start, sorted_length = start[order], length[order]
        total = np.zeros(len(order), np.int64)
        state = np.zeros(len(order), np.int32)
        live = len(order)
        for i in range(int(length.max()) if len(length) else 0):
            live = int(np.searchsorted(-sorted_length[:live], -i, side="left"))
            byte = data[start[:live] + i]
            key = state[:live].astype(np.int64) << 8 | byte
            after = self.after.ravel().take(key)
            fresh = after < 0
            if fresh.any():
                for k in np.unique(key[fresh]).tolist():
                    self.learn(k >> 8, k & 255)
                after = self.after.ravel().take(key)
            total[:live] += self.emits.ravel().take(key)
            state[:live] = after
        total += self.rest[state]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class Counter:
    """Both transducers of one vocabulary, at work on lists of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.words = Transducer(vocabulary)
        self.classes = character_classes()
        self.after, self.says = cutter()
        special = "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True)))
        self.special = re.compile(special) if special else None

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string inside is one token, as by default."""
        pieces, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for at, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            extra[at] = len(parts) - 1
            for part in filter(None, parts):
                pieces.append(part)
                owner.append(at)
        if not pieces:
            return extra
        joined = "".join(pieces)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(len(points), bool)
        first[starts] = True
        word = np.flatnonzero(begins(self.classes[points], first, self.after, self.says))
        data = np.frombuffer(joined.encode(), np.uint8)
        sizes = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000)
        offset = (np.cumsum(sizes) - sizes)[word]
        n = self.words.counts(data, offset, np.diff(np.append(offset, len(data))))
        piece = np.searchsorted(starts, word, side="right") - 1
        return extra + np.bincount(np.array(owner)[piece], n, len(texts)).astype(np.int64)


#: What a Python worker has built, by vocabulary: it serves all its tasks.
_BUILT: dict[str, Counter] = {}


def counter_of(key: str, vocabulary: Vocabulary) -> Counter:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Counter(vocabulary)
    return _BUILT[key]


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of its
    whole text by the file ``tokenizer``, and ``over_limit`` (more than ``limit``).

    Null reads as empty: no tokens.  Repeated rows stay repeated.
    """
    vocabulary = Vocabulary.load(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer, vocabulary)
        for whole in batches:
            for batch in slices(whole, 2000, 2 << 20):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    picked = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
