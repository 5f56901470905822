"""Exact Jaccard join of word shingles by token combinations in extended prefixes.

Tokens (hashed shingles) have one order for all documents: tokens of few documents
before those of many.  Two sets that overlap enough share at least ``1 + q`` tokens of
their prefixes, if these are ``q`` tokens longer than one shared token would need.  The
tokens of many documents are dealt to ``q`` classes; so a pair shares either a token of
few documents, which alone is a signature, or two tokens of one class, and then the
combination of both is one.  ``q`` grows with the size of the sets, so the number of
combinations stays in proportion to it.  Pairs that share a signature are verified on
whole sets.

To keep the volume down the order looks at a fixed share of the hash range first
(``SHARE``), which holds more tokens than a prefix needs; what a prefix cannot find
there follows in order of the hash.  Only these tokens are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, utf8, written
from strandline.llm.components import components

SHINGLE = 4
#: Least similarity in hundredths.
SIMILAR = 85
#: Tokens in at least so many different sets are frequent.
FREQUENT = 24
#: The share of the hash range that is looked at first.
SHARE = 0.24
#: A class for so many tokens of a set, and one token more in its prefix.
CLASS_OF = 16
#: Tokens of the index keep their highest bits only; they stay in the same order.
KEPT = 48
#: Rounds of further hubs before the remaining pairs are listed, and hubs of a bucket in each.
ROUNDS = 1
HUBS = 8
#: Words of 64 bits in a sketch; least signatures that tell where a pair meets first.
WORDS = 6
LEAST = 4
SEED = 42

_A = np.uint64(0x9E3779B97F4A7C17 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A reversible mixing of 64-bit numbers (xor-shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes, rising, of all runs of ``shingle`` words of a UTF-8 text in lower
    case (A-Z); fewer words are one run; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    each = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    width = min(shingle, len(each))
    n = len(each) - width + 1
    run = np.full(n, width, np.uint64)
    for i in range(width):
        run = mixed(run * _A + each[i : i + n])
    return np.unique(run)


def least_overlap(n: int, similar: int = SIMILAR) -> int:
    """What a set of ``n`` shares at least with one that it is linked to."""
    return -(-similar * n // 100)


def level(n: int) -> int:
    return n.bit_length() - 1


def levels(n: int, similar: int = SIMILAR) -> list[int]:
    """Where sets of ``n`` are compared: the level of the smaller set of a pair."""
    return sorted({level(least_overlap(n, similar)), level(n)})


def classes(at: int) -> int:
    return (1 << at) // CLASS_OF


def prefix(n: int, at: int, similar: int = SIMILAR) -> int:
    return min(n, n - least_overlap(n, similar) + 1 + classes(at))


def index_tokens(tokens: np.ndarray, similar: int = SIMILAR) -> tuple[np.ndarray, int]:
    """The tokens of a set that its prefixes can hold, and how many of them are in the
    share of the range that comes first.  Sets too small to be linked with any other
    than an equal one have none."""
    n = len(tokens)
    if 100 * n < similar * (n + 1):
        return np.zeros(0, np.int64), 0
    top = (tokens >> np.uint64(64 - KEPT)).astype(np.int64)
    low = int(np.searchsorted(top, int(SHARE * (1 << KEPT))))
    return top[: index_size(n, low, similar)], low


def index_size(n: int, low: int, similar: int = SIMILAR) -> int:
    return max(low, *(prefix(n, at, similar) for at in levels(n, similar)))


def signatures(
    n: int, low: int, place: np.ndarray, token: np.ndarray, frequent: np.ndarray,
    similar: int = SIMILAR,
) -> np.ndarray:
    """Signed numbers of a set of ``n``, from those of its index tokens that any other
    set has: ``place`` among all index tokens, and whether ``frequent``.

    The order is: not frequent, then frequent, of the first ``low``; then all others.
    A linked set has all tokens of this one but ``n - least_overlap``; if other sets
    have fewer of its index tokens, it is linked with none and has no signature.
    """
    if len(place) < index_size(n, low, similar) - (n - least_overlap(n, similar)):
        return np.zeros(0, np.int64)
    order = np.argsort(place)
    place, token, frequent = place[order], token[order].astype(np.uint64), frequent[order]
    late = frequent & (place < low)
    before = np.cumsum(late) - late
    turn = np.where(late, low - late.sum() + before, np.where(place < low, place - before, place))
    out = [np.zeros(0, np.uint64)]
    for at in levels(n, similar):
        q = classes(at)
        inside = turn < prefix(n, at, similar)
        alone = inside if q == 0 else inside & ~frequent
        salt = np.uint64(at + 1)
        out.append(mixed(token[alone] * _A + salt))
        if q == 0:
            continue
        many = token[inside & frequent]
        group = mixed(many) % np.uint64(q)
        by_group = np.lexsort((many, group))
        many, group = many[by_group], group[by_group]
        for step in range(1, len(many)):
            pair = np.flatnonzero(group[step:] == group[:-step])
            if not len(pair):
                break
            out.append(mixed(mixed(many[pair] * _A + salt) * _A + many[pair + step]))
    return np.unique(np.concatenate(out)).view(np.int64)


def marked(docs: DataFrame, doc_id: str, text: str, shingle: int, similar: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``same`` (equal for equal sets; null for an empty one),
    ``n`` (size of the set), ``low`` and ``tokens`` (see ``index_tokens``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                sets = [shingle_set(t, shingle) for t in utf8(batch.column(2))]
                index = [index_tokens(s, similar) for s in sets]
                same = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                ends = np.cumsum([0, *(len(t) for t, _ in index)])
                flat = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in index)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(same, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([low for _, low in index], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    ],
                    ["doc_id", "text_hash", "same", "n", "low", "tokens"],
                )

    picked = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run,
        f"doc_id {kind}, text_hash bigint, same binary, n bigint, low bigint, tokens array<bigint>",
    )


def buckets(nodes: DataFrame, similar: int) -> DataFrame:
    """``signature``, ``node``, ``n``, ``sets`` (nodes with the signature) for all signatures
    that more than one node has."""
    tokens = nodes.select("node", F.posexplode("tokens").alias("place", "token"))
    shared = (
        tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
        .select("token", (F.col("sets") >= FREQUENT).alias("frequent"))
    )
    listed = (
        tokens.join(shared, "token")
        .groupBy("node").agg(F.collect_list(F.struct("place", "token", "frequent")).alias("found"))
        .join(nodes.select("node", "n", "low"), "node")
        .select("node", "n", "low", "found.place", "found.token", "found.frequent")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in (3, 4, 5)]
            flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            ends = np.cumsum([0, *lists[0].value_lengths().to_pylist()])
            found = [
                signatures(n, low, *(x[a:b] for x in flat), similar)
                for n, low, a, b in zip(
                    batch.column(1).to_pylist(), batch.column(2).to_pylist(), ends, ends[1:]
                )
            ]
            ends = np.cumsum([0, *map(len, found)])
            flat_out = np.concatenate([np.zeros(0, np.int64), *found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat_out)),
                ],
                ["node", "n", "signatures"],
            )

    signed = written(
        listed.mapInArrow(run, "node bigint, n bigint, signatures array<bigint>")
        .select(F.explode("signatures").alias("signature"), "node", "n"),
        "join-signatures",
    )
    several = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    return written(signed.join(several, "signature"), "join-buckets")


def verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The ``a``, ``b`` of ``pairs`` whose ``sets`` (``node``, ``tokens``) overlap enough."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(side), F.col("tokens").alias(f"tokens_{side}"))
        pairs = pairs.join(own, side)
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    either = F.size("tokens_a") + F.size("tokens_b") - both
    return pairs.filter(100 * both >= similar * either).select("a", "b")


def _fit(similar: int, n: str, m: str):
    """Sizes of two sets that can overlap enough."""
    return (100 * F.col(n) >= similar * F.col(m)) & (100 * F.col(m) >= similar * F.col(n))


def hub_pairs(members: DataFrame, similar: int) -> DataFrame:
    """``a``, ``b``: each member (``signature``, ``node``, ``n``, ``met``) with the hub of
    its bucket, the node that meets others most often in all its buckets."""
    hubs = members.groupBy("signature").agg(F.min(F.struct(-F.col("met"), "node", "n")).alias("hub"))
    return (
        members.join(hubs, "signature")
        .select("node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"))
        .filter((F.col("node") != F.col("hub")) & _fit(similar, "n", "m"))
        .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    )


def further_pairs(pool: DataFrame, similar: int, turn: int) -> DataFrame:
    """``a``, ``b``: each member of ``pool`` (``signature``, ``node``, ``n``, ``met``, ``word``,
    ``root``) with the hubs of its bucket that have another root: up to ``HUBS`` for
    members of about one size.

    Roots are dealt to the hubs by a hash that changes with the ``turn``, and each hub
    meets the members of all other roots, so parts of one group find each other.  Pairs
    that one word of their sketches makes unlikely are left to ``other_pairs``.
    """
    size = F.floor(F.log(F.col("n")) / math.log(100 / similar)) if similar < 100 else F.col("n")
    slot = F.pmod(F.xxhash64("root", F.lit(turn)), F.lit(HUBS))
    best = F.min(F.struct(-F.col("met"), "node", "n", "word", "root"))
    hubs = pool.groupBy("signature", slot.alias("slot"), size.alias("size")).agg(best.alias("hub")).select(
        "signature", F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"),
        F.col("hub.word").alias("hub_word"), F.col("hub.root").alias("hub_root"),
    )
    differ = F.bit_count(F.col("word").bitwiseXOR(F.col("hub_word"))) * (WORDS // 2)
    both = F.col("n") + F.col("m")
    close = (100 + similar) * (both - differ) >= 2 * similar * both
    met = (pool["signature"] == hubs["signature"]) & (F.col("root") != F.col("hub_root"))
    return (
        pool.join(hubs, met & _fit(similar, "n", "m") & close)
        .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    )


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of ``64 * WORDS`` classes of tokens, as signed numbers: two sketches differ
    in no more bits than their sets have tokens of their own."""
    odd = np.bincount((tokens % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def other_pairs(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """``a``, ``b``: all pairs of members of one bucket in different components that may
    overlap enough by their sizes and sketches.

    A pair that meets in several buckets is left to the first of them where this shows
    from the least signatures of both: the first common one is never passed over.
    """
    least = F.slice(F.array_sort(F.collect_list("signature")), 1, LEAST)
    own = members.groupBy("node").agg(least.alias("least")).join(sets.select("node", "sketch"), "node")
    flat = [F.get("least", F.lit(i)).alias(f"l{i}") for i in range(LEAST)]
    flat += [F.get("sketch", F.lit(i)).alias(f"p{i}") for i in range(WORDS)]
    known = members.join(own.select("node", *flat), "node")

    def side(name: str) -> DataFrame:
        return known.select("signature", *[F.col(c).alias(f"{name}_{c}") for c in known.columns if c != "signature"])

    x, y = side("x"), side("y")
    before = F.lit(False)
    for i in range(LEAST):
        mine = F.col(f"x_l{i}")
        same = F.lit(False)
        for j in range(LEAST):
            same = same | (mine == F.col(f"y_l{j}"))
        before = before | ((mine < x["signature"]) & same)
    differ = F.lit(0)
    for i in range(WORDS):
        differ = differ + F.bit_count(F.col(f"x_p{i}").bitwiseXOR(F.col(f"y_p{i}")))
    both = F.col("x_n") + F.col("y_n")
    close = (100 + similar) * (both - differ) >= 2 * similar * both
    return (
        x.join(
            y,
            (x["signature"] == y["signature"]) & (F.col("x_node") > F.col("y_node"))
            & (F.col("x_root") != F.col("y_root")) & _fit(similar, "x_n", "y_n") & close
            & ~F.coalesce(before, F.lit(False)),
        )
        .select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()
    )


def links(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """``a``, ``b``: verified pairs, enough of them to connect all that are linked.

    Every member is verified against one hub of its bucket, then ``ROUNDS`` times against
    some hubs of other roots.  What these connect needs no further look; of all other
    pairs of a bucket, which lie in different components, each one is verified that its
    sketches do not rule out.
    """
    met = members.groupBy("node").agg(F.sum("sets").alias("met"))
    word = sets.select("node", F.get("sketch", F.lit(0)).alias("word"))
    members = members.join(met, "node").join(word, "node").select(
        "signature", "node", "n", "met", "word"
    )
    tried = written(hub_pairs(members, similar), "join-pairs")
    found = written(verified(tried, sets, similar), "join-links")
    for turn in range(ROUNDS):
        pool = apart(members, nearby(found))
        more = further_pairs(pool, similar, turn).join(tried, ["a", "b"], "left_anti")
        more = written(more, "join-pairs")
        found = found.union(written(verified(more, sets, similar), "join-links"))
        tried = tried.union(more)
    roots = components(found)
    members = apart(members.drop("met", "word"), roots)
    rest = other_pairs(members, sets, similar).join(tried, ["a", "b"], "left_anti")
    more = written(verified(written(rest, "join-pairs"), sets, similar), "join-links")
    # The roots connect the same nodes as the links that they come from.
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)


def nearby(found: DataFrame) -> DataFrame:
    """``node``, ``root``: the least node within one link of the least node within one link.
    Nodes of one root are connected; not all that are connected have one root."""
    both = found.union(found.select("b", "a")).union(found.select("b", "b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    further = low.select(F.col("a").alias("low"), F.col("low").alias("root"))
    return low.join(further, "low", "left").select(
        F.col("a").alias("node"), F.coalesce("root", "low").alias("root")
    )


def apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with their ``root``, of the buckets that ``roots`` (``node``, ``root``)
    leave with more than one."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("signature").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    return written(
        placed.join(split.filter("x <> y").select("signature"), "signature"), "join-apart"
    )


def whole_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``node``, ``tokens``, ``sketch``: the whole sets of ``nodes`` (``node``, ``own``), from
    the text of the row that ``own`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500):
                sets = [shingle_set(t, shingle) for t in utf8(batch.column(1))]
                ends = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate([np.zeros(0, np.int64), *(s.view(np.int64) for s in sets)])
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                drawn = pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), made, drawn], ["node", "tokens", "sketch"]
                )

    wanted = nodes.select(
        "node", F.coalesce(F.col("own.doc_id").cast("string"), F.lit("")).alias("at"),
        F.col("own.text_hash").alias("hash"),
    )
    # Repeated rows fall together before they are shuffled; the join then moves no text.
    texts = (
        docs.select(
            F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("at"),
            F.xxhash64(text).alias("hash"), F.col(text).alias("text"),
        )
        .filter("text IS NOT NULL").groupBy("at", "hash").agg(F.first("text").alias("text"))
    )
    picked = texts.join(wanted, ["at", "hash"]).select("node", "text")
    schema = "node bigint, tokens array<bigint>, sketch array<bigint>"
    return written(picked.mapInArrow(run, schema), "join-sets")


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, similar: int = SIMILAR,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row: the smallest doc_id
    reachable over links, itself included.

    Two documents are linked if 100 times the intersection of their sets of word
    shingles is at least ``similar`` times the union.  A null or empty text has no
    shingle, is linked with nothing and is its own component.  Rows without an id take
    part; a component of such rows alone has no id.  An empty table gives no rows.
    """
    rows = written(marked(docs, doc_id, text, shingle, similar), "join-rows")
    own = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"),
    )
    nodes = written(
        rows.filter("same IS NOT NULL").groupBy("same")
        .agg(F.min(own).alias("own"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("tokens").alias("tokens"))
        .select(F.monotonically_increasing_id().alias("node"), "*"),
        "join-nodes",
    )
    members = buckets(nodes, similar)
    met = members.select("node").distinct()
    sets = whole_sets(docs, nodes.select("node", "own").join(met, "node"), doc_id, text, shingle)
    roots = components(links(members, sets, similar))
    placed = nodes.select("same", "own", "node").join(roots, "node", "left").select(
        "same", "own", F.coalesce("root", "node").alias("root")
    )
    firsts = placed.groupBy("root").agg(F.min("own").alias("first"))
    named = placed.join(firsts, "root").select("same", F.col("first.doc_id").alias("component_id"))
    return rows.select("doc_id", "n", "same").join(named, "same", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
