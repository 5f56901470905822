from __future__ import annotations

import glob
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import components
from strandline.llm import jaccard_join as jj
from strandline.llm.common import TIDY, written
from tests.llm.helpers import bag, documents, rows, same

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(data: list[tuple], shingle: int = jj.SHINGLE, similar: int = jj.SIMILAR) -> list[tuple]:
    sets = []
    for _, text in data:
        words = [w for w in re.split("[ \t-\r]+", (text or "").translate(UPPER)) if w]
        runs = range(max(1, len(words) - shingle + 1))
        sets.append({tuple(words[i : i + shingle]) for i in runs} if words else set())
    up = list(range(len(data)))

    def top(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= similar * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    first: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(data):
        if doc_id is not None:
            first[top(i)] = min(doc_id, first.get(top(i), doc_id))
    return [
        (doc_id, len(s), first.get(top(i)) if s else doc_id)
        for i, ((doc_id, _), s) in enumerate(zip(data, sets))
    ]


def edited(rng: random.Random, words: list[str], n: int) -> str:
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def groups(seed: int) -> list[tuple]:
    """Copies with few and many edits, sets near the least similarity, a passage that many
    texts share, and short texts."""
    rng = random.Random(seed)
    texts = []
    for size in (7, 9, 14, 20, 40, 90, 200):
        base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
        texts += [edited(rng, base, rng.choice([0, 1, 1, 2, 3, size // 25])) for _ in range(40)]
        texts += [" ".join(base[: size - k]) for k in range(0, size // 4)]
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(60):
        texts.append(passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.choice([2, 8, 12, 60]))))
    return list(enumerate(texts))


@pytest.mark.parametrize("frequent", [2, 6, jj.FREQUENT])
def test_components_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(jj, "FREQUENT", frequent)
    data = groups(frequent)
    full = [(i, t, None, None, None) for i, t in data]
    same(bag(jj.jaccard_components(documents(spark, full))), brute(data))


def test_edges(spark):
    data = [(r[0], r[1]) for r in rows()]
    same(bag(jj.jaccard_components(documents(spark))), brute(data))
    assert jj.jaccard_components(documents(spark, [])).count() == 0


def test_a_star_and_a_chain_lose_no_link(spark):
    rng = random.Random(3)
    base = [f"s{i}" for i in range(150)]
    texts = [" ".join(base)] + [edited(rng, base, 2) for _ in range(150)]
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[k : k + 100]) for k in range(0, 300, 6)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    data = list(zip(order, texts))
    full = [(i, t, None, None, None) for i, t in data]
    found = bag(jj.jaccard_components(documents(spark, full)))
    same(found, brute(data))
    assert len({r[2] for r in found}) < len(texts) / 2


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 300), st.integers(0, 40), st.integers(0, 40), st.floats(0, 1))
def test_linked_sets_share_a_signature(seed, common, left, right, share):
    """Whatever tokens are frequent, sets that overlap enough have a signature in common."""
    rng = np.random.default_rng(seed)
    tokens = rng.integers(0, 1 << 63, common + left + right, np.uint64) * np.uint64(2)
    a = np.unique(tokens[: common + left])
    b = np.unique(np.concatenate((tokens[:common], tokens[common + left :])))
    both = len(np.intersect1d(a, b))
    if 100 * both < jj.SIMILAR * (len(a) + len(b) - both) or np.array_equal(a, b):
        return

    def signs(own: np.ndarray, other: np.ndarray) -> set[int]:
        index, low = jj.index_tokens(own)
        have = jj.index_tokens(other)[0]
        place = np.flatnonzero(np.isin(index, have))
        token = index[place]
        frequent = (jj.mixed(token.astype(np.uint64)) % np.uint64(1000)) < np.uint64(1000 * share)
        return set(jj.signatures(len(own), low, place, token, frequent).tolist())

    assert signs(a, b) & signs(b, a)


def test_parts_of_a_group_are_not_joined_pair_by_pair(spark, monkeypatch):
    """Texts of one passage that are linked with about half of each other: few of them with
    one hub, but all with some other one."""
    rng = random.Random(5)
    base = [f"g{i}" for i in range(160)]
    data = [(i, edited(rng, base, rng.choice([2, 3, 3, 4]))) for i in range(300)]
    seen = []
    verified = jj.verified

    def counted(pairs, sets, similar):
        found = verified(pairs, sets, similar)
        seen.append((pairs.count(), found.count()))
        return found

    monkeypatch.setattr(jj, "verified", counted)
    full = [(i, t, None, None, None) for i, t in data]
    same(bag(jj.jaccard_components(documents(spark, full))), brute(data))
    assert sum(pairs for pairs, _ in seen) < 20 * len(data)


def test_sketches_never_say_too_much():
    rng = np.random.default_rng(1)
    for n in (1, 30, 2000):
        x, y = (rng.integers(0, 500, n).astype(np.uint64) for _ in range(2))
        x, y = np.unique(x), np.unique(y)
        bits = sum(int(v).bit_count() for v in (jj.sketch(x) ^ jj.sketch(y)).view(np.uint64))
        assert bits <= len(np.setxor1d(x, y))


def test_stars_are_components_without_a_join(spark, monkeypatch):
    """Rounds that change nothing joined all links of a large group again."""
    monkeypatch.setattr(components, "_hang", None)
    data = [(i, 0) for i in range(1, 50)] + [(60, 70), (70, 60), (80, 80)]
    found = components.components(spark.createDataFrame(data, "a bigint, b bigint"))
    assert bag(found) == bag(spark.createDataFrame([*((i, 0) for i in range(50)), (60, 60), (70, 60)], "node bigint, root bigint"))
    for broken in ([(2, 1), (1, 0)], [(2, 1), (2, 0)]):
        assert not components.stars(spark.createDataFrame(broken, "a bigint, b bigint"))


def test_what_a_table_in_between_shuffled_does_not_stay(spark):
    def left() -> set[str]:
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for d in manager.localDirs() for f in glob.glob(f"{d.getPath()}/**/shuffle_*.data", recursive=True)}

    before = left()
    made = written(spark.range(1000).groupBy("id").count(), "tidy")
    for _ in range(50):
        if not left() - before:
            break
        time.sleep(0.2)
    assert not left() - before
    assert spark.conf.get(TIDY) == "false" and made.count() == 1000
