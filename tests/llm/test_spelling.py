from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from strandline.llm import spelling
from tests.llm.helpers import bag, documents, rows, same

UPPER = {c: c + 32 for c in range(65, 91)}


def within_one(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def brute(counts: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in counts if within_one(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= spelling.TIMES * counts[w]:
                form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), counts[f] if f else None))
    return out


@pytest.mark.parametrize("part", [spelling.PART, 40])
def test_groups_equal_brute_force(spark, monkeypatch, part):
    # With small parts, paths of last words are shared by many parts.
    monkeypatch.setattr(spelling, "PART", part)
    rng = random.Random(part)
    counts = {}
    for _ in range(300):
        word = "".join(rng.choices("aabé", k=rng.randint(3, 7)))
        counts[word] = rng.choice([5, 6, 30, 31, 200, 1200])
    counts |= {"x" * 900: 7, "x" * 901: 50, "aaaa": 5, "aaaaa": 25, "aaaaaa": 125}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    same(bag(spelling.grouped(words)), brute(counts))


def test_words_of_documents(spark):
    lost = "Zzzzzzz nothing"
    data = [*rows(), *[(9000 + i, lost, None, None, None) for i in range(700)]]
    counts = Counter()
    for r in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % spelling.SLIPS == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert any(len(w) == 6 and w.startswith("zz") for w in counts)
    same(bag(spelling.variants(documents(spark, data))), brute(kept))
    assert spelling.variants(documents(spark, [])).count() == 0


def test_nodes_are_those_of_one_trie(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 12)
    words = ["a", "ab", "abc", "abd", "b", "ba", "bb", "c", "abcd", "abce"]
    df = spark.createDataFrame(list(enumerate(words)), "id bigint, w string")
    found = {r.id: r.nodes for r in spelling.node_paths(df, "w", "id").collect()}
    number = defaultdict(set)
    for i, w in enumerate(words):
        for n, node in enumerate(found[i]):
            number[w[:n]].add(node)
    assert all(len(v) == 1 for v in number.values())
    assert len({min(v) for v in number.values()}) == len(number)
