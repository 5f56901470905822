from __future__ import annotations

import re

import pytest
import xxhash

from strandline.llm import simhash
from strandline.llm.components import components
from tests.llm.helpers import bag, documents, rows, same


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(data: list[tuple]) -> dict[int, int | None]:
    """The smallest id of each fingerprint's component, by comparing all pairs."""
    prints = sorted({brute_fingerprint(r[1]) for r in data})
    root = {p: p for p in prints}

    def find(p: int) -> int:
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    ids: dict[int, list[int]] = {}
    for r in data:
        mine = ids.setdefault(find(brute_fingerprint(r[1])), [])
        if r[0] is not None:
            mine.append(r[0])
    return {p: min(ids[find(p)], default=None) for p in prints}


def test_near_duplicates_equal_brute_force(spark):
    data = rows()
    groups = brute_groups(data)
    expected = [
        (r[0], f"{brute_fingerprint(r[1]):016x}", groups[brute_fingerprint(r[1])]) for r in data
    ]
    same(bag(simhash.near_duplicates(documents(spark))), expected)


def test_one_of_each_keeps_rows_whole(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    data = rows()
    groups = brute_groups(data)
    found = [r["doc_id"] for r in kept.collect()]
    same([(i,) for i in found], [(i,) for i in set(groups.values())])


def test_links_at_exactly_two_bits(spark):
    base = 0x1234567812345678
    far = base ^ 0b111
    prints = [base, base ^ 1, base ^ (1 << 63) ^ 2, far ^ (1 << 40), -5]
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = {frozenset(r) for r in bag(simhash.links(spark.createDataFrame(signed, "bits bigint")))}
    reached = components(simhash.links(spark.createDataFrame(signed, "bits bigint")))
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in map(tuple, found))
    assert reached.filter("node = root").count() == 1
    assert reached.count() == 3


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    found = dict(bag(components(spark.createDataFrame(path + star + star, "a bigint, b bigint"))))
    assert found == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1060)}


@pytest.mark.parametrize("operator", [simhash.near_duplicates, simhash.one_of_each])
def test_no_rows(spark, operator):
    assert operator(documents(spark, [])).count() == 0
