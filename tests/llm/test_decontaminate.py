from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strandline.llm import decontaminate
from tests.llm.helpers import bag, documents, rows, same

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    out = []
    for doc_id, text in docs:
        mine, hit, found = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            for a in range(max(1, len(w) - window + 1) if w else 0):
                part = w[a : a + window]
                for at in range(len(mine) - len(part) + 1):
                    if mine[at : at + len(part)] == part:
                        hit |= set(range(at, at + len(part)))
                        found.add(str(item))
        out.append((doc_id, len(mine), len(hit), sorted(found)))
    return out


def passages(data: list[tuple]) -> list[tuple]:
    long = [d[1] for d in data if d[1] and len(d[1].split()) > 60]
    cut = lambda t, a, b: " ".join(t.split()[a:b])
    return [
        (1, cut(long[0], 5, 30)), (2, cut(long[1], 0, 10).upper()), (3, cut(long[2], 7, 11)),
        (3, cut(long[3], 20, 33)), (4, None), (5, " ?! "), (6, "words that nobody else has said"),
        (None, cut(long[0], 1, 20)), (7, "word word word"), (10, "word"), (1, cut(long[0], 5, 30)),
    ]


@pytest.mark.parametrize("block", [16 << 20, 200])
def test_contamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    data = rows()
    items = passages(data)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = [
        (r["doc_id"], r["n_words"], sum(s["past"] - s["first"] for s in r["spans"]), r["items"])
        for r in decontaminate.contamination(documents(spark), benchmark).collect()
    ]
    # Items without an id hit words, but are not named.
    named = [(doc, n, hit, [i for i in ids if i != "None"]) for doc, n, hit, ids in brute([r[:2] for r in data], items)]
    same(found, named)


def test_items_without_an_id_are_found(spark):
    docs = documents(spark, [(1, "one two three four", "en", "s", 0), (2, "five", "en", "s", 0)])
    benchmark = spark.createDataFrame([(None, "two three")], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, benchmark).collect()}
    assert [(s["first"], s["past"]) for s in found[1]["spans"]] == [(1, 3)]
    assert found[1]["items"] == [] and found[2]["spans"] == []


def test_spans_are_apart_and_in_order(spark):
    data = rows()
    benchmark = spark.createDataFrame(passages(data), "item_id bigint, text string")
    for r in decontaminate.contamination(documents(spark), benchmark).collect():
        ends = [(s["first"], s["past"]) for s in r["spans"]]
        assert all(a < b for a, b in ends)
        assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("seed", range(30))
def test_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    size = rng.choice([2, 3, 30])
    make = lambda n: [rng.randrange(size) for _ in range(n)]
    docs = [make(rng.choice([0, 1, 6, 50])) for _ in range(6)]
    items = [(str(i), " ".join(f"w{c}" for c in make(rng.choice([1, 3, 9]))).encode()) for i in range(5)]
    phrases = decontaminate.Phrases.of(items, window=4)
    shard = [decontaminate.numbered(" ".join(f"w{c}" for c in d).encode(), phrases.vocabulary) for d in docs]
    found = sorted(
        (int(d), int(f), int(w))
        for a, b, c in decontaminate.occurrences(shard, phrases) for d, f, w in zip(a, b, c)
    )
    expected = []
    for table, first in phrases.by_length:
        for w, phrase in enumerate(table.tolist()):
            for d, codes in enumerate(shard):
                for at in range(len(codes) - len(phrase) + 1):
                    if codes[at : at + len(phrase)].tolist() == phrase:
                        expected.append((d, at, first + w))
    assert found == sorted(expected)


def test_suffix_array_of_repeats():
    codes = np.array([2, 3, 2, 3] * 40 + [1] + [3] * 50 + [0], np.int32)
    order = decontaminate.suffix_array(codes).tolist()
    assert order == sorted(range(len(codes)), key=lambda i: codes[i:].tolist())


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(documents(spark, []), benchmark).count() == 0
    found = decontaminate.contamination(documents(spark), benchmark)
    assert all(n == 0 for (n,) in bag(found.selectExpr("size(spans) + size(items)")))
