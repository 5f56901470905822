from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import brown
from strandline.llm.common import fold as spark_fold
from tests.llm.helpers import documents, fold, rows


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b""]


@pytest.mark.parametrize("head", [60_000, 20, 1])
def test_counts_and_base_score(spark, monkeypatch, head):
    monkeypatch.setattr(brown, "HEAD", head)
    monkeypatch.setattr(brown, "CLUSTERED", min(head, 100))
    data = rows()
    counts = Counter(w for r in data if fold(r[0], 7) != 2 for w in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    docs = documents(spark, data)
    found = brown.language_model(docs, spark_fold(F.col("doc_id"), 7) != 2).collect()
    expected = []
    for r in data:
        mine = tokens(r[1])
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in mine)
        expected.append((r[0], len(mine), sum(counts[w] > 0 for w in mine), total, round(base, 6)))
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert all(r["score"] < 0 for r in found)


@pytest.mark.parametrize(("head", "share"), [(60_000, 1 << 24), (5, 1 << 24), (60_000, 10), (5, 10)])
def test_words_with_a_class_do_not_depend_on_the_size_of_the_input(spark, monkeypatch, head, share):
    monkeypatch.setattr(brown, "HEAD", head)
    # Was the size (in tokens) beyond which more words became rare.
    monkeypatch.setattr(brown, "FREQUENT", share, raising=False)
    counts = [("", 9), *((f"w{i}", 1 + i % 4) for i in range(40)), ("l" * 70, 3), ("m" * 70, 2)]
    known = brown.vocabulary(spark.createDataFrame([(w.encode(), n) for w, n in counts], "word binary, n bigint"))
    classed = [n for w, n in counts if w and n >= brown.LEAST]
    assert sorted(known.mass) == sorted([10.0, *(n + 1.0 for n in classed)])
    rare = [n for w, n in counts if w and n < brown.LEAST]
    assert known.rare == (sum(rare), len(rare))


def test_probabilities_sum_to_one_and_scores_add_up(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 30)
    monkeypatch.setattr(brown, "CLUSTERED", 10)
    monkeypatch.setattr(brown, "CLASSES", 4)
    monkeypatch.setattr(brown, "AT_ONCE", 50)
    data = rows(30)
    texts = [*data, (99, "never seen words", None, None, None)]
    learn = F.expr("doc_id IS DISTINCT FROM 99 AS learn")
    docs = documents(spark, texts).select("doc_id", "text", learn)
    counts = brown.word_counts(docs.filter("learn").select("text"))
    known = brown.vocabulary(counts)
    table = brown.coded(docs, known.codes, known.hashes)
    model = brown.train(table.filter("learn"), known)
    n = {bytes(r["word"]): r["n"] for r in counts.collect()}
    rare = len(model.step) - 1
    coder = brown.Coder(known.codes, known.hashes)
    own = lambda w: model.of[coder[w]] if coder[w] >= 0 else rare
    assert len(known.hashes) > 0
    assert {w for w, c in n.items() if own(w) == rare} == {
        w for w, c in n.items() if c < brown.LEAST and w not in known.codes
    }
    outside = sum(c for w, c in n.items() if own(w) == rare)
    assert model.outside == pytest.approx(outside / sum(n.values()))
    for before in range(rare + 1):
        mass = sum((c + 1) * 10 ** model.step[before, own(w)] for w, c in n.items())
        assert mass + 10 ** model.step[before, rare] == pytest.approx(1)
    found = brown.scored(table, model, counts).collect()
    expected = []
    for r in texts:
        score, before = 0.0, 0
        for w in tokens(r[1]):
            score += math.log10(n.get(w, 0) + 1) + model.step[before, own(w)]
            before = own(w)
        expected.append((r[0], round(float(score), 6)))
    got = [(r["doc_id"], round(r["score"], 6)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_words_are_cut_and_numbered_in_whole_batches():
    odd = [" a\tB\x0bc\x0c\r\nÄ ", "", None, "\u00a0x\u2003y\x1cz \x85 İ", "  ", "B b a", "q" * 70]
    full = [t or "no null" for t in odd]
    cases = [pa.array(x, kind).slice(i) for x in (odd, full) for kind in (pa.string(), pa.large_string()) for i in (0, 1, 4)]
    for texts in cases:
        found, cuts = brown.words(texts)
        got = brown.as_bytes(found).to_pylist()
        expected = [tokens(t)[:-1] for t in texts.to_pylist()]
        assert [got[a:b] for a, b in zip(cuts, cuts[1:])] == expected
    hashes = np.sort(np.array([xxhash.xxh64_intdigest(w, 42) for w in (b"x", b"y")], np.uint64).view(np.int64))
    coder = brown.Coder({b"": 0, b"a": 1}, hashes)
    numbers = coder.numbers([b"y", b"a", b"z", b"x", b""]).tolist()
    assert numbers[1:3] == [1, -1] and numbers[4] == 0 and {numbers[0], numbers[3]} == {2, 3}
    assert brown.Coder({b"": 0}, hashes[:0]).numbers([b"x", b""]).tolist() == [-1, 0]


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(3)
    n = 30  # three kinds of words that follow each other in turn
    pairs = Counter()
    for _ in range(4000):
        a = int(rng.integers(n))
        b = int(rng.integers(n // 3)) * 3 + (a % 3 + 1) % 3
        pairs[a, b] += 1
    bigrams = np.array([(a, b, c) for (a, b), c in pairs.items()])
    of = brown.exchange(bigrams, n, 3)
    for kind in range(3):
        assert len({of[w] for w in range(n) if w % 3 == kind}) == 1
    assert len(set(of)) == 3


def test_words_known_by_hash_are_exchanged(spark, monkeypatch):
    """Two kinds of words in turn: those beyond the head and the first few find theirs."""
    import random

    rng = random.Random(5)
    kinds = [[f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]]
    weights = [1 / (1 + i) for i in range(60)]
    text = lambda: " ".join(rng.choices(kinds[i % 2], weights)[0] for i in range(60))
    texts = documents(spark, [(i, text(), None, None, None) for i in range(300)])
    texts = texts.select("doc_id", "text", F.lit(True).alias("learn"))
    monkeypatch.setattr(brown, "HEAD", 20)
    monkeypatch.setattr(brown, "CLUSTERED", 11)
    monkeypatch.setattr(brown, "CLASSES", 2)
    known = brown.vocabulary(brown.word_counts(texts.select("text")))
    model = brown.train(brown.coded(texts, known.codes, known.hashes), known)
    assert len(known.hashes) == 100
    coder = brown.Coder(known.codes, known.hashes)
    kind = {w: model.of[coder[w.encode()]] for words in kinds for w in words}
    # There are more classes than kinds, but none of both kinds.
    members = [Counter(w[0] for w in kind if kind[w] == c) for c in set(kind.values())]
    assert sum(sum(m.values()) - max(m.values()) for m in members) <= 2


def test_fitting_equals_counting_one_by_one():
    rng = np.random.default_rng(8)
    size = 6
    table = rng.integers(5, 50, (size, size)) + 0.1
    before, after = rng.integers(0, 5, (2, 40, size)).astype(float)
    own = rng.integers(-1, size - 1, 40)
    own[own == 0] = -1
    found = brown.fitting(before, after, table, own)
    for w in range(40):
        fits = []
        for h in range(1, size - 1):
            out, into = table[h].copy(), table[:, h].copy()
            if h == own[w]:
                out, into = out - after[w], into - before[w]
            fits.append(after[w] @ np.log(out / out.sum()) + before[w] @ np.log(into / into.sum()))
        assert found[w] == 1 + int(np.argmax(fits))


def test_classes_beat_single_words(spark):
    import random

    rng = random.Random(4)
    kinds = [[f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]]
    text = lambda: " ".join(rng.choice(kinds[i % 2]) for i in range(60))
    data = [(i, text(), None, None, None) for i in range(300)]
    found = brown.language_model(documents(spark, data), F.col("doc_id") % 7 != 2)
    held = found.filter("doc_id % 7 = 2").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1] + 500


def test_nothing_learned_and_no_rows(spark):
    found = brown.language_model(documents(spark), F.lit(False)).collect()
    assert len(found) == len(rows())
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in found)
    assert all(abs(r["base_score"]) < 1e-9 for r in found)
    assert brown.language_model(documents(spark, []), F.lit(True)).count() == 0
