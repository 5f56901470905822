from __future__ import annotations

import random

import numpy as np
import pytest

from strandline.llm import toxicity
from tests.llm.helpers import bag, documents, prose


def brute_segments(scores: list[float]) -> list[tuple[int, int]]:
    """Maximal scoring segments by their definition: the best one, then recursively
    to its left and right."""

    def search(low: int, high: int) -> list[tuple[int, int]]:
        best, at = 0.0, None
        for i in range(low, high):
            for j in range(i + 1, high + 1):
                total = sum(scores[i:j])
                shorter = at is not None and abs(total - best) < 1e-9 and j - i < at[1] - at[0]
                if total > best + 1e-9 or shorter:
                    best, at = total, (i, j)
        if at is None:
            return []
        return [*search(low, at[0]), at, *search(at[1], high)]

    return [(a, b - 1) for a, b in search(0, len(scores))]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_all_maximal_ones(seed):
    rng = random.Random(seed)
    scores = [rng.uniform(-2, 2) for _ in range(rng.choice([0, 1, 5, 18]))]
    found = toxicity.segments(np.array(scores))
    assert [(b, e) for _, b, e in found] == brute_segments(scores)
    for score, begin, end in found:
        assert score == pytest.approx(sum(scores[begin : end + 1]))


def corpus(n: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        lang, toxic = rng.choice(["en", "de"]), rng.random() < 0.2
        words = prose(rng, lang, rng.choice([30, 80])).split()
        if toxic:
            for _ in range(4):
                bad = rng.choice(["zorkel", "Zorkelen", "blifft", "blifftsch"])
                words.insert(rng.randrange(len(words)), bad)
        docs.append((i, " ".join(words), lang, "s", None))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(900)
    docs += [(None, None, None, None, None), (5000, "", None, None, None), docs[0]]
    labels += [(None, 1), (7777, 1), (8, None), labels[3]]
    frame = documents(spark, docs)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(frame, known, known.doc_id % 3 != 1)
    scored = frame.select("doc_id", "text", toxicity.scorer(model)("text").alias("tox")).collect()
    truth = {i: y for i, y in labels[:900]}
    held = [(r["tox"] >= toxicity.TOXIC_AT, truth[r["doc_id"]]) for r in scored if r["doc_id"] in truth and r["doc_id"] % 3 == 1]
    assert np.mean([a == bool(b) for a, b in held]) > 0.97
    assert all(0 <= r["tox"] <= 1 for r in scored)
    assert all(r["tox"] < 0.7 for r in scored if not r["text"])
    found = bag(toxicity.passages(frame, model), "doc_id", "first_word", "last_word")
    words = {d[0]: toxicity.tokens((d[1] or "").encode()) for d in docs}
    hits = [any(b"orkel" in w or b"lifft" in w for w in words[d][a : b + 1]) for d, a, b in found]
    # An E-value says how many passages a document has by chance; twice that is much.
    false = len(hits) - sum(hits)
    assert sum(hits) > 300 and false <= 2 * toxicity.E_VALUE * len(docs)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(documents(spark), none)
    scores = [r[0] for r in documents(spark).select(toxicity.scorer(model)("text")).collect()]
    assert scores and max(scores) < 0.5
    assert toxicity.passages(documents(spark, []), model).count() == 0


def test_texts_that_begin_alike_all_count(spark):
    docs, labels = corpus(900)
    header = "This document is made available under the terms of the licence below. " * 3
    docs = [(i, header + text, *rest) for i, text, *rest in docs]
    frame = documents(spark, docs)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(frame, known)
    scored = dict(bag(frame.select("doc_id", toxicity.scorer(model)("text").alias("tox"))))
    right = [(scored[i] >= toxicity.TOXIC_AT) == bool(y) for i, y in labels]
    assert np.mean(right) > 0.97


def test_copies_of_a_whole_text_count_once(spark):
    texts = ["Über ALLES, ok 12", "Über alles  ok!", "über alles ok", "Über alles"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in frame.select(toxicity.spelled(frame.text)).collect()]
    assert found == [b" ".join(toxicity.tokens(t.encode())).decode() for t in texts]
    assert len(set(found)) == 3
