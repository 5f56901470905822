from __future__ import annotations

import random

import numpy as np

from strandline.llm import language
from tests.llm.helpers import SYLLABLES, documents, prose


def test_tables_equal_the_sliding_filters():
    rng = np.random.default_rng(1)
    net = language.fit(rng.integers(0, 150, (8, language.WINDOW)).astype(np.uint8), np.arange(8) % 2, ["a", "b"])
    net.compiled()
    windows = rng.integers(0, 150, (5, language.WINDOW)).astype(np.uint8)
    embedded = net.embed[windows]
    pooled = []
    for width, kernel in zip(language.WIDTHS, net.filters):
        at = [
            np.einsum("bwe,wef->bf", embedded[:, i : i + width], kernel)
            for i in range(language.WINDOW - width + 1)
        ]
        pooled.append(np.max(at, axis=0))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    expected = language.softmax(hidden @ net.out + net.out_bias)
    assert np.allclose(net.probabilities(windows), expected, atol=1e-4)


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 1000, 5000):
        text = np.arange(n) % 250 + 1
        windows = language.windows_of(text.astype(np.uint8))
        step = language.WINDOW - max(language.WIDTHS) + 1
        seen = np.zeros(n, bool)
        for i, w in enumerate(windows):
            part = text[i * step : i * step + language.WINDOW]
            assert (w[: len(part)] == part).all() and not w[len(part) :].any()
            seen[i * step : i * step + len(part)] = True
        assert seen.all()


def test_held_out_languages(spark):
    rng = random.Random(3)
    data = []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        data.append((i, prose(rng, lang, 40), lang, None, None))
    data += [(9000, None, "en", None, None), (9001, " 12 ?!", "en", None, None), (9002, "", "en", None, None)]
    data += [(9003, "the " * 30000, None, None, None), (None, "x y", None, None, None), data[0], data[0]]
    docs = documents(spark, data)
    network = language.train(docs, docs.doc_id % 4 != 2)
    found = language.identifier(network)(docs.text)
    rows = docs.select("doc_id", "text", found.alias("found")).collect()
    truth = {r[0]: r[2] for r in data[:900]}
    held = [(r["found"]["lang"], truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth and r["doc_id"] % 4 == 2]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert len(rows) == len(data)
    und = {r["doc_id"] for r in rows if r["found"]["lang"] == "und"}
    assert und == {9000, 9001, 9002}
    assert all(0 <= r["found"]["score"] <= 1 for r in rows)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "abc", None, None, None)])
    assert language.train(docs) is None
    found = docs.select(language.identifier(None)(docs.text).alias("found")).first()["found"]
    assert (found["lang"], found["score"]) == ("und", 0.0)
    assert language.train(documents(spark, [])) is None
