from __future__ import annotations

import random

import numpy as np
import pytest

from strandline.llm import token_counts as tc
from tests.llm.helpers import bag, documents, rows, same

tokenizers = pytest.importorskip("tokenizers")
FILE = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
ALPHABET = "aab  thein g.\n\t\x00é▁ßñ😀漢字'''srvmtdle0123​﻿\u0085 　\x1c!?"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(tc.Vocabulary.load(FILE))


def test_counts_equal_the_library(library, counter):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 2, 5, 20, 200]))) for _ in range(2500)]
    texts += ["a" * 999, "=-" * 800, "'" * 50, " " * 70 + "x", "I'll we've 're's 'rest", "\n\n 's"]
    texts += ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|><|endoftext|> x", "<|endoftext|"]
    expected = [len(x) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts).tolist() == expected


def test_forgotten_states_change_nothing(library):
    small = tc.Counter(tc.Vocabulary.load(FILE))
    small.words.limit = 50
    texts = [r[1] or "" for r in rows()]
    expected = [len(library.encode(t).ids) for t in texts]
    assert [int(small.count([t])[0]) for t in texts] == expected


def test_scan_equals_one_pass():
    after, says = tc.cutter()
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 700):
        classes = rng.integers(0, tc.CLASSES, n).astype(np.uint8)
        first = rng.random(n) < 0.05
        first[0] = True
        expected = np.zeros(n, bool)
        state = tc.START
        for i in range(n):
            c = classes[i] + tc.CLASSES * first[i]
            expected[i] |= bool(says[c, state] & tc.HERE)
            if i:
                expected[i - 1] |= bool(says[c, state] & tc.BEFORE)
            state = after[c, state]
        expected[n - 1] |= bool(says[tc.CLASSES, state] & tc.BEFORE)
        assert (tc.begins(classes, first, after, says) == expected).all()


def test_documents(spark, library):
    expected = []
    for r in rows():
        n = len(library.encode(r[1] or "").ids)
        expected.append((r[0], len((r[1] or "").encode()), n, n > 100))
    same(bag(tc.token_counts(documents(spark), FILE, 100)), expected)
    assert tc.token_counts(documents(spark, []), FILE, 100).count() == 0
