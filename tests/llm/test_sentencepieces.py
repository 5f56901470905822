from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import sentencepieces
from tests.llm.helpers import bag, documents, rows, same

tokenizers = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("sentencepiece")
MODEL = tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def theirs():
    return library.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def ours():
    return sentencepieces.Vocabulary.load(MODEL)


ALPHABET = "aab  thein g.\n\t\x00é▁ßñ😀漢字<s>0123​﻿"


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(ALPHABET)) | st.text())
def test_encoding_and_decoding_equal_the_library(theirs, ours, text):
    ids = theirs.encode(text)
    assert ours.encode(text) == ids
    assert ours.decode(ids) == theirs.decode(ids)


def test_long_runs(theirs, ours):
    texts = [" " * k for k in range(40)] + ["a" * 300, "the" * 500, "=-" * 700, " the  " * 200]
    texts += ["x" + " " * k + "y" for k in range(40)]
    for text in texts:
        assert ours.encode(text) == theirs.encode(text)


def test_any_ids_decode(theirs, ours):
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000)]) for _ in range(rng.randrange(12))]
        assert ours.decode(ids) == theirs.decode(ids)


def test_documents(spark, theirs):
    expected = []
    for r in rows():
        ids = theirs.encode(r[1] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(theirs.decode(ids).encode()).hexdigest()
        expected.append((r[0], ids, len(ids), digest, decoded))
    same(bag(sentencepieces.encoded(documents(spark), MODEL)), expected)
    assert sentencepieces.encoded(documents(spark, []), MODEL).count() == 0
