"""The stages against brute force, each on its own input, and the registered queries."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from strandline.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.helpers import bag, documents, prose, rows
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import brute_fingerprint, brute_groups

duckdb = pytest.importorskip("duckdb")
here = pytest.mark.skipif(not Path(SF_SMALL).is_dir(), reason="the benchmark tables are not here")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with toxic documents, copies, leaks and junk, as tables."""
    rng = random.Random(9)
    docs, labels, toxic = [], [], set()
    for i in range(700):
        lang = rng.choice(["en", "de"])
        words = prose(rng, lang, 70).split()
        if rng.random() < 0.2:
            toxic.add(i)
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkel", "blifftsch"]))
        docs.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, int(i in toxic)))
    docs += [(1000 + i, *docs[i][1:]) for i in range(30)]
    leaks = [d for d in docs[600:640] if d[0] not in toxic][:8]
    items = [(i, " ".join(d[1].split()[4:18])) for i, d in enumerate(leaks)]
    docs += [(5000, None, None, None, None), (5001, "", "en", None, None), (5002, "?? 12", "en", None, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    write = lambda data, schema, name: spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    write(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint", "documents")
    write(labels, "doc_id bigint, toxic int", "labels")
    write(items, "item_id bigint, text string", "benchmark")
    return path, docs, items, toxic


def test_stages_take_effect(spark, folder):
    path, docs, items, toxic = folder
    current = spark.read.parquet(f"{path}/documents.parquet")
    columns = current.columns
    for name, stage in corpus_pipeline.STAGES:
        before = bag(current, "doc_id", "text") if "text" in current.columns else []
        after = corpus_pipeline.written(stage(spark, current, path), name)
        kept = {r[0] for r in bag(after, "doc_id")}
        if name == "toxicity":
            gone = {d for d, _ in before} - kept
            guilty = toxic | {d + 1000 for d in toxic}
            assert len(gone & toxic) > 0.95 * len(toxic) and len(gone - guilty) < 0.01 * len(docs)
        elif name == "language_id":
            assert {d for d, _ in before} - kept == {5000, 5001, 5002}
        elif name == "near_dedup":
            groups = brute_groups(before)
            assert kept == set(groups.values())
            assert all(groups[brute_fingerprint(t)] in kept for _, t in before)
        elif name == "decontamination":
            assert kept == {d for d, _, hits, _ in brute(before, items) if not hits}
        else:
            assert kept == {d for d, _ in before}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        current = after
    assert bag(current) == bag(corpus_pipeline.run(spark, path))


def test_stages_bear_every_edge(spark, folder):
    path = folder[0]
    for name, stage in corpus_pipeline.STAGES:
        docs = documents(spark, rows(40))
        found = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        assert found.count() > 0
        assert stage(spark, documents(spark, []), path).count() == 0


@here
def test_all_are_registered():
    names = [re.match(r"op(\d+)_", q)[1] for q in queries.QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))
    assert queries.QUERIES.keys() | {"pipeline"} <= entry_point.queries().keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "near_dedup", "decontamination", "sentencepiece",
    ]


@here
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_queries_run_over_whole_tables(spark, name):
    found = queries.QUERIES[name](spark, SF_SMALL)
    key = next(c for c in ("page_id", "vec_id", "word", "doc_id") if c in found.columns)
    source = {"page_id": "pages", "vec_id": "embeddings"}.get(key, "documents")
    if key == "word":  # not a row per document
        assert found.count() > 0
    else:
        rows = spark.read.parquet(f"{SF_SMALL}/{source}.parquet")
        distinct = bag(found.select(key).distinct()) if key == "vec_id" else bag(found, key)
        assert distinct == bag(rows, key)
    if name in queries.ORACLE:
        connection = duckdb.connect()
        connection.sql(f"CREATE VIEW {source} AS SELECT * FROM '{SF_SMALL}/{source}.parquet'")
        expected = connection.sql(queries.ORACLE[name])
        columns = expected.columns
        assert sorted(map(str, bag(found, *columns))) == sorted(map(str, expected.fetchall()))
