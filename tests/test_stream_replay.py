from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from strandline.streaming import windows as stream_windows
from tests.conftest import rows

START = datetime(2024, 1, 5)


@pytest.mark.parametrize("file_rows", [1_000_000, 40])
def test_replay_loses_nothing_of_many_unsorted_files(spark, tmp_path, monkeypatch, file_rows):
    monkeypatch.setattr(stream_windows, "FILES_AT_ONCE", 1)
    monkeypatch.setattr(stream_windows, "FILE_ROWS", file_rows)
    rng = random.Random(3)
    data = [(i, START + timedelta(minutes=rng.randrange(3000))) for i in range(400)]
    data += [(i, START + timedelta(minutes=700)) for i in range(200)] + [(1, None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "user_id bigint, ts timestamp_ntz").repartition(12)

    def counts(stream):
        return stream_windows.tumbling_counts(stream, "ts", "1 hour")

    found = stream_windows.replay(df, "ts", counts, str(tmp_path / "r"))
    expected = Counter(t.replace(minute=0) for _, t in data if t)
    assert rows(found) == sorted((t, t + timedelta(hours=1), n) for t, n in expected.items())
