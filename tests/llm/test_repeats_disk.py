"""op6: how much lies on disk at once, and that passes change nothing of the result."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from assetlake.llm import repeats  # noqa: E402

SIZE = 2000


def shuffled(spark):
    """Bytes of shuffle files on the disk."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for top in dirs for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data"))


def test_surroundings_of_a_pass_are_about_as_large_as_the_text(spark, monkeypatch):
    """Where all text repeats, the surroundings of all anchors are seven times the text."""
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(97, 123, SIZE))) for _ in range(400)]
    rows = [*enumerate(texts), *((i + 1000, "#" + t) for i, t in enumerate(texts))]
    whole = sum(len(t) for _, t in rows)
    written = []

    def stage(df, name, of=repeats.stage):
        before = shuffled(spark)
        out = of(df, name)
        written.append(shuffled(spark) - before)
        return out

    monkeypatch.setattr(repeats, "stage", stage)
    monkeypatch.setattr(repeats, "AT_ONCE", 0, raising=False)  # the passes of a large input
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.spans) for r in repeats.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (len(t), SIZE, f"1:{SIZE + 1}") if i >= 1000 else (len(t), 0, "") for i, t in rows}
    assert max(written) < 4 * whole  # 6.4 times in one pass


@pytest.mark.parametrize("kept,n", [(0, 1), (1, 1), (10 ** 6, 1), (3 * 10 ** 8, 3), (10 ** 9, 8)])
def test_passes_follow_the_share_that_repeats(kept, n):
    assert repeats.passes(10 ** 9, kept) == n
    assert repeats.passes(kept, kept) == (8 if kept * 79 > 1 << 26 else 1)


def test_passes_give_the_same_rows(spark, monkeypatch):
    passage = "The quick brown fox jumps over the lazy dog and runs off into the deep dark wood. "
    long = " ".join(f"w{i * 7919 % 501}" for i in range(3000))
    texts = ["x" * 49, "x" * 120, "y" + passage, passage + "Z" * 60, "é" * 40 + passage[:49], passage * 3, None, "", long, "p" + long[100:9000], "ab" * 100]
    rows = [*enumerate(texts * 2), (0, texts[0]), (1, passage), (None, passage), (None, passage[3:])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: tuple(map(str, r))
    one = sorted(repeats.remove(d).collect(), key=key)
    asked = []
    monkeypatch.setattr(repeats, "passes", lambda sent, kept: asked.append((sent, kept)) or 5)
    assert sorted(repeats.remove(d).collect(), key=key) == one
    (sent, kept), = asked
    assert 0 < kept <= sent


def test_spans_are_joined_by_row():
    row, start, stop = (np.array(x, np.int64) for x in ([7, -3, 7, 7, 7, -3, 9], [0, 5, 10, 8, 30, 5, 4], [10, 6, 20, 9, 40, 9, 4]))
    assert [x.tolist() for x in repeats._joined(row, start, stop)] == [[-3, 7, 7], [5, 0, 30], [9, 20, 40]]
    none = np.zeros(0, np.int64)
    assert [len(x) for x in repeats._joined(none, none, none)] == [0, 0, 0]
