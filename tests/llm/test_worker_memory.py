"""What near duplicates' Python workers hold, and keep between steps."""

import subprocess
import sys

import numpy as np
import pyarrow as pa

from assetlake.llm import common, ngram_join
from conftest import ROOT

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_packing_does_not_hang_on_batches():
    rng = np.random.default_rng(4)
    rows = [" ".join(f"v{x}" for x in rng.integers(0, 900, 200)) for _ in range(300)]
    rows = rows + [r + " w" for r in rows[:60]] + rows[:30] + [None, ""]
    whole = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    want, got = ([out.to_pylist() for out in ngram_join._packer(5, 80, 20)(iter([whole.slice(at, size) for at in range(0, len(rows), size)]))]
                 for size in (len(rows), 13))
    assert want and got == want


def test_nodes_are_remembered_or_packed_again(monkeypatch):
    rows = [" ".join(f"{k}v{x}" for x in range(30)) for k in range(40)] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])

    def packed():
        got = set()
        for out in ngram_join._packer(5, 80, 3)(iter([batch])):
            for keys, nodes in zip(out.column("keys").to_pylist(), out.column("nodes").to_pylist()):
                got |= set(zip(np.frombuffer(keys, np.uint64).tolist(), np.frombuffer(nodes, np.int64).tolist()))
        return got

    want = packed()
    monkeypatch.setattr(ngram_join, "KNOWN", 3)
    assert want and packed() == want


def test_workers_keep_little_after_a_step(tmp_path):
    """The packer over 40 MB of texts read as workers read them: what its process has more after it than before."""
    code = """
import re, sys
sys.path.insert(0, sys.argv[1])
import numpy as np, pandas, pyarrow as pa
from assetlake.llm import ngram_join
def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
before = held()
n = 0
for out in ngram_join._eased(ngram_join._packer(5, 80, 70))(iter(pa.ipc.open_stream(open(sys.argv[2], "rb")))):
    n += out.num_rows
    del out
print(n, held() - before)
"""
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, x)) for x in rng.integers(0, 99999, (10_000, 350))]
    with pa.ipc.new_stream(str(tmp_path / "texts"), pa.schema([("text", pa.string())])) as sink:
        for _ in range(2):
            sink.write_batch(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    out = subprocess.run([sys.executable, "-c", code, ROOT, str(tmp_path / "texts")], capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) and float(out[1]) < 16


def test_batches_of_texts_are_bounded_by_bytes(spark, monkeypatch):
    docs = spark.range(300).repartition(1).selectExpr("id AS doc_id", "repeat('abcde ', 17000) AS text")  # 100 kB a row

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "n"])

    monkeypatch.setattr(ngram_join, "_links", lambda d, n, percent: d.mapInArrow(sizes, "size long, n long").collect())
    assert spark.conf.get(KEY, None) is None
    got = ngram_join.links(docs, 5, 80)
    assert sum(r.n for r in got) == 300 and max(r.size for r in got) <= ngram_join.BATCH + 200_000
    assert spark.conf.get(KEY, None) is None  # the session's again
    spark.conf.set(KEY, "9000000")
    try:
        with common.small_batches(spark, 1 << 20):
            assert spark.conf.get(KEY) == "9000000"
    finally:
        spark.conf.unset(KEY)
