"""Hard negatives, importance resampling and record shards against brute force, and on awkward rows."""

import hashlib
import math
import os
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from assetlake.llm import hard_negatives, records, resampling  # noqa: E402

DOCS = "doc_id long, text string, lang string, row long, shard long, place long, l string, h1 long"
LONG = " ".join(f"w{i * 7919 % 501}" for i in range(9000))
TEXTS = ["one two three\nfour\n\nfive six seven\n", None, "", "   \n\t\n", "Zürich ÄÖ 9-9 naïve\nZürich ÄÖ 9-9 naïve", LONG, LONG, "x" * 700 + " y\n" + "z" * 300,
         "<|startoftext|>hello <|endoftext|> it's 2024!! don't", "a\n" * 60, "ΣΑΣ ﬁn é ́x \x85y z q", " ".join("Abc dEf" for _ in range(15)),
         "the same line here\n" * 9, "tab\tnew\r\nline"]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en" if i % 3 else None, 1, 2, 3, "x", 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[5:6] + [(None, "null id text " * 9, None, 1, 2, 3, "x", 4), (-7, "negative id " * 12, "de", 1, 2, 3, "x", 4)], DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


# --- hard negatives -----------------------------------------------------------------------------
def mined_by_force(rows):
    own = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) > 7e305 for x in v):
            continue
        own.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, label, v in sorted(set(r for r in own if r[0] % 100 == 0)):
        score = lambda r: sum(x * y for x, y in zip(v, r[2]))
        others = sorted((-score(r), r[0], r[1]) for r in own if r[0] != i and len(r[2]) == len(v) and abs(score(r)) < 1 << 63)
        for s, p, _ in [r for r in others if r[2] == label][:5]:
            inside = [r for r in others if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s]
            out += [(i, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(inside[:10])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, id long, score long, key string"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], VECTORS).repartition(parts)


def test_hard_negatives_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, (base * 0.5 + rng.normal(size=8)).tolist(), int(rng.integers(0, 3))) for i in range(0, 900, 2)]
    rows += [(i, [0.25] * 8, i % 3) for i in range(901, 1100, 2)]  # a common vector
    rows += [(1200, [0.25] * 8, 1), (1300, [0.0] * 8, 1), (1400, [-0.5] * 8, 2), (1500, [0.5, 0.5], 1), (1501, [0.5, 0.5], 1), (1502, [0.5, 0.25], 2),
             (None, [1.0] * 8, 1), (1600, None, 1), (1700, [1.0] * 8, None), (1800, [float("nan")] * 8, 1), (1900, [1.0, None] + [0.0] * 6, 1),
             (2000, [float("inf")] * 8, 1), (2100, [], 1), (2101, [], 1), (2102, [], 2), (-100, [0.25] * 8, 0), (-93, [0.3] * 8, 2)]
    rows += rows[60:70] + rows[:1]
    got = sorted(map(tuple, hard_negatives.mine(vectors(spark, rows)).collect()))
    assert got == mined_by_force(rows) and len({r[0] for r in got}) > 5
    assert any(r[4] == 0 for r in got)  # a positive score of zero has the zero scores


def test_hard_negatives_in_waves_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "WAVE_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "TILE", (1, 7))
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(0, 2))) for i in range(0, 500, 4)]
    assert sorted(map(tuple, hard_negatives.mine(vectors(spark, rows)).collect())) == mined_by_force(rows)


def test_hard_negatives_of_huge_components_are_exact(spark):
    rows = [(100, [3e7, 1.0, 0.5], 1), (101, [3e7, 1.0, 2.0], 1), (102, [3e7, 0.5, 1.0], 1), (103, [2e7, 5.0, 1.0], 2), (104, [2e7, 5.0, 1.01], 2),
            (105, [1e300, 0.0, 0.0], 2), (200, [1e305, 1.0, 1.0], 1)]
    assert sorted(map(tuple, hard_negatives.mine(vectors(spark, rows)).collect())) == mined_by_force(rows)


def test_hard_negatives_of_no_rows(spark):
    assert hard_negatives.mine(empty(spark, VECTORS)).count() == 0
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0
    assert hard_negatives.mine(vectors(spark, [(100, [1.0], 1), (2, [1.0], 2)])).count() == 0


# --- resampling ---------------------------------------------------------------------------------
def features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)], len(w)


def resampled_by_force(rows, targets, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    corpus, target = Counter(), Counter()
    for _, t in rows:
        corpus.update(map(bucket, features(t)[0]))
    for t in targets:
        target.update(map(bucket, features(t)[0]))
    s_all, t_all = sum(corpus.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for i, t in rows:
        f, n = features(t)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, [x if x is not None else 0 for x in r]))


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_matches_brute_force(spark, monkeypatch, percent):
    if percent == 60:
        monkeypatch.setattr(resampling, "HOT", 20)  # more lines count as common
    d = docs(spark, TEXTS + [f"filler line {i % 5}\nwords number {i} and more of them to reach twenty words in all a b c d e f g\nthe same line here" for i in range(60)])
    target = spark.createDataFrame([("The same line here five six",), (None,), ("naïve words\nof filler",)], "text string")
    got = resampling.resample(d, target, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert by_id(got.collect()) == by_id(resampled_by_force(rows, [r.text for r in target.collect()], percent))


def test_resampling_of_nothing(spark):
    d = docs(spark)
    assert resampling.resample(empty(spark), d).count() == 0
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert by_id(resampling.resample(d, empty(spark)).collect()) == by_id(resampled_by_force(rows, []))


def test_sums_of_runs_match_zlib():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab \n-Zé9\t"), rng.integers(0, 300))) for _ in range(120)] + ["w" * 256 + " " + "k" * 257 + "\n" + "z" * 2000 + " end"]
    lines = [t.split("\n") for t in texts]
    for t, own, (n, crossing) in zip(texts, lines, resampling.crossing_buckets([t.encode() for t in texts])):
        want, words = features(t)
        got = np.concatenate([*resampling.line_buckets([x.encode() for x in own]), crossing])
        assert sorted(got.tolist()) == sorted(zlib.crc32(x.encode()) % 10000 for x in want) and n == words
        assert (resampling._unpacked(resampling._packed(crossing)) == crossing).all()


# --- records ------------------------------------------------------------------------------------
def encoded_by_force(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [(i, np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")) for i, x in rows]


def test_records_round_trip(spark, tmp):
    rng = np.random.default_rng(4)
    alphabet = list("aZ 'é́Σẞİ  \x1c\x85\t\n\r9!<|>中\U0001f600")
    d = docs(spark, TEXTS + ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(300)])
    rows = [(r.doc_id, r.text) for r in d.collect()]
    want = sorted((i is not None, i or 0, len(x), zlib.crc32(x.tobytes())) for i, x in encoded_by_force(rows))
    got = sorted(records.encode(d).collect(), key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got] == [x[:3] for x in want]
    assert sorted(r.ids_crc32 for r in got) == sorted(x[3] for x in want)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert records.encode(empty(spark)).count() == 0


def test_workers_that_write_records_load_no_pandas():
    """In a process of its own, as a worker is one."""
    code = """
import sys, pyarrow as pa
from assetlake.llm import records
batch = pa.RecordBatch.from_arrays([records._longs([1, None, -5]), pa.Array.from_buffers(pa.string(), 3, records._binaries([b"a text, or two.", b"", b"x" * 9]).buffers())], names=["doc_id", "text"])
frames = [f for b in records._framed("word_bpe_49k")(iter([batch])) for f in b.column(0).to_pylist()]
shard = pa.RecordBatch.from_arrays([records._longs([0]), pa.Array.from_buffers(pa.string(), 1, records._binaries([b"p"]).buffers()), records._binaries([b"".join(f + bytes([10]) for f in frames)])], names=["shard", "path", "content"])
assert [b.column("doc_id").to_pylist() for b in records._walk(iter([shard]))] == [[1, None, -5]]
assert "pandas" not in sys.modules
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_chunks_met_again_are_kept(monkeypatch):
    import public_tokenizers
    encoder = records._Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(records, "MEMO", 50)
    learned, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.extend(new), learn(new)))
    texts = [" ".join(["often", "seen", *(f"w{i}x{k}" for k in range(40))]) for i in range(20)]
    got = [encoder([t])[0] for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [x[:-1].tolist() for _, x in encoded_by_force(list(enumerate(texts)))]
    assert learned.count(b"often") == 1 and len(encoder.memo) + len(encoder.older) < 200


def test_remembered_chunks_take_little_memory():
    import tracemalloc

    import public_tokenizers
    encoder = records._Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"{chr(97 + k % 26)}x{k}" for k in range(s, s + 5000)) for s in range(0, 100_000, 5000)]
    encoder(texts[:1])
    tracemalloc.start()
    got = encoder(texts)
    del got
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(encoder.memo) == 100_000 and held < 64 * 100_000


@pytest.mark.parametrize("hashes", [1, 3, 1 << 20])
def test_chunks_of_one_hash_are_told_apart(monkeypatch, hashes):
    import public_tokenizers
    encoder = records._Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(records, "mixed", lambda x: x % np.uint64(hashes))
    monkeypatch.setattr(records, "MEMO", 30)
    monkeypatch.setattr(records, "LONG_MEMO", 2)
    rng = np.random.default_rng(6)
    words = ["a", "a\0", "\0", "it's", "eightbyt", "eightbytes", "eightbyt\0", "sixteen-bytes-ok", "more than", "Zürich,", "x" * 17, "x" * 16 + "y", "Donaudampfschifffahrt", "9%", "中文", "ﬁn"] + [f"w{k}" for k in range(30)]
    texts = ["", " \n", "a", "a"] + [" ".join(rng.choice(words, 25)) for _ in range(60)]
    got = [x for s in range(0, len(texts), 9) for x in encoder(texts[s:s + 9])]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [x[:-1].tolist() for _, x in encoded_by_force(list(enumerate(texts)))]
    assert len(encoder.long) + len(encoder.long_older) < 8


def test_records_are_read_in_any_order(spark, tmp, monkeypatch):
    monkeypatch.setattr(records, "SHARD_BYTES", 4000)
    path = os.path.join(tmp, "shards")
    records.write(docs(spark), path)
    index = records.build_index(spark, path)
    assert index.select("shard").distinct().count() > 3
    want = {}
    for i, x in encoded_by_force([(r.doc_id, r.text) for r in docs(spark).collect()]):
        want.setdefault(i, x.tolist())
    got = records.read_at(spark, path, index.where("doc_id % 2 = 1").select("shard", "offset", "doc_id")).collect()
    assert {r.doc_id: r.ids for r in got} == {i: x for i, x in want.items() if i is not None and math.fmod(i, 2) == 1}
    one, two, other = (records.read_shuffled(spark, path, index, seed).collect() for seed in (7, 7, 8))
    assert one == two and [r.doc_id for r in one] != [r.doc_id for r in other]
    assert [r.draw for r in one] == sorted(r.draw for r in one) and all(r.ids == want[r.doc_id] for r in one) and len(one) == len(want) + 1


def test_damaged_records_are_refused():
    payload = records.payload_of(3, np.array([1, 2, 700], "<u2").tobytes(), 2)
    good = records.frame(payload) + b"\n"
    assert records.record_at(good, 0) == (payload, len(good))
    i, ids = records.document_of(payload)
    assert i == 3 and ids.tolist() == [1, 2, 700]
    for k in range(len(good)):
        bad = bytearray(good)
        bad[k] ^= 4
        with pytest.raises(ValueError):
            records.record_at(bytes(bad), 0)
        with pytest.raises(ValueError):
            records.record_at(good[:k], 0)
