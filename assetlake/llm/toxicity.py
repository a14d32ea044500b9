"""Toxicity by compression distance.

Zstandard dictionaries come from labelled text: one is trained on ordinary text, ``ORDINARY_BYTES``
long; the toxic one holds every marked word, however many there are, the more frequent nearer its end;
the core, ``CORE_BYTES`` long, is trained on the marked words of each toxic document, and so holds the
commonest parts of them. A word is marked if its share of toxic documents is ``TOXIC_RATIO`` times that
of ordinary ones and Fisher's exact test, corrected for the number of words tested, finds it above
chance. A text is cut into windows of about ``WINDOW`` bytes at spaces; each window is compressed after
the ordinary dictionary alone, after the core followed by the ordinary one, and after the toxic one
followed by the ordinary one. What the core and the toxic dictionary save on a window is its evidence:
all compressors know ordinary text equally well, so an ordinary window saves nothing. The savings of a
document's windows (largest, sum, shares above fixed bytes) are calibrated to a probability by a
logistic regression on labelled documents that no dictionary has seen.

Bounded sample (documented parameters): learning uses at most ``SAMPLE`` different toxic and ordinary
labelled (id, text) rows, chosen by hash of both, and the calibration half as many more. Words are
counted, and documents calibrated, on whole texts. The core and the ordinary dictionary are trained on
at most ``SAMPLE_BYTES`` characters of a row in evenly spaced slices; of the 400-byte windows of ordinary
slices every k-th is taken, which leaves ``ORDINARY_WINDOWS`` to twice as many of more. Scoring reads every whole text.

Defined results: a null or empty text gets the score that calibration gives to no evidence at all;
a null id is scored and never learnt from; where labels of an id disagree the larger one counts;
with no toxic or no ordinary labelled row the score is the share of toxic labels (0.0 without
labels); repeated rows stay and score alike; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 128
SAMPLE = {1: 4000, 0: 14000}
SAMPLE_BYTES, ORDINARY_WINDOWS = 8192, 20_000
ORDINARY_BYTES, CORE_BYTES = 100_000, 1024
LEVEL = 6
#: A word goes to the toxic dictionary if its share of toxic documents is so many times that of ordinary ones.
TOXIC_RATIO = 20
#: Chance that any unmarked word is marked (Bonferroni).
ALPHA = 0.01
#: Savings in bytes above which windows are counted.
STEPS = (0, 1, 2, 3, 4, 5, 6)


@dataclass
class Model:
    ordinary: bytes
    core: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def compressors(self):
        return [_compressor(before + self.ordinary) for before in (b"", self.core, self.toxic)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0)
    if not content:
        return zstandard.ZstdCompressor(compression_params=params)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=params)


def windows(text: str, size: int = WINDOW) -> Iterator[bytes]:
    data = text.lower().encode("utf-8", "replace")
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            space = data.find(b" ", end, end + size // 2)
            end = space if space >= 0 else end
        yield data[at:end]
        at = end


def _figures(saved: list[int], size: int) -> list[float]:
    saved.sort(reverse=True)
    n = len(saved)
    return [saved[0], sum(saved) / size, sum(saved[:3]), sum(s for s in saved if s > 1) / size,
            *(sum(s > k for s in saved) / n for k in STEPS)]


def evidence(text: str | None, ordinary, *toxic) -> list[float]:
    saved, size = [[] for _ in toxic], 0
    for w in windows(text or ""):
        alone = len(ordinary.compress(w))
        for own, c in zip(saved, toxic):
            own.append(alone - len(c.compress(w)))
        size += len(w)
    if not size:
        return [0.0] * (len(toxic) * (4 + len(STEPS)) + 1)
    return [x for own in saved for x in _figures(own, size)] + [float(np.log(size))]


def _trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """The content of a trained dictionary; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d, steps=1).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


_EDGE = ".,;:!?\"'()"


def chance(a: int, b: int, toxic: int, ordinary: int) -> float:
    """Probability that of ``a + b`` documents drawn at random ``a`` or more are toxic; for ``a`` above its mean."""
    def ways(n, k):
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    n = a + b
    total = term = exp(ways(toxic, a) + ways(ordinary, b) - ways(toxic + ordinary, n))
    for x in range(a, min(n, toxic)):
        term *= (toxic - x) * (n - x) / ((x + 1) * (ordinary - n + x + 1))
        total += term
        if term < 1e-12 * total:
            break
    return total


def _marked(seen: Counter, usual: Counter, toxic: int, ordinary: int, tested: int) -> list[str]:
    """Words of toxic documents that ordinary ones hardly use, the most frequent last."""
    found = [(n, w) for w, n in seen.items()
             if n / toxic >= TOXIC_RATIO * (usual[w] + 0.5) / ordinary and chance(n, usual[w], toxic, ordinary) * tested <= ALPHA]
    return [w for _, w in sorted(found)]


def _marked_of(texts: DataFrame) -> list[str]:
    """The marked words of whole texts, counted by Spark; texts has toxic (0 or 1) and text."""
    size = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return []
    own = F.transform(F.split(F.lower("text"), r"(?U)\s+"), lambda w: F.btrim(w, F.lit(_EDGE)))
    words = (texts.select("toxic", F.explode(F.array_distinct(own)).alias("w")).where("w <> ''")
             .groupBy("w").agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("usual")).where("n > 0"))
    tested = words.count()
    # fewer documents can't pass the test, even if no ordinary one has the word
    least = next((n for n in range(1, size[1] + 1) if chance(n, 0, size[1], size[0]) * tested <= ALPHA), size[1] + 1)
    ratio = F.col("n") / size[1] >= TOXIC_RATIO * (F.col("usual") + 0.5) / size[0]
    rows = words.where((F.col("n") >= least) & ratio).collect()
    return _marked(Counter({r["w"]: r["n"] for r in rows}), Counter({r["w"]: r["usual"] for r in rows}), size[1], size[0], tested)


def _dictionaries(toxic: list[str], ordinary: list[str], marked: list[str] | None = None) -> tuple[bytes, bytes, bytes]:
    """The ordinary, core and toxic dictionaries; the words of these texts are marked if none are given."""
    def terms(text):
        return [w for w in dict.fromkeys(w.strip(_EDGE) for w in text.lower().split()) if w]

    if marked is None:
        seen, usual = (Counter(w for t in texts for w in terms(t)) for texts in (toxic, ordinary))
        marked = _marked(seen, usual, len(toxic), len(ordinary), len(seen))
    known = set(marked)
    samples = [f" {' '.join(own)} ".encode() for t in toxic if (own := [w for w in terms(t) if w in known])]
    chunks = [w for t in ordinary for w in windows(t, 400)]
    step = max(1, len(chunks) // ORDINARY_WINDOWS)
    return (_trained(ORDINARY_BYTES, chunks[::step], 48, 6), _trained(CORE_BYTES, samples, 16, 6) if samples else b"",
            f" {' '.join(marked)} ".encode() if marked else b"")


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        move = np.linalg.solve(h, z.T @ (weight * (y - p)) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return mean, scale, w


def _evenly(text: Column) -> Column:
    """At most SAMPLE_BYTES characters of a text: eight equal slices spread over the whole of it."""
    part = SAMPLE_BYTES // 8
    step = (F.length(text) - part) / F.lit(7.0)
    slices = [F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(part)) for i in range(8)]
    return F.when(F.length(text) <= SAMPLE_BYTES, text).otherwise(F.concat_ws(" ", *slices))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _chosen(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The sample's rows: toxic, calibrate, doc_id and text, each different (doc_id, text) once."""
    keyed = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    keys = keyed.select("doc_id", "h").distinct().join(known, "doc_id")
    chosen = None
    for label, most in SAMPLE.items():
        for calibrate in (False, True):
            part = (keys.where((F.col("toxic") == label) & (F.col("calibrate") == calibrate))
                    .orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h").limit(most // (2 if calibrate else 1)))
            chosen = part if chosen is None else chosen.unionAll(part)
    # at most 27,000 rows of ids and hashes, about 1 MB, whatever the corpus: collected once, and safe to broadcast
    few = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    return keyed.join(F.broadcast(few), ["doc_id", "h"]).select("toxic", "calibrate", "doc_id", "text").distinct()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows outside fold 0: folds 1 to 3 train the dictionaries, fold 4 calibrates."""
    known = (labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .where((fold(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1))
             .withColumn("calibrate", fold(F.col("doc_id")) == 4))
    share = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    base = share.get(1, 0) / max(1, sum(share.values()))
    rows = _chosen(docs, known)
    empty = Model(b"", b"", b"", np.zeros(0), np.ones(0), np.zeros(0), base)
    texts = {0: {}, 1: {}}
    learnt = rows.where(~F.col("calibrate"))
    for r in (learnt.select("toxic", _evenly(F.col("text")).alias("text"))
              .groupBy("toxic", "text").count().select("toxic", "text").collect()):
        texts[r["toxic"]][r["text"]] = None  # copies count once
    if not texts[0] or not texts[1]:
        return empty
    marked = _marked_of(learnt.select("toxic", "text").distinct())  # copies count once
    model = Model(*_dictionaries(sorted(texts[1]), sorted(texts[0]), marked), np.zeros(0), np.ones(0), np.zeros(0), base)
    held = (rows.where("calibrate").select("toxic", _evidence(model)(F.col("text")).alias("x"))
            .toPandas())  # a bounded number of short vectors
    if held.empty or held.toxic.nunique() < 2:
        return empty
    x, y = np.array(held.x.tolist()), held.toxic.to_numpy(float)
    truth = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    model.mean, model.scale, model.weights = _logistic(x, y, truth)
    return model


def _evidence(model: Model):
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors()
        for texts in batches:
            yield pd.Series([evidence(t, *compressors) for t in texts], dtype=object)

    udf.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(udf, "array<double>")


def score(model: Model, text: Column) -> Column:
    """Calibrated probability that a whole text is toxic."""
    if not len(model.weights):
        return F.lit(float(model.base))
    x = _evidence(model)(F.coalesce(text.cast("string"), F.lit("")))

    # the linear part stays in Spark: the array is bound once by transform over one element
    def calibrated(v):
        z = F.lit(float(model.weights[-1]))
        for i in range(len(model.weights) - 1):
            z = z + float(model.weights[i] / model.scale[i]) * (F.get(v, F.lit(i)) - float(model.mean[i]))
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))

    return F.get(F.transform(F.array(x), calibrated), F.lit(0))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels)
    out = docs.select("doc_id", score(model, F.col("text")).alias("score"))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
