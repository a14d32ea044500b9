"""Best-fit packing by a configuration linear program.

1. Documents become token pieces: ids of the tokenizer, then the end id; only documents longer than
   ``CAP`` are cut, into pieces of ``CAP`` with the remainder as the first piece.
2. The histogram of piece lengths (at most ``CAP`` numbers, whatever the corpus) defines the
   configuration program: cover every length's count with as few sequences as possible, a
   configuration being a multiset of lengths that fits a sequence. It is solved by multiplicative
   weights: lengths that are covered less get higher prices, a knapsack dynamic program finds the
   configurations of most price, and these are used a share each. Every length is covered at the end,
   and the prices give a lower bound, which tells how far the solution is from the best one.
3. Rounding: configurations are used the whole number of times that the program says and the counts
   allow; what is left of the fractions is packed best fit, longest first, over the histogram.
4. Every piece gets its rank among the pieces of its length (per bucket, plus the bucket's offset),
   and the rank finds its sequence and place in a table of the chosen configurations.

The driver holds the histogram and that table, never pieces. The table has a row per configuration
and slot: its size depends on the number of lengths, not of documents.

Tokens: white-space-free chunks repeat, so a worker remembers the ids of up to ``MEMO`` chunks. A cut
before a space that follows a non-space is always a cut of the tokenizer's own splitting; texts with
another kind of space run are encoded whole. The vocabulary is read from a public ranks file, which
gives the ids of the tokenizer file; texts with the special token's string go to the latter.

Defined results: a null or empty text is one piece, the end id alone; a null id keeps its pieces;
repeated rows are packed each; ties go by id, piece and checksum; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetlake.llm.common import stage

CAP = 1024
END_ID = 2
MEMO = 300_000
#: Of the program: phases, passes a phase and how far a length's coverage may be ahead, tried until the gap is small enough.
TRIES = [(20, 6, 0.15), (10, 8, 0.2), (40, 6, 0.1)]
GAP = 0.01
RATE = 0.1
NEAR = 0.98
UP = 0.25
RANK_BUCKET = 1 << 18


# --- tokens -------------------------------------------------------------------------------------
class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, ranks: str, tokenizer: str, pattern: str):
        import tiktoken

        table = {}
        with open(ranks, "rb") as f:
            for line in f:
                token, rank = line.split()
                table[base64.b64decode(token)] = int(rank)
        self.fast = tiktoken.Encoding("piece", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.tokenizer_file, self.slow = tokenizer, None
        self.memo: dict[str, bytes | None] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if "<|" in text:
            if self.slow is None:
                from tokenizers import Tokenizer
                self.slow = Tokenizer.from_file(self.tokenizer_file)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self.encode(text)
        memo, parts = self.memo, [self.encode(first)]
        try:
            parts += map(memo.__getitem__, rest)
        except KeyError:
            del parts[1:]
            for chunk in rest:
                ids = memo.get(chunk)
                if ids is None:
                    if not chunk or chunk[-1].isspace():
                        return self.encode(text)
                    ids = self.encode(" " + chunk)
                    if len(chunk) <= 32:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[chunk] = ids
                parts.append(ids)
        return b"".join(parts)


_CACHE: dict[tuple, Ids] = {}


def pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece. ``tokenizer`` names a public vocabulary."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        ids_of = _CACHE.get((tokenizer,))
        if ids_of is None:  # one vocabulary and memo for each worker process
            ids_of = _CACHE[(tokenizer,)] = Ids(
                public_tokenizers.path(f"{tokenizer}.tiktoken"), public_tokenizers.path(f"{tokenizer}.json"), public_tokenizers.PATTERN)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                data = (ids_of(text) if text else b"") + end
                n = len(data) // 4
                first = (n - 1) % CAP + 1
                bounds = [0, *range(first, n + 1, CAP)]
                for k in range(len(bounds) - 1):
                    row.append(i)
                    number.append(k)
                    start.append(bounds[k])
                    length.append(bounds[k + 1] - bounds[k])
                    crc.append(zlib.crc32(data[4 * bounds[k]:4 * bounds[k + 1]]))
            yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[row].reset_index(drop=True), "piece": number, "start": start, "length": length, "ids_crc32": crc})

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the program --------------------------------------------------------------------------------
def _knapsack(lengths: np.ndarray, price: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Best price for each room up to ``cap``, and the length to take first (-1: leave a unit empty)."""
    best, take = np.zeros(cap + 1), np.full(cap + 1, -1)
    for room in range(1, cap + 1):
        best[room] = best[room - 1]
        k = np.searchsorted(lengths, room, "right")
        if k:
            value = best[room - lengths[:k]] + price[:k]
            i = int(value.argmax())
            if value[i] > best[room]:
                best[room], take[room] = value[i], i
    return best, take


def _fill(room: int, take: np.ndarray, lengths: np.ndarray, out: Counter) -> None:
    while room > 0:
        i = take[room]
        if i < 0:
            room -= 1
        else:
            out[int(i)] += 1
            room -= int(lengths[i])


class Solution(NamedTuple):
    """Fractional uses of configurations ((place of a length, times), ..), the coverage that they give each length, and a lower bound."""

    uses: dict[tuple, float]
    covered: np.ndarray
    bound: float

    @property
    def gap(self) -> float:
        return sum(self.uses.values()) / self.bound - 1


def solve(count: np.ndarray, lengths: np.ndarray, cap: int, phases: int, passes: int, ahead: float) -> Solution:
    """The covering program by multiplicative weights: every phase covers the next share of each count.

    A length's price is its size, times a weight that grows with the exponential of how far its coverage
    lags behind the phase and falls where it is ahead; beyond ``ahead`` it is 0. A knapsack over the
    prices gives the best configuration, and the best one that holds a length, for all lengths at once;
    those worth nearly the best of all are used until the length has its share. Any prices divided by
    the best configuration's worth are a dual solution: the largest of their values is the bound.
    """
    n = count.astype(float)
    covered = np.zeros(len(lengths))
    uses: dict[tuple, float] = {}
    bound = float((n * lengths).sum() / cap)
    longest_first = np.argsort(-lengths)

    def use(held: Counter, i: int, limit: float) -> bool:
        share = max(goal - covered[i], 0.0) * n[i] / held[i]
        step = min([share, *(max(limit - covered[j], 0.0) * n[j] / a for j, a in held.items() if j != i)])
        if step <= 1e-12:
            return False
        key = tuple(sorted(held.items()))
        uses[key] = uses.get(key, 0.0) + step
        for j, a in held.items():
            covered[j] += a * step / n[j]
        return True

    for phase in range(1, phases + 1):
        goal, limit = phase / phases, min(1.0, phase / phases + ahead)
        for last in [False] * (passes - 1) + [True]:
            price = lengths * np.exp(RATE * np.clip((goal - covered) * phases, -1.0, 1.0))
            price[covered >= limit - 1e-9] = 0.0
            best, take = _knapsack(lengths, price, cap)
            if best[cap] > 0:
                bound = max(bound, float((n * price).sum() / best[cap]))
            value = price + best[cap - lengths]
            for i in longest_first[(covered < goal - 1e-12)[longest_first]].tolist():
                if covered[i] >= goal - 1e-12 or (value[i] < NEAR * best[cap] and not last):
                    continue
                held, room = Counter({i: 1}), cap - int(lengths[i])
                _fill(room, take, lengths, held)
                if use(held, i, limit) or not last:
                    continue
                held = Counter({i: 1})  # what the knapsack took is used up: the longest that are left
                for j in longest_first.tolist():
                    if j != i and lengths[j] <= room and covered[j] < limit - 1e-9:
                        held[j] += 1
                        room -= int(lengths[j])
                use(held, i, limit)
            if (covered >= goal - 1e-9).all():
                break
    goal = 1.0
    for i in np.flatnonzero(covered < 1.0).tolist():  # what no pass could place goes in sequences of its own
        use(Counter({i: int(cap // lengths[i])}), i, 1.0)
    return Solution(uses, covered, bound)


def program(count: np.ndarray, lengths: np.ndarray, cap: int = CAP) -> Solution:
    """The configuration program to a gap of ``GAP`` between its value and the bound, or the best of ``TRIES``."""
    best = None
    for phases, passes, ahead in TRIES:
        found = solve(count, lengths, cap, phases, passes, ahead)
        if best is None or found.gap < best.gap:
            best = found
        if best.gap <= GAP:
            break
    return best


def best_fit(count: dict[int, int], cap: int = CAP) -> list[tuple[tuple, int]]:
    """Best fit, longest first, over a histogram: groups of equal sequences as (lengths, how many)."""
    by_room: dict[int, list[list]] = {}
    done: list[tuple[tuple, int]] = []
    for length in sorted(count, reverse=True):
        left = count[length]
        while left:
            room = min((r for r in by_room if r >= length), default=None)
            if room is None:
                each = cap // length
                full, odd = divmod(left, each)
                for n, k in ((full, each), (1, odd)):
                    if n and k:
                        by_room.setdefault(cap - k * length, []).append([(length,) * k, n])
                left = 0
                continue
            group = by_room[room][-1]
            used = min(left, group[1])
            group[1] -= used
            if not group[1]:
                by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
            by_room.setdefault(room - length, []).append([(*group[0], length), used])
            left -= used
            if 0 in by_room:
                done += [tuple(g) for g in by_room.pop(0)]
    return done + [tuple(g) for groups in by_room.values() for g in groups]


def rounded(solution: Solution, left: dict[int, int], lengths: np.ndarray, cap: int) -> list[tuple[tuple, int]]:
    """Whole uses of the solution's configurations; ``left`` loses what they hold.

    A configuration that fills its sequence is used as often as the solution says, a fraction of
    ``1 - UP`` or more counting as one, but no more than there are pieces: the next one is trimmed by
    what the ones before took. Those used most come first.
    """
    chosen = []
    for c, x in sorted(solution.uses.items(), key=lambda cx: (-cx[1], cx[0])):
        items = [(int(lengths[i]), a) for i, a in c]
        whole = min(int(x + UP), *(left[n] // a for n, a in items))
        if whole and sum(n * a for n, a in items) == cap:
            chosen.append((tuple(sorted((n for n, a in items for _ in range(a)), reverse=True)), whole))
            for n, a in items:
                left[n] -= a * whole
    return chosen


def configurations(histogram: dict[int, int], cap: int = CAP) -> list[tuple[tuple, int]]:
    """Whole numbers of sequences by configuration that hold exactly the pieces of a histogram.

    Pieces that fill a sequence are one each; the program's rounded solution packs most of the others,
    and the rest, which is fractions of configurations, goes best fit.
    """
    left = {n: c for n, c in histogram.items() if 0 < n < cap and c > 0}
    chosen = [((cap,), histogram[cap])] if histogram.get(cap) else []
    if left:
        lengths = np.array(sorted(left))
        chosen += rounded(program(np.array([left[n] for n in lengths]), lengths, cap), left, lengths, cap)
    return chosen + best_fit({n: c for n, c in left.items() if c}, cap)


def _places(chosen: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """For each configuration and slot: the ranks of its length that go there, its first sequence and the offset."""
    rows, used, first = [], Counter(), 0
    for lengths, times in chosen:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], first, offset))
            used[n] += times
            offset += n
        first += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "first": table[:, 2], "offset": table[:, 3]}


# --- Spark --------------------------------------------------------------------------------------
def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with the sequence and the offset that they are packed at."""
    cut = stage(pieces(docs, tokenizer, id_col, text_col), "pack-pieces")
    buckets = max(1, -(-cut.count() // RANK_BUCKET))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = stage(cut.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most CAP rows
    table = _places(configurations(histogram))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("bucket", "length", F.coalesce(before, F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32", "start")) - 1
    ranked = cut.withColumn("local", local).join(offsets, ["bucket", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    key = table["length"] * (1 << 44) + table["rank"]  # ascending

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(key, n * (1 << 44) + r, "right") - 1
        return pd.DataFrame({"sequence_id": table["first"][at] + r - table["rank"][at], "offset": table["offset"][at]})

    found = F.pandas_udf(place, "sequence_id long, offset long")("length", "rank")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", found.alias("at")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
