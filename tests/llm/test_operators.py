"""Each operator against a brute-force version, and on awkward rows."""

import hashlib
import itertools
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from assetlake.llm import (embedding_dups, fixity, licenses, mixing, ngram_join, packing, pii, quality,  # noqa: E402
                           repeats, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, row long, stratum string"
LONG = " ".join(f"w{i * 7919 % 501}" for i in range(9000))


def docs(spark, texts):
    rows = [(i, t, None if i % 5 == 4 else "en", None if i % 7 == 6 else f"s{i % 3}", len(t or ""), 1, 2, 3, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:1] + [(None, "null id text of some words", None, None, 1, 1, 2, 3, "x")], DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]


BASE = " ".join(f"word{i}" for i in range(300))
TEXTS = [BASE, None, "", "   \n\t", "one", "one two", "one two", BASE, BASE.replace("word150", "changed"), BASE.upper(), LONG,
         "a b c d e f g " * 30, "same line here\nsame line here\nother # line $", "tab\tand\x0bvertical " * 4]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_matches_brute_force(spark, n, percent):
    rng = np.random.default_rng(n)
    texts = list(TEXTS)
    for size in (12, 40, 200):
        words = [f"v{x}" for x in rng.integers(0, 5000, size)]
        for _ in range(12):
            w = list(words)
            for i in rng.integers(0, size, rng.integers(0, max(2, size // 25))):
                w[i] = f"z{rng.integers(0, 9999)}"
            texts.append(" ".join(w))
    d = docs(spark, texts)
    rows = [(r.doc_id, r.text) for r in d.collect()]

    def shingles(t):
        w = split(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [x for (x, _), g in zip(rows, group) if g == group[k] and x is not None]
        want.append((i, len(sets[k]), min(ids) if ids else None))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, ngram_join.join(d, n, percent).collect()), key=key) == sorted(want, key=key)
    kept = ngram_join.first_of_each(d, n, percent)
    assert kept.columns == d.columns
    groups = {g for g, s in zip(group, sets) if s}
    assert kept.count() == len(groups) + sum(not s for s in sets)
    assert ngram_join.join(empty(spark), n, percent).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_as_many_keys_as_needed(percent):
    rng = np.random.default_rng(1)
    table = ngram_join.bands(percent)
    seen = 0
    for size in (2, 4, 5, 8, 9, 10, 13, 14, 20, 25, 60, 200, 700):
        for _ in range(150):
            a = rng.integers(0, 1 << 62, size, dtype=np.uint64)
            most = (100 - percent) * 2 * size // (100 + percent)
            swapped = int(rng.integers(0, most // 2 + 1))
            b = np.concatenate([a[swapped:], rng.integers(0, 1 << 62, rng.integers(0, most - swapped + 1), dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < percent * (len(a) + len(b) - both):
                continue
            shared = []
            for layout in set(ngram_join.layouts(len(a), percent, table)) & set(ngram_join.layouts(len(b), percent, table)):
                blocks = table[layout][1]
                keys = [{int(k) for k in ngram_join.keys_of(np.unique(x), layout, blocks)} for x in (a, b)]
                common = len(keys[0] & keys[1])
                shared.append(common >= max(ngram_join.least_shared(np.unique(x), layout, blocks) for x in (a, b)))
            seen += bool(shared)
            # the layout of the larger set's band is one of them
            assert any(shared) or (not shared and set(a.tolist()) == set(b.tolist()))
    assert seen > 500


def test_repeats_match_brute_force(spark):
    passage = "The quick brown fox jumps over the lazy dog and runs off into the deep dark wood. "
    texts = ["x" * 49, "x" * 120, "y" + passage, passage + "Z" * 60, "é" * 40 + passage[:49], passage * 3, None, "", LONG, "p" + LONG[100:30000], "ab" * 100]
    d = docs(spark, texts)
    rows = [(r.doc_id, (r.text or "").encode()) for r in d.collect()]
    last = 1 << 62
    first = {}
    for i, b in sorted(rows, key=lambda r: last if r[0] is None else r[0]):
        for s in range(len(b) - 49):
            first.setdefault(b[s:s + 50], last if i is None else i)
    want = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s:s + 50]] < (last if i is None else i):
                gone[s:s + 50] = b"\1" * 50
        want.append((i, len(b), sum(gone), sum(bool(x) for x in bytes(gone).split(b"\0")), hashlib.sha256(bytes(v for v, g in zip(b, gone) if not g)).hexdigest()))
    got = [tuple(r)[:5] for r in repeats.remove(d).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert repeats.remove(empty(spark)).count() == 0


def test_intervals_of_a_suffix_array():
    s = b"banana"
    order = sorted(range(6), key=lambda i: s[i:])
    common = [0] + [next((k for k in range(7) if s[a + k:a + k + 1] != s[b + k:b + k + 1] or not s[a + k:a + k + 1]), 0) for a, b in zip(order, order[1:])]
    assert repeats.intervals(common, 1) == [(3, 1, 2), (1, 0, 2), (2, 4, 5)]


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))
    x = np.concatenate([x, x[:20] + 0.08 * rng.normal(size=(20, 8)), x[:3], 2 * x[:3]])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(200, None, 1), (201, [], 1), (202, [0.0] * 8, 1), (203, [float("nan")] * 8, 1), (204, [1.0, None] + [0.0] * 6, 1), (205, [1.0, 2.0], 1), (205, [1.0, 2.0], 1)]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, node int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dups.near_duplicates(d).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = list(range(len(x)))
    for i, j in zip(*np.nonzero(near)):
        a, b = sorted((comp[i], comp[j]))
        comp = [a if c == b else c for c in comp]
    for i in range(len(x)):
        assert got[i] == (near[i].sum(), comp[i], comp[i] == i)
    assert all(got[i] == (0, i, True) for i in range(200, 205)) and got[205] == (1, 205, True)
    assert embedding_dups.near_duplicates(empty(spark, "vec_id long, embedding array<float>")).count() == 0


def test_kd_leaves_meet_all_near_pairs():
    rng = np.random.default_rng(4)
    x = embedding_dups._unit(rng.normal(size=(400, 6)) * [3, 1, 1, 1, 1, 1])
    tree = embedding_dups._tree(x, 8)
    rows, leaf, home = embedding_dups._visits(tree, x, 0.4)
    at = {int(r): int(f) for r, f, h in zip(rows, leaf, home) if h}
    there = set(zip(rows.tolist(), leaf.tolist()))
    for i, j in itertools.combinations(range(400), 2):
        if np.linalg.norm(x[i] - x[j]) <= 0.4:
            assert (i, at[j]) in there or (j, at[i]) in there


def test_personal_data():
    assert pii.detect("a@b.c_d@e.f 256.1.1.1 1.2.3.4.5") == [(0, 5, 0), (5, 11, 0), (22, 29, 1)]
    for text, span in (("mail jo (at) ex [dot] com now", "jo (at) ex [dot] com"), ("ｊｏ＠ｅｘ.ｃｏｍ", "ｊｏ＠ｅｘ.ｃｏｍ"), ("jo​hn@ex.com", "jo​hn@ex.com"),
                       ("plus one five five five zero one two three four five six", "plus one five five five zero one two three four five six")):
        base, every = pii.spans_of(text)
        assert span in [text[s:e] for s, e, _ in every] and set(base) <= set(every)
    for clean in ("look at this. Dot com boom", "one or two of three", "un deux", "", "we met at noon at home"):
        assert pii.spans_of(clean) == ([], [])
    assert pii.masked("x a@b.co y") == "x [EMAIL] y"


def test_personal_data_frame(spark):
    got = {r.doc_id: r for r in pii.find(docs(spark, TEXTS + ["a@b.co +1 (988) 555-2485 x 4944339490429605 y 1.2.3.4", "@" * 5000 + "1" * 50_000])).collect()}
    r = got[len(TEXTS)]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() and got[1].spans == ""


def test_quality_figures_match_brute_force(spark):
    got = {r.doc_id: r for r in quality.judge(docs(spark, TEXTS), spark.createDataFrame([(0, 1, None), (0, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")).collect()}
    for i, t in enumerate(TEXTS):
        w = split(t)
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)} if len(w) < 2000 else None
        lines = [x for x in (t or "").split("\n") if split(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        if covered is not None:
            assert r.n_repeat_words == len(covered) and r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert quality.figures(empty(spark)).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb
    cases = [(n, k, sum(comb(n, j) * 0.02 ** j * 0.98 ** (n - j) for j in range(k + 1))) for n in (10, 200, 900) for k in (0, 1, 3, 9) if k < 0.02 * n]
    d = spark.createDataFrame(cases, "n long, k long, p double")
    from pyspark.sql import functions as F
    for r in d.withColumn("x", quality.binomial_tail(F.col("n"), F.col("k"), 0.02)).collect():
        assert r.x == pytest.approx(r.p, rel=1e-7) and r.x >= r.p


def test_mixing(spark):
    d = docs(spark, [f"{w} " * (5 + i % 40) for i, w in enumerate(["alpha", "beta", "gamma"] * 60)] + TEXTS)
    rows = mixing.mix(d).collect()
    assert len(rows) == d.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        s = by.setdefault(r.source, [r.source_size, r.target, 0])
        s[2] += r.taken
    assert sum(t for _, t, _ in by.values()) == pytest.approx(sum(s for s, _, _ in by.values()))
    for size, target, taken in by.values():
        assert target <= 3 * size and abs(taken - target) <= 2 * mixing.BLOCK
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(d).collect()))
    texts = mixing.mixed_texts(d)
    assert texts.columns == d.columns
    assert sum(len(split(r.text)) for r in texts.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(empty(spark)).count() == 0


def test_sainte_lague_matches_highest_quotients(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    claims = [("g", f"k{i:02}", float(c)) for i, c in enumerate(rng.integers(1, 10_000, 30))]
    got = {r.k: r.seats for r in mixing.sainte_lague(spark.createDataFrame(claims, "g string, k string, c double"), ["g"], ["k"], "c", F.lit(101), "seats").collect()}
    want = {k: 0 for _, k, _ in claims}
    for _ in range(101):
        k = max(claims, key=lambda x: x[2] / (2 * want[x[1]] + 1))[1]
        want[k] += 1
    assert got == want


def test_packing(spark):
    from tokenizers import Tokenizer
    import public_tokenizers
    import zlib
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    d = docs(spark, TEXTS + ["two  spaces \n x <|endoftext|> y", " lead", "trail "])
    rows = packing.pack(d).collect()
    texts = {r.doc_id: r.text for r in d.collect()}
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i})
        assert own[-1][1] + own[-1][2] == len(ids) and all(n == 1024 for p, _, n, _ in own if p)
        assert all(zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()) == c for _, s, n, c in own)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(empty(spark)).count() == 0


def _histograms():
    rng = np.random.default_rng(7)
    drawn = np.clip(rng.lognormal(5.2, 1.1, 9000).astype(int), 1, 1024)
    yield {n: 50 for n in range(1, 1024)}
    yield {int(n): int(c) for n, c in zip(*np.unique(drawn, return_counts=True))}


@pytest.mark.parametrize("counts", list(_histograms()))
def test_packing_program_is_near_the_bound(counts):
    lengths = np.array(sorted(n for n in counts if n < 1024))
    solution = packing.program(np.array([counts[n] for n in lengths]), lengths)
    # every length is covered, by configurations that fit
    covered = np.zeros(len(lengths))
    for c, x in solution.uses.items():
        assert x > 0 and sum(int(lengths[i]) * a for i, a in c) <= 1024
        for i, a in c:
            covered[i] += a * x / counts[int(lengths[i])]
    assert covered.min() >= 1 - 1e-9
    volume = sum(n * c for n, c in counts.items() if n < 1024) / 1024
    assert volume <= solution.bound and 0 <= solution.gap <= packing.GAP
    chosen = packing.configurations(counts)
    packed = {}
    for own, m in chosen:
        assert sum(own) <= 1024
        for n in own:
            packed[n] = packed.get(n, 0) + m
    assert packed == counts
    full = counts.get(1024, 0)
    assert sum(m for _, m in chosen) <= 1.01 * (volume + full) + 1
    left = {n: counts[n] for n in lengths.tolist()}
    program = sum(m for _, m in packing.rounded(solution, left, lengths, 1024))
    assert program > 0.5 * sum(m for own, m in chosen if len(own) > 1)


def test_packing_bound_is_a_bound():
    """On small cases against the best of all packings."""
    import functools
    rng = np.random.default_rng(8)
    for _ in range(20):
        sizes = sorted(rng.integers(2, 11, 7).tolist(), reverse=True)

        @functools.cache
        def fewest(left):
            if not left:
                return 0
            first, rest = left[0], left[1:]
            best = len(left)
            for k in range(1 << len(rest)):
                own = [x for i, x in enumerate(rest) if k >> i & 1]
                if first + sum(own) <= 12:
                    best = min(best, 1 + fewest(tuple(x for i, x in enumerate(rest) if not k >> i & 1)))
            return best

        counts = {n: sizes.count(n) for n in set(sizes)}
        lengths = np.array(sorted(counts))
        s = packing.program(np.array([counts[n] for n in lengths]), lengths, 12)
        assert s.bound <= fewest(tuple(sizes)) + 1e-9
        assert fewest(tuple(sizes)) <= sum(m for _, m in packing.configurations(counts, 12))


def test_toxicity_learns_and_takes_any_text(spark):
    rng = np.random.default_rng(6)
    calm, rude = [f"calm{i}" for i in range(400)], ["blockhead", "numbskull", "dunderhead"]
    texts = []
    for i in range(500):
        w = [calm[k] for k in rng.integers(0, 400, 60)]
        if i % 4 == 0:
            for k in rng.integers(0, 60, 6):
                w[k] = rude[k % 3]
        texts.append(" ".join(w))
    d = docs(spark, texts + TEXTS)
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(500)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(d, labels).collect()
    assert len(rows) == d.count() and all(0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, int(r.doc_id % 4 == 0)) for r in rows if r.held_out and r.doc_id < 500]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert {r.score for r in toxicity.classify(d, labels.limit(0)).collect()} == {0.0}


def test_toxic_dictionary_holds_every_marked_word():
    rng = np.random.default_rng(9)
    rude = [f"{'jerk boor lout brute'.split()[i % 4]}{i}x" for i in range(400)]
    text = lambda own: " ".join([f"calm{k}" for k in rng.integers(0, 40_000, 60)] + list(own))
    toxic = [text(rng.choice(rude, 25, replace=False)) for _ in range(400)]
    ordinary = [text([]) for _ in range(2000)]
    known = toxicity._dictionaries(toxic, ordinary)[-1]
    assert set(known.decode("utf-8", "replace").split()) == set(rude)


def test_toxicity_learns_from_whole_texts_and_bounded_rows(spark, monkeypatch):
    rng = np.random.default_rng(10)
    calm = lambda n: " ".join(f"calm{k}" for k in rng.integers(0, 300, n))
    # the word is at about 4,000 of 60,000 characters, between the first two slices
    texts = [f"{calm(550)}{' blockhead' if i % 4 == 0 else ''} {calm(7500)}" for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int")
    assert b" blockhead " in toxicity.fit(docs(spark, texts), labels).toxic
    monkeypatch.setattr(toxicity, "SAMPLE", {1: 8, 0: 20})
    hot = spark.createDataFrame([(1, f"text {i % 200}") for i in range(600)] + [(i, f"other {i}") for i in range(2, 90)], "doc_id long, text string")
    known = spark.createDataFrame([(i, 0, i % 3 == 0) for i in range(1, 90)], "doc_id long, toxic int, calibrate boolean")
    rows = toxicity._chosen(hot, known).collect()
    assert len(rows) == 20 + 10 and len({(r.doc_id, r.text) for r in rows}) == len(rows)


def test_chance_is_the_hypergeometric_tail():
    from math import comb
    for a, b, t, o in ((3, 0, 5, 40), (4, 2, 20, 300), (12, 1, 253, 2037), (70, 0, 253, 2037)):
        n = a + b
        want = sum(comb(t, x) * comb(o, n - x) for x in range(a, min(n, t) + 1)) / comb(t + o, n)
        assert toxicity.chance(a, b, t, o) == pytest.approx(want, rel=1e-8)


def test_fixity(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "h" * (i % 50)) for i in range(600)] + [(7, "u7", "again"), (None, None, None), (-3, "n", "neg")], "page_id long, url string, html string")
    rows = {r.page_id: r.status for r in fixity.audit(pages, pages.where("page_id IS NULL OR page_id <> 44").replace("h" * 20, "broken")).collect()}
    assert rows == {44: "missing"} | {i: "changed" for i in range(20, 600, 50)}
    assert fixity.audit(pages, pages.repartition(3)).count() == 0
    assert fixity.audit(pages.limit(0), pages.where("page_id = 44")).collect()[0].status == "extra"


def test_licenses(spark):
    s = licenses.Scanner()
    for name, text in licenses.TEMPLATES.items():
        assert s.best(text)[0] == name and s.best(text)[2] == 0
    assert s.best("a license to print money, as they say in town") is None
    d = docs(spark, ["x\nReleased under the MIT License.\ny", "Released under the MIT License, mostly.", *TEXTS])
    got = sorted((r.doc_id, r.line, r.license, r.exact) for r in licenses.scan(d).collect())
    assert got == [(0, 1, "MIT", True), (0, 1, "MIT", True), (1, 0, "MIT", False)]


def test_licenses_in_paragraphs_and_wrapped_lines(spark):
    import textwrap
    rng = np.random.default_rng(8)
    chat = lambda n: " ".join(f"chat{i}" for i in rng.integers(0, 900, n))
    texts, want = [], []
    for name, notice in licenses.TEMPLATES.items():
        body = "\n".join(" * " + x for x in textwrap.wrap(notice, 34))
        for text in (f"{chat(400)} {notice} {chat(400)}", f"{chat(9)}\n/*\n{body}\n */\n{chat(9)}", "\n".join(textwrap.wrap(notice, 78))):
            want.append((len(texts), name, 0))
            texts.append(text)
    both = f"{licenses.TEMPLATES['MIT']} {licenses.TEMPLATES['Apache-2.0']} {chat(50)} {licenses.TEMPLATES['MIT']}"
    want += [(len(texts), n, 0) for n in ("Apache-2.0", "MIT", "MIT")]
    texts.append(both)
    # a lost cue word, and words put between
    want += [(len(texts), "MPL-2.0", 1), (len(texts) + 1, "Apache-2.0", 0)]
    texts += [licenses.TEMPLATES["MPL-2.0"].replace("License", "Licence"), "Licensed under the widely used and old Apache License, Version 2.0."]
    texts += [f"{chat(30)} the license of this work is held by the public, version two, {chat(30)}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(frame).collect()
    assert sorted((r.doc_id, r.license, r.lacking) for r in rows) == sorted(want)
    for r in rows:
        if r.lacking == 0 and r.besides == 0:
            assert licenses.words(texts[r.doc_id][r.start:r.end]) == licenses.words(licenses.TEMPLATES[r.license])
    assert sum(r.exact for r in rows) == 2 * len(licenses.TEMPLATES)


def test_pipeline(spark):
    import corpus_pipeline
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mix", "packing"]
    assert rows.count() > 0 and "sequence_id" in rows.columns
