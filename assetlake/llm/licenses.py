"""License scans by conditional compression.

Notices are looked for in the whole text, across line breaks, in documents that hold a cue word. A
template may lack ``LACKING`` of its words, say ``k``; of ``k + 1`` pieces of it one is then whole, so
each piece gives a word, its anchor, and every place of an anchor in the text is tried. There the
template's words are aligned, in order, with the text's words up to ``REACH`` times the template's
length away on either side: of the alignments that lack few enough words the one with the fewest
changes gives the block. The block, white space and comment marks at line starts folded, is
compressed alone and after the template as a zstandard raw dictionary, and is a notice if that saves
at least ``SAVED`` of the template's own compressed size. Of notices that share words the one that
saves most bytes is kept, so each notice is reported once and all notices of a line are reported.

Columns: ``line`` and ``part`` (the first line of the notice, and its number among those that begin
there), ``start`` and ``end`` (characters of the text), ``saved``, ``lacking`` (words of the template that the
notice lacks or changes) and ``besides`` (other words inside the notice or on its first and last line).

Defined results: a null or empty text, or one without a cue word, has no notices; ties of saving go
to the template that lacks fewer words, then by name; repeated rows and repeated notices are reported
each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wording of common license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "BSD-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Words of which every notice above has one.
CUES = ("licen", "copyright", "permission", "redistribution", "spdx")
LEVEL = 19
SAVED, LACKING = 0.35, 0.15
#: How far from an anchor a template's words may be, in lengths of the template.
REACH = 3
_WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_MARGIN = re.compile(r"\s*\n[\s#*/;%>!|-]*|\s+")
HIT = "line long, part long, start long, end long, license string, saved double, lacking long, besides long"


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _extents(template: list[str], own: list[tuple[int, str]]) -> list[int]:
    """For each number of words that can match in order, the fewest words of the text that hold them."""
    row, out = [0] * (len(template) + 1), [0]
    for at, w in own:
        last = 0
        for i, t in enumerate(template):
            here = row[i + 1]
            row[i + 1] = last + 1 if t == w else max(here, row[i])
            last = here
        if row[-1] == len(out):
            out.append(at)
    return out


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        params = dict(write_content_size=0, write_checksum=0, write_dict_id=0)
        self.alone = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, **params))
        self.after, self.words, self.size, self.most = {}, {n: words(t) for n, t in templates.items()}, {}, {}
        self.bags, self.anchors = {n: Counter(t) for n, t in self.words.items()}, {}
        for name, text in sorted(templates.items()):
            known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(text), **params)
            known.precompute_compress(compression_params=p)
            self.after[name] = zstandard.ZstdCompressor(compression_params=p, dict_data=known)
            self.size[name] = len(self.alone.compress(text.encode()))
            own = self.words[name]
            k = self.most[name] = int(LACKING * len(own))
            for i in range(k + 1):
                piece = range(i * len(own) // (k + 1), (i + 1) * len(own) // (k + 1))
                at = max(piece, key=lambda j: (any(c in own[j] for c in CUES), len(own[j])))
                self.anchors.setdefault(own[at], []).append((name, at))
        self.known = set().union(*self.words.values())

    def _align(self, name: str, at: int, here: int, places: list[int], own: list[tuple[int, str]]) -> tuple[int, int, int, int] | None:
        """(first word, last word, words lacking, words between) with word ``here`` of the text as word ``at`` of the template."""
        template, most, bag = self.words[name], self.most[name], self.bags[name]
        reach = REACH * len(template)
        a, b = bisect_left(places, here - reach), bisect_right(places, here + reach)
        near = [x for x in own[a:b] if x[1] in bag]
        if len(template) - sum((bag & Counter(w for _, w in near)).values()) > most:
            return None
        before = _extents(template[:at][::-1], [(here - i, w) for i, w in reversed(near) if i < here])
        behind = _extents(template[at + 1:], [(i - here, w) for i, w in near if i > here])
        found = []
        for m, x in enumerate(before):
            for n, y in enumerate(behind):
                lacking = len(template) - 1 - m - n
                if lacking <= most:
                    between = x - m + y - n
                    # a missing word weighs as much as three words between
                    found.append((3 * lacking + between, lacking, between, here - x, here + y))
        if not found:
            return None
        _, lacking, between, first, last = min(found)
        return first, last, lacking, between

    def hits(self, text: str) -> list[tuple]:
        """Every notice of a text, as the columns of HIT."""
        starts, ends, own = array("q"), {}, []
        for i, m in enumerate(_WORDS.finditer(text)):
            starts.append(m.start())
            if (w := m.group().lower()) in self.known:
                own.append((i, w))
                ends[i] = m.end()
        places = [i for i, _ in own]
        tried, found = set(), []
        for here, w in own:
            for name, at in self.anchors.get(w, ()):
                r = self._align(name, at, here, places, own)
                if r is None or (name, *r) in tried:
                    continue
                tried.add((name, *r))
                first, last, lacking, between = r
                block = _MARGIN.sub(" ", text[starts[first]:ends[last]]).encode("utf-8", "replace")
                saved = len(self.alone.compress(block)) - len(self.after[name].compress(block))
                if saved >= SAVED * self.size[name]:
                    found.append((-saved, lacking, name, first, last, between))
        kept, taken = [], []
        for hit in sorted(found):
            first, last = hit[3:5]
            i = bisect_left(taken, (first, first))
            if (i and taken[i - 1][1] >= first) or (i < len(taken) and taken[i][0] <= last):
                continue
            taken.insert(i, (first, last))
            kept.append(hit)
        breaks = [m.start() for m in re.finditer("\n", text)] if kept else []
        out, part = [], Counter()
        for saved, lacking, name, first, last, between in sorted(kept, key=lambda h: h[3]):
            start, end = starts[first], ends[last]
            line, after = bisect_left(breaks, start), bisect_left(breaks, end)
            begin, stop = breaks[line - 1] if line else -1, breaks[after] if after < len(breaks) else len(text)
            besides = between + first - bisect_left(starts, begin) + bisect_left(starts, stop) - 1 - last
            out.append((line, part[line], start, end, name, -saved / self.size[name], lacking, besides))
            part[line] += 1
        return out

    def best(self, block: str) -> tuple[str, float, int, int] | None:
        """(template, share saved, words lacking, words besides) of a block's best license, if it has one."""
        found = [h[4:] for h in self.hits(block)]
        return min(found, key=lambda h: (-h[1] * self.size[h[0]], h[2], h[0])) if found else None


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and whole text of every document that has a cue word."""
    text = F.col(text_col).cast("string")

    def cued(x: Column) -> Column:
        low = F.lower(x)
        c = low.contains(CUES[0])
        for cue in CUES[1:]:
            c = c | low.contains(cue)
        return c

    return docs.where(cued(text)).select(F.col(id_col).alias("doc_id"), text.alias("text"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each license notice."""
    names = [c.split()[0] for c in HIT.split(", ")]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner()
        for batch in texts:
            yield pd.Series([[dict(zip(names, h)) for h in scanner.hits(t)] for t in batch], dtype=object)

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    found = F.pandas_udf(run, f"array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>")
    return (candidates(docs, id_col, text_col).select("doc_id", F.explode(found("text")).alias("r")).select("doc_id", "r.*")
            .withColumn("exact", (F.col("lacking") == 0) & (F.col("besides") == 0)))
