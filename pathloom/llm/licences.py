"""Licences in texts: windows of the whole text compared with templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import string
from dataclasses import dataclass
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bounded_batches

# Short public licence notices, by identifier.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def whole_texts() -> tuple:
    """(identifier, text) of the whole licences in the folder beside this file."""
    return tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))


@dataclass(frozen=True)
class Scan:
    """A window is reported from a Dice coefficient of `least` on; `templates` and `texts` are (identifier, text), `texts` None the whole licences."""

    least: float = 0.8
    templates: tuple = TEMPLATES
    texts: tuple | None = None


_PLAIN = bytes(c if chr(c) in string.ascii_lowercase + string.digits else 32 for c in range(256))


def normalised(text: str) -> bytes:
    """Lower case, in UTF-8; every byte other than a-z and 0-9 is a blank, so words are what split() gives."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


class Grams:
    """The bigrams of a text, numbered, with where each stood last and stands next.

    A window's counts change only at bigrams that are new in it. They are found by blocks, whose least `before` says whether any of a
    block is new to a window that begins at s.
    """

    BLOCK = 64

    def __init__(self, same: np.ndarray):
        n = self.n = len(same)
        self.same = same
        order = np.argsort(same, kind="stable")
        again = same[order[1:]] == same[order[:-1]]
        self.before, self.next = np.full(n, -1), np.full(n, n)
        self.before[order[1:][again]] = order[:-1][again]
        self.next[order[:-1][again]] = order[1:][again]
        self.low = np.minimum.reduceat(self.before, np.arange(0, n, self.BLOCK))

    def new(self, s: int, end: int) -> np.ndarray:
        """The places in [s, end) of bigrams that don't stand in [s, place)."""
        a, b = s // self.BLOCK, -(-end // self.BLOCK)
        blocks = a + np.flatnonzero(self.low[a:b] < s)
        places = (blocks[:, None] * self.BLOCK + np.arange(self.BLOCK)).ravel()
        places = places[(places >= s) & (places < end)]
        return places[self.before[places] < s]

    def _best_from(self, s: int, end: int, mine: np.ndarray, size: int, held: int, most: float) -> tuple[float, np.ndarray]:
        """The best Dice coefficient of the windows [s, e] with e < end, and the last places of those that have it."""
        length = int(most) + 16
        while True:
            places = self.new(s, min(end, s + length))
            m = np.cumsum(mine[places])
            if s + length >= end or len(places) > most or m[-1] == held:
                break
            length *= 4
        each = 2.0 * m / (np.arange(1, len(places) + 1) + size)
        dice = float(each.max())
        return dice, places[each == dice]

    def _first_start(self, s: int, e: int) -> int:
        """How far back a window that ends at e can begin without another bigram than those of [s, e]."""
        known = np.zeros(int(self.same.max()) + 1, bool)
        known[self.same[s : e + 1]] = True
        step = self.BLOCK
        while s > 0:
            strange = np.flatnonzero(~known[self.same[max(0, s - step) : s]])
            if len(strange):
                return max(0, s - step) + int(strange[-1]) + 1
            s, step = max(0, s - step), 2 * step
        return s

    def window(self, mine: np.ndarray, size: int, held: int, least: float) -> tuple | None:
        """(Dice coefficient, first and last bigram) of the window best for a template of `size` bigrams, the earliest of equals; `mine`: which
        bigrams are the template's, `held` of them different ones. The best windows begin with one.

        A window that holds its first bigram again is no better than one that begins later, so a start is looked at up to the next such
        bigram only; starts with too little room before it are passed over. So of each of the template's bigrams the stretches between its places are gone
        through once, by blocks: linear in the text's length.
        """
        most = size * (2 - least) / least  # different bigrams a window can have at most
        room = int(np.ceil(least * size / (2 - least) - 1e-9))  # and of the template's at least
        counts = np.concatenate([[0], np.cumsum(mine)])
        starts = np.flatnonzero(mine)
        starts = starts[counts[self.next[starts]] - counts[starts] >= room]
        top, ties = least, []
        for s in starts.tolist():
            # with m of the template's bigrams at most, and as many different ones at least
            m = min(held, int(counts[self.next[s]] - counts[s]))
            if 2.0 * m / (m + size) < top:
                continue
            dice, ends = self._best_from(s, int(self.next[s]), mine, size, held, most)
            if dice > top or dice == top and not ties:
                top, ties = dice, []
            if dice == top:
                ties.append((s, int(ends[-1])))
                if dice == 1.0:
                    break
        if not ties:
            return None
        s, e = ties[0]
        first = self._first_start(s, e)
        for s, e in ties[1:]:
            if not np.isin(self.same[first:s], self.same[s : e + 1]).all():
                continue
            first = min(first, self._first_start(s, e))
        first += int(np.flatnonzero(mine[first:])[0])
        return top, first, int(self._best_from(first, self.n, mine, size, held, most)[1][0])


class Scanner:
    """The templates' bigrams, and the search of a text for the best window."""

    def __init__(self, p: Scan):
        forms = [(0, *t) for t in (whole_texts() if p.texts is None else p.texts)] + [(1, *t) for t in p.templates]
        words = [normalised(text).split() for *_, text in forms]
        if any(len(w) < 2 for w in words):
            raise ValueError("a template needs two words at least")
        self.least, self.names = p.least, [(kind, name, k) for k, (kind, name, _) in enumerate(forms)]
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.base = len(self.vocab) + 1
        coded = [np.unique(self._codes(np.array([self.vocab[w] for w in ws], np.int64))) for ws in words]
        grams = np.unique(np.concatenate(coded))
        self.sizes = np.array([len(c) for c in coded])
        self.gram = np.zeros(self.base**2, np.int32)  # a pair of word numbers gives its bigram, 0 for none of a template
        self.gram[grams] = np.arange(1, len(grams) + 1)
        self.member = np.zeros((len(grams) + 1, len(forms)), bool)
        for k, c in enumerate(coded):
            self.member[self.gram[c], k] = True

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        return ids[:-1] * self.base + ids[1:]

    def best(self, text: str | None) -> tuple | None:
        """(identifier, Dice coefficient, line) of the best match, or None."""
        return next(iter(self.all(text)), None)

    def all(self, text: str | None) -> list[tuple]:
        """(identifier, Dice coefficient, line) of the matches, best first: the best window of each template, without those that
        overlap a better one."""
        plain = normalised(text or "")
        words = plain.split()
        if len(words) < 2:
            return []
        found = self.gram[self._codes(np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words)))]
        here = np.unique(found[found > 0])
        # a window of m of a template's g bigrams reaches 2 m / (m + g) at most
        held = self.member[here].sum(0)
        likely = np.flatnonzero(2.0 * held >= self.least * (held + self.sizes))
        if not len(likely):
            return []
        order: dict[bytes, int] = {}
        numbers = np.fromiter((order.setdefault(w, len(order)) for w in words), np.int64, len(words))
        grams = Grams(np.unique(numbers[:-1] * len(words) + numbers[1:], return_inverse=True)[1])
        data = np.frombuffer(plain, np.uint8) != 32
        starts = np.flatnonzero(data & ~np.r_[False, data[:-1]])
        raw = text.lower().encode("utf-8", "surrogatepass")
        matches = []
        for k in likely:
            hit = grams.window(self.member[found, k], int(self.sizes[k]), int(held[k]), self.least)
            if hit:
                kind, name, number = self.names[k]
                line = raw.count(b"\n", 0, int(starts[hit[1]])) + 1
                matches.append((kind, -hit[0], line, name, number, hit[1], hit[2]))
        kept = []
        for m in sorted(matches):
            if all(m[6] < o[5] or m[5] > o[6] for o in kept):
                kept.append(m)
        return [(m[3], -m[1], m[2]) for m in kept]


def scan_licences(docs: DataFrame, p: Scan = Scan(), every: bool = False) -> DataFrame:
    """Rows (doc_id, licence, dice, line): for each row of `docs` its best matching template and the line where its window begins, nulls if none reaches `p.least`.

    With `every`, a row for each licence of a text instead, where windows don't overlap a better one's, and none for texts without.

    The text is one sequence of words, whatever its lines and punctuation; a window is any run of them. The Dice coefficient of
    sets of sizes a and b is at most 2 min(a, b) / (a + b), so a text that holds too few of a template's bigrams is left, and a
    window ends where it holds too many. Whole licence texts go before notices, for notices are often parts of other licences'
    texts; ties then go by the greatest coefficient, the earlier line, the smaller identifier and template number. Lines are numbered from 1.

    Cases: null and empty texts have no match; repeated rows are reported each; an empty table gives no rows. Very long texts are read
    whole, in time linear in their length. Other columns don't matter, whatever their
    names. Everything stays within the row, so nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    p = Scan(p.least, p.templates, whole_texts() if p.texts is None else p.texts)  # read by the driver
    out = T.StructType([docs.schema["doc_id"], T.StructField("licence", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("line", T.LongType())])

    def scan(batches):
        scanner = Scanner(p)
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                mine = scanner.all(text) if every else [scanner.best(text) or (None, None, None)]
                rows += [i] * len(mine)
                found += mine
            names, dice, lines = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(dice, pa.float64()), pa.array(lines, pa.int64())], out.names)

    return docs.select("doc_id", "text").mapInArrow(scan, out)
