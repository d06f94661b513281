"""License notices found by MinHash over text windows and verified by shingle containment.

A text's shingles are covered by windows that overlap by half, in sizes fitted to the
templates: a template that occurs in a text lies wholly in one window of its size. Each band is
one smallest hash; a window and a template that share a band's hash are a candidate pair, which
is kept if the window holds enough of the template's shingles. A template of a few words is one
shingle of all its words, and its windows are the single shingles of that length: there the hash
is the same for certain or not at all. Nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablesync.llm.common import NOT_ALPHANUMERIC, Words, byte_slices, map_arrow, mix64

# Public wordings of license notices, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "under the Apache License 2.0",
        "under the Apache License, Version 2.0",
        "under the Apache 2.0 License",
        "Licensed under Apache-2.0",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "SPDX-License-Identifier: MIT OR Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "under the GNU General Public License v3",
        "under the GNU GPL v3",
        "under the GNU GPLv3",
        "under the GPLv3",
        "under the GPL-3.0",
        "Licensed under GPL-3.0",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "under the GNU General Public License, version 2",
        "under the GNU General Public License v2",
        "under the GNU GPL v2",
        "under the GPLv2",
        "under the GPL-2.0",
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "under the GNU Lesser General Public License v3",
        "under the LGPLv3",
        "under the LGPL-3.0",
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "under the GNU Affero General Public License v3",
        "under the AGPLv3",
        "under the AGPL-3.0",
        "SPDX-License-Identifier: AGPL-3.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under CC BY 4.0.",
        "under a CC BY 4.0 License",
        "under the CC BY 4.0 License",
        "under a Creative Commons Attribution 4.0",
        "under the Creative Commons Attribution 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Released under CC BY-SA 4.0.",
        "under a CC BY-SA 4.0 License",
        "under the CC BY-SA 4.0 License",
        "under a Creative Commons Attribution-ShareAlike 4.0",
        "under the Creative Commons Attribution-ShareAlike 4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC 4.0.",
        "under a CC BY-NC 4.0 License",
        "under the CC BY-NC 4.0 License",
        "under a Creative Commons Attribution-NonCommercial 4.0",
        "under the Creative Commons Attribution-NonCommercial 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "MIT": [
        "Licensed under the terms of the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "under the MIT License",
        "under the terms of the MIT License",
        "Licensed under MIT",
        "Released under MIT",
        "SPDX-License-Identifier: MIT",
        "SPDX-License-Identifier: Apache-2.0 OR MIT",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "under the BSD License",
        "under the 2-Clause BSD License",
        "under the 3-Clause BSD License",
        "under the BSD 2-Clause License",
        "under the BSD 3-Clause License",
        "under a BSD-style license",
        "SPDX-License-Identifier: BSD",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "under the Mozilla Public License 2.0",
        "under the Mozilla Public License, v. 2.0",
        "under the Mozilla Public License, Version 2.0",
        "under the MPL 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "under the Unlicense",
        "SPDX-License-Identifier: Unlicense",
    ],
    "CC0-1.0": [
        "under CC0 1.0",
        "under the CC0 1.0",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

#: Words in a shingle.
SHINGLE = 5
#: Templates of up to so many words have to occur whole, as one shingle. (In shingles of SHINGLE
#: words they would be four at most, of which CONTAINED asks for all.)
PHRASE = 8
#: Bands of one hash each. A window of twice a template's shingles that holds CONTAINED of them
#: has a similarity of about 0.31 at least and shares a band with probability 1 - 7e-6.
BANDS = 32
CONTAINED = 0.8

_SEEDS = [int(x) for x in np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 >> 8)]


def _rank(shingles: np.ndarray, band: int) -> np.ndarray:
    """The order of shingles in a band: a multiply and shift of hashes that are already mixed."""
    with np.errstate(over="ignore"):
        value = (shingles ^ np.uint64(_SEEDS[band])) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def _chain(value: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One step of the hash of a run of words, word by word."""
    with np.errstate(over="ignore"):
        return mix64(value * np.uint64(0xD6E8FEB86659FD93) + word + np.uint64(1))


class Library:
    """Templates by size: for each number of shingles the templates with their band values, and
    for each small number of words the templates that are one shingle."""

    def __init__(self, templates: Mapping[str, list[str]]):
        named = [(name, text) for name, texts in sorted(templates.items()) for text in texts]
        words = Words(pa.array([t for _, t in named], pa.string()), NOT_ALPHANUMERIC)
        values, owner = words.shingles(SHINGLE)
        lengths, hashes = np.diff(words.first), words.hashes()
        # by number of words, the templates of up to PHRASE words with the hash of them all
        self.phrases: dict[int, list[tuple[int, np.uint64]]] = defaultdict(list)
        for i in np.flatnonzero((lengths > 0) & (lengths <= PHRASE)):
            value = np.zeros(1, np.uint64)
            for word in hashes[words.first[i] : words.first[i + 1]]:
                value = _chain(value, word)
            self.phrases[int(lengths[i])].append((int(i), value[0]))
        self.heads = np.unique(hashes[[words.first[i] for own in self.phrases.values() for i, _ in own]])
        self.names = [name for name, _ in named]
        self.shingles = [np.unique(values[owner == i]) for i in range(len(named))]
        self.by_size: dict[int, list[int]] = defaultdict(list)
        for i, own in enumerate(self.shingles):
            if lengths[i] > PHRASE:
                # sizes in four steps to the double, so that windows are made for few sizes
                size = int(2 ** (np.ceil(4 * np.log2(len(own))) / 4)) + 1
                self.by_size[size].append(i)
        self.bands = {
            size: [np.array([_rank(self.shingles[i], band).min() for i in own]) for band in range(BANDS)]
            for size, own in self.by_size.items()
        }

    def occurrences(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """Template of up to PHRASE words, and the numbers of the first and the last word of a
        place where it stands."""
        hashes = words.hashes()
        at = np.flatnonzero(np.isin(hashes, self.heads))
        stop, value = words.first[words.owner[at] + 1], np.zeros(len(at), np.uint64)
        for length in range(1, PHRASE + 1):
            inside = at + length <= stop
            at, stop = at[inside], stop[inside]
            value = _chain(value[inside], hashes[at + length - 1])
            for template, own in self.phrases.get(length, []):
                for word in at[value == own]:
                    yield template, int(word), int(word) + length - 1

    def candidates(self, values: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Template, and the bounds of a window that shares a band with it; text t has the
        shingles from `first[t]` to `first[t + 1]`."""
        ranks = [_rank(values, band) for band in range(BANDS)]
        counts = np.diff(first)
        for size, own in self.by_size.items():
            blocks = -(-counts // size)
            start = np.repeat(first[:-1], blocks)
            start = start + size * (np.arange(len(start)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            text = np.repeat(np.arange(len(counts)), blocks)
            if not len(start):
                continue
            follows = np.r_[text[1:] == text[:-1], False]
            stop = np.minimum(start + 2 * size, first[text + 1])
            hits = []
            for band, rank in enumerate(ranks):
                least = np.minimum.reduceat(rank, start)
                least = np.where(follows, np.minimum(least, np.r_[least[1:], least[-1:]]), least)
                for at, value in enumerate(self.bands[size][band]):
                    hits.append(np.flatnonzero(least == value) * len(own) + at)
            for hit in np.unique(np.concatenate(hits)):
                window, at = divmod(int(hit), len(own))
                yield own[at], int(start[window]), int(stop[window])


def scan_licenses(docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, licenses (distinct, sorted) and matches: arrays, empty where nothing is found.

    A match has the license, the share of the template's shingles that its window holds, and
    its place as first and last character (from 0, the last excluded) of the whole text. Case
    and punctuation don't count. A template of up to PHRASE words has to stand there whole. A notice inside a longer one of the same license is not told
    apart. A null or empty text matches nothing; each row is scanned by itself, so repeated rows and
    ids give repeated results. An empty table gives an empty table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Library(templates)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words = Words(part.column("text"), NOT_ALPHANUMERIC)
                values, owner = words.shingles(SHINGLE)
                first = np.searchsorted(owner, np.arange(part.num_rows + 1))
                found = defaultdict(list)
                for template, head, tail in library.occurrences(words):
                    span = int(words.start[head]), int(words.end[tail])
                    found[int(words.owner[head])].append((*span, library.names[template], 1.0))
                for template, start, stop in library.candidates(values, first):
                    own = library.shingles[template]
                    inside = np.flatnonzero(np.isin(values[start:stop], own))
                    share = len(np.unique(values[start + inside])) / len(own)
                    if share >= CONTAINED:
                        text = int(owner[start])
                        word = words.first[text] + start - first[text] + inside
                        last = np.minimum(word[-1] + SHINGLE, words.first[text + 1]) - 1
                        found[text].append((int(words.start[word[0]]), int(words.end[last]), library.names[template], share))
                matches = [_merged(found.get(t, []), words, t) for t in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([sorted({m["license"] for m in own}) for own in matches], pa.list_(pa.string())),
                        pa.array(matches, pa.list_(_MATCH)),
                    ],
                    ["doc_id", "licenses", "matches"],
                )

    return map_arrow(
        docs.select("doc_id", "text"), scanned,
        f"doc_id {kind}, licenses array<string>, matches array<struct<license:string,first:bigint,last:bigint,contained:double>>",
    )


_MATCH = pa.struct([("license", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("contained", pa.float64())])


def _merged(found: list[tuple[int, int, str, float]], words: Words, text: int) -> list[dict]:
    """Overlapping finds of a license as one, with places in characters."""
    out: list[dict] = []
    for license in sorted({f[2] for f in found}):
        spans: list[list] = []
        for first, last, _, share in sorted(f for f in found if f[2] == license):
            if spans and first < spans[-1][1]:
                spans[-1][1:] = max(last, spans[-1][1]), max(share, spans[-1][2])
            else:
                spans.append([first, last, share])
        base = int(words.text_start[text])
        for first, last, share in spans:
            head = words.data[base:first].tobytes().decode()
            body = words.data[first:last].tobytes().decode()
            out.append({"license": license, "first": len(head), "last": len(head) + len(body), "contained": share})
    return sorted(out, key=lambda m: (m["first"], m["license"]))
