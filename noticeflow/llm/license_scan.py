"""License notices in texts: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Words are lower-cased runs without ASCII punctuation; a shingle is two words. A template of L
words belongs to the class w, the power of two with w/2 < L <= w. Windows of that class are 3w/2
words long and start every w/2 words, so one of them holds any passage of up to w words whole.
If such a window contains CONTAINMENT of the template's shingles, their Jaccard similarity is
at least ``least_similarity``; bands of one MinHash value each are added until the
probability that one of them collides is at least COLLISION.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from noticeflow.llm.common import Words, map_text, mix64
from noticeflow.llm.license_templates import MORE

CONTAINMENT, COLLISION = 0.8, 0.9999
SMALLEST = 8  # words of the smallest class
LOW_BITS = 4095

# Short public notices by license name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)
# The first wording of a text counts.
TEMPLATES += tuple(t for t in MORE if t[1] not in {text.rstrip(".") for _, text in TEMPLATES})

# Bytes to bytes: A-Z lower-cased, other ASCII but letters and digits blanked.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def folded(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def least_similarity(containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a template and a window that contains that share of it (template: w/2, window: 3w/2)."""
    return containment / 2 / (1.5 + (1 - containment) / 2)


def bands_for(similarity: float, collision: float = COLLISION) -> int:
    """Number of one-value bands of which one collides with that probability."""
    return math.ceil(math.log(1 - collision) / math.log(1 - similarity))


@dataclass
class Template:
    number: int
    name: str
    words: int
    size: int  # class
    shingles: frozenset
    times: Counter  # of each shingle in the template


def build(templates) -> list[Template]:
    out = []
    for number, (name, text) in enumerate(templates):
        words = folded(text)
        if len(words) < 2:
            raise ValueError(f"a template has two words at least: {text!r}")
        size = max(SMALLEST, 1 << (len(words) - 1).bit_length())
        times = Counter(zip(words, words[1:], strict=False))
        out.append(Template(number, name, len(words), size, frozenset(times), times))
    return out


def band_hash(shingles: np.ndarray, band: int) -> np.ndarray:
    seed = mix64(np.uint64([2 * band + 1, 2 * band + 2]))
    values = shingles * (seed[0] | np.uint64(1)) + seed[1]
    return values ^ (values >> np.uint64(31))


def pair_hashes(words: np.ndarray) -> np.ndarray:
    return mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


class Index:
    """MinHash values of the templates, by class and band."""

    def __init__(self, templates):
        self.templates = build(templates)
        self.bands = bands_for(least_similarity())
        self.sizes = sorted({t.size for t in self.templates})
        hashes = [pair_hashes(Words(pa.array([text]), FOLD).hash) for _, text in templates]
        self.hashes = [frozenset(h.tolist()) for h in hashes]
        self.values = {(size, band): [(band_hash(hashes[t.number], band).min(), t) for t in self.templates if t.size == size]
                       for size in self.sizes for band in range(self.bands)}
        # Which low bits the values have: most windows are dismissed by one look, however many templates there are.
        self.low = {at: np.isin(np.arange(LOW_BITS + 1), [int(value) & LOW_BITS for value, _ in values]) for at, values in self.values.items()}

    def candidates(self, words: np.ndarray) -> set[tuple[int, int, int]]:
        """(first word, end word, template) of the windows that meet a template in a band.

        Windows run over the batch as one sequence; those that reach over two texts only add candidates.
        """
        found: set[tuple[int, int, int]] = set()
        if len(words) < 2:
            return found
        shingles = pair_hashes(words)
        step = SMALLEST // 2
        longest = 3 * self.sizes[-1]
        padded = -(-len(shingles) // step) * step
        for band in range(self.bands):
            values = np.full(padded + longest, np.iinfo(np.uint64).max, np.uint64)
            values[:len(shingles)] = band_hash(shingles, band)
            blocks, width = values[: len(values) // step * step].reshape(-1, step).min(axis=1), step
            for size in self.sizes:
                while width < size // 2:
                    blocks = blocks[: len(blocks) // 2 * 2].reshape(-1, 2).min(axis=1)
                    width *= 2
                least = np.minimum(np.minimum(blocks[:-2], blocks[1:-1]), blocks[2:])
                likely = np.flatnonzero(self.low[size, band][(least & np.uint64(LOW_BITS)).astype(np.intp)])
                if not len(likely):
                    continue
                some = least[likely]
                for value, template in self.values[size, band]:
                    for place in likely[some == value].tolist():
                        found.add((place * width, place * width + 3 * width, template.number))
        return found


def occurrences(template: Template, places: list[tuple[int, tuple]], containment: float) -> list[list]:
    """[first word, end word, contained share] of each notice among the matching shingles (word, shingle) of a stretch.

    A notice ends before a break in the text when what follows repeats a shingle more often than the template has it,
    or is too far away.
    """
    out, own, times, run = [], [], Counter(), 0  # run: where the last unbroken run of `own` starts

    def share(part) -> float:
        return len({shingle for _, shingle in part}) / len(template.shingles)

    for place, shingle in places:
        if own and place != own[-1][0] + 1:
            run = len(own)
        while own and (times[shingle] >= template.times[shingle] or place - own[0][0] >= 3 * template.size // 2):
            if run and (held := share(own[:run])) >= containment:
                out.append([own[0][0], own[run - 1][0] + 2, held])
                own, run = own[run:], 0
                times = Counter(s for _, s in own)
            else:
                times[own.pop(0)[1]] -= 1
                run = max(0, run - 1)
        own.append((place, shingle))
        times[shingle] += 1
    if (held := share(own)) >= containment:
        out.append([own[0][0], own[-1][0] + 2, held])
    return out


def matches(index: Index, words: Words, raw: list[bytes], containment: float) -> list[tuple]:
    """(text, template, start byte, end byte, contained share) of the verified notices of a batch."""
    stretches: dict[tuple[int, int], list] = {}  # of overlapping spans: the best of them, end word, matching shingles
    hashed = pair_hashes(words.hash) if len(words.hash) > 1 else words.hash[:0]
    for first, end, number in sorted(index.candidates(words.hash)):
        template = index.templates[number]
        end = min(end + 1, len(words.hash))  # the last shingle has one word more
        # Equal shingles have equal hashes, so a window with too few hashes of the template cannot pass.
        if len(index.hashes[number].intersection(hashed[first:end - 1].tolist())) / len(index.hashes[number]) < containment:
            continue
        for text in range(words.row[first], words.row[end - 1] + 1) if first < end else ():
            a, z = max(first, words.first[text]), min(end, words.first[text + 1])
            own = [bytes(words.raw[words.start[w]:words.end[w]]) for w in range(a, z)]
            pairs = list(zip(own, own[1:], strict=False))
            held = template.shingles & set(pairs)
            share = len(held) / len(template.shingles)
            if share < containment:
                continue
            places = {a + i: p for i, p in enumerate(pairs) if p in template.shingles}
            span = [min(places), max(places) + 2, share]
            found = stretches.setdefault((text, number), [])
            if found and span[0] < found[-1][1]:  # the same notice, seen from the next window, or one close behind
                best, stop, all_places = found[-1]
                all_places.update(places)
                found[-1] = (span if share > best[2] else best, max(stop, span[1]), all_places)
            else:
                found.append((span, span[1], places))
    out = []
    for (text, number), found in sorted(stretches.items()):
        for best, _, places in found:
            several = occurrences(index.templates[number], sorted(places.items()), containment)
            for a, z, share in several if len(several) > 1 else [best]:
                base = words.begin[text]
                out.append((text, number, int(words.start[a] - base), int(words.end[z - 1] - base), share))
    return out


def find_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id", templates=TEMPLATES,
                  containment: float = CONTAINMENT) -> DataFrame:
    """(key, license, template, start, end, containment): each notice found in each whole text.

    start and end are code points, end exclusive, from the first to the last word
    of the notice. Texts without one give no row; NULL counts as empty; repeated rows
    give their rows again; NULL keys are kept; other columns are not read. An empty
    table gives no rows. There is no shuffle: the few templates are a parameter and travel with the tasks.
    """
    kind = docs.schema[key].dataType.simpleString()
    index = Index(templates)
    rows = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")

    def make(batch: pa.RecordBatch) -> dict:
        keys = batch.column("_key").to_pylist()
        raw = [t or b"" for t in batch.column("_text").cast(pa.binary()).to_pylist()]
        words = Words(batch.column("_text"), FOLD)
        out = []
        for text_no, number, start, end, share in matches(index, words, raw, containment):
            begin = len(raw[text_no][:start].decode())
            out.append((keys[text_no], index.templates[number].name, number, begin,
                        begin + len(raw[text_no][start:end].decode()), share))
        names = ("_key", "license", "template", "start", "end", "containment")
        return dict(zip(names, zip(*out, strict=True) if out else [[]] * len(names), strict=True))

    schema = f"_key {kind}, license string, template int, start bigint, `end` bigint, containment double"
    return map_text(rows, "_text", schema, make).withColumnRenamed("_key", key)
