"""License scans: winnowed fingerprints of templates, then banded alignment.

A template's word trigrams are hashed and winnowed: of every ``WINNOW`` neighbours the smallest is kept
(the rightmost of equals). The kept fingerprints form an inverted index from trigram to template places. A
document is looked up with all its trigrams, so any stretch that shares ``GRAM + WINNOW - 1`` words in a row
with a template is a candidate. Candidates near one diagonal are joined and aligned with the template,
at most ``BAND`` words off the diagonal; the report has the share of template words matched in order and the
span of the document that they cover.

Scale: documents are read once and never shuffled. Templates are broadcast in blocks of at most ``BLOCK_WORDS`` words;
a longer list takes more passes. A document is scanned in arrays of word numbers, and only stretches around
candidates are aligned, so very long documents cost their length.

Defined results: a null or empty text, or one without a match, gives no row; empty templates match nothing; each
matched stretch is a row, so repeated notices and repeated rows repeat; equal alignments report the first; other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.llm.common import by_size, read_table, small_batches, utf8_column, words_of
from sentiflow.llm.decontamination import LOWER, WORD

GRAM = 3
WINNOW = 2
BAND = 4
COVERAGE = 0.8
BLOCK_WORDS = 1 << 20
SLICE_BYTES = 4 << 20

#: Public licence notices (fixed values): the names and usual sentences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def trigram_keys(ids: np.ndarray, kinds: int) -> np.ndarray:
    """A number for each ``GRAM`` consecutive words."""
    key = np.zeros(max(0, len(ids) - GRAM + 1), np.int64)
    for i in range(GRAM):
        key = key * kinds + ids[i : i + len(key)]
    return key


def scrambled(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class TemplateIndex:
    """Inverted index of the winnowed trigrams of some templates."""

    def __init__(self, templates: dict[str, str]):
        self.vocabulary: dict[bytes, int] = {}
        self.names, self.words = [], []
        for name, text in templates.items():
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text.encode())]
            if ids:
                self.names.append(name)
                self.words.append(np.array(ids, np.int64))
        self.kinds = len(self.vocabulary) + 1
        if self.kinds**GRAM >= 1 << 63:
            raise ValueError("a block of templates holds too many distinct words")
        places = defaultdict(list)
        for t, ids in enumerate(self.words):
            keys = trigram_keys(ids, self.kinds)
            hashes = scrambled(keys)
            kept = {
                max(range(i, min(i + WINNOW, len(keys))), key=lambda j: (-int(hashes[j]), j))
                for i in range(max(1, len(keys) - WINNOW + 1))
                if len(keys)
            }
            for j in kept:
                places[int(keys[j])].append((t, j))
        self.keys = np.array(sorted(places), np.int64)
        self.places = [places[k] for k in self.keys.tolist()]

    def find(self, ids: np.ndarray, least: float) -> list[tuple[int, int, int, int]]:
        """(template, first word, last word, matched words) in a document's word numbers (0: not in any template)."""
        if len(ids) < GRAM or not len(self.keys):
            return []
        known = np.flatnonzero(ids[:-2].astype(bool) & ids[1:-1].astype(bool) & ids[2:].astype(bool))
        keys = (ids[known] * self.kinds + ids[known + 1]) * self.kinds + ids[known + 2]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hits = np.flatnonzero(self.keys[at] == keys)
        seeds = defaultdict(list)
        for place, k in zip(known[hits].tolist(), at[hits].tolist()):
            for template, j in self.places[k]:
                seeds[template].append(place - j)
        out = []
        for template, starts in seeds.items():
            words, last = self.words[template], None
            for start in sorted(set(starts)):
                if last is not None and start - last <= BAND:
                    continue  # within the band of the stretch already aligned
                last = start
                found = align(words, ids, start)
                if found and found[2] >= least * len(words):
                    out.append((template, *found))
        return sorted(set(out), key=lambda m: (m[1], m[0]))


def align(words: np.ndarray, ids: np.ndarray, start: int) -> tuple[int, int, int] | None:
    """(first, last, matched) of the best alignment of a template around the diagonal that begins at ``start``.

    Most matched words in order first, then the shortest stretch, then the earliest.
    """
    # best chains by diagonal offset: (matched, -first, last)
    empty = (0, 0, -1)
    row = [empty] * (2 * BAND + 1)
    n = len(ids)
    for j, w in enumerate(words.tolist()):
        fresh = []
        for o in range(2 * BAND + 1):
            i = start + j + o - BAND
            best = row[o]  # neither word used: same diagonal, one template word on
            if o + 1 <= 2 * BAND:
                best = max(best, row[o + 1], key=chain_order)  # a template word is missing in the document
            if o and fresh:
                best = max(best, fresh[-1], key=chain_order)  # a document word more
            if 0 <= i < n and ids[i] == w:
                behind = row[o]
                grown = (behind[0] + 1, behind[1] if behind[0] else i, i)
                best = max(best, grown, key=chain_order)
            fresh.append(best)
        row = fresh
    matched, first, last = max(row, key=chain_order)
    return (first, last, matched) if matched else None


def chain_order(chain: tuple[int, int, int]) -> tuple[int, int, int]:
    matched, first, last = chain
    return matched, first - last, -first


def template_blocks(templates: dict[str, str]):
    block, size = {}, 0
    for name, text in templates.items():
        words = len(words_of(text.encode()))
        if block and size + words > BLOCK_WORDS:
            yield TemplateIndex(block)
            block, size = {}, 0
        block[name] = text
        size += words
    yield TemplateIndex(block)


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """(doc_id, license, start, end, n_matched, coverage): a row for each matched stretch, in code points, end exclusive."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())

    def scanner(shared):
        def scan(batches):
            for batch in by_size(batches, "text", SLICE_BYTES):
                index = shared.value
                data, off = utf8_column(batch.column("text"))
                raw = data.tobytes()
                out = [[] for _ in range(6)]
                for r, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    words = words_of(raw[a:b])
                    ids = np.fromiter(map(index.vocabulary.get, words, repeat(0)), np.int64, len(words))
                    found = index.find(ids, coverage)
                    if not found:
                        continue
                    places = [m.span() for m in WORD.finditer(raw[a:b].decode().translate(LOWER))]
                    for template, first, last, matched in found:
                        row = (batch.column("doc_id")[r].as_py(), index.names[template], places[first][0], places[last][1],
                               matched, matched / len(index.words[template]))
                        for column, value in zip(out, row):
                            column.append(value)
                kinds = [batch.schema.field("doc_id").type, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                names = ["doc_id", "license", "start", "end", "n_matched", "coverage"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

        return scan

    passes = [
        rows.mapInArrow(
            scanner(docs.sparkSession.sparkContext.broadcast(index)),
            f"doc_id {kind}, license string, start long, end long, n_matched long, coverage double",
        )
        for index in template_blocks(templates)
    ]
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def op6_license_scan(spark, sf_dir):
    return scan_licenses(read_table(spark, sf_dir, "documents"))
