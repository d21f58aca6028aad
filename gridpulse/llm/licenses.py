"""License scan: sparse TF-IDF cosine to license templates, then inheritance from the nearest directory above.

Every sentence, every line, every window of up to `WINDOW_LINES` consecutive lines and every whole text is compared with the notices below; every
whole text also with the license texts in `license_texts`.  Term weights are inverse document frequencies
over all documents; terms of no template weigh as if no document had them.  A sentence, line or window that is close enough to a notice is a
*header* and licenses its document; a whole text that is close to a notice or a license text is a *license file* and licenses its directory too.
Comment marks are no terms, and lines without terms do not count, so a notice may be wrapped and commented out.

There are license texts of Apache, MIT, ISC, BSD (two and three clauses), GPL, LGPL, MPL, CC0, Artistic and GFDL.  That of AGPL-3.0 is derived
from GPL-3.0 by its name.  The CC BY family has notices only.

A document without a license of its own takes that of the nearest directory above it that has a license file: its path is cut
into its directories, these are joined with the licensed directories, and the deepest match wins.

Scale: documents are scanned twice (weights, then matches) and not shuffled.  Only paths are: one row per document and directory level, joined by
directory; licensed directories are summed to one row each before.  Most segments are left out by vectorised bounds on their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.decontamination import SEPARATOR
from gridpulse.llm.words import LOWER, slices, word_hashes, words

LEAST_COSINE = 0.6
#: The most lines that a wrapped notice is looked for in.
WINDOW_LINES = 6

#: Names of licenses and the notices by which they are stated, one template per notice.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def license_texts() -> tuple[tuple[str, str], ...]:
    """(name, text) of whole licenses, read where the plan is built."""
    found = {p.stem: p.read_text(encoding="utf-8") for p in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))}
    agpl = found["GPL-3.0"]
    for old, new in (("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC"), ("GNU General Public", "GNU Affero General Public"), ("GNU GPL", "GNU AGPL")):
        agpl = agpl.replace(old, new)
    return (*found.items(), ("AGPL-3.0", agpl))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes, where each text's begin, and for each term its line and its sentence (numbers that only rise)."""
    lowered = LOWER[data]
    begin, end, bounds = words(lowered, offsets, SEPARATOR)
    newline = data == 10
    blank = newline | (data == 32)
    stop = np.zeros(len(data), bool)
    stop[:-1] = (data[:-1] == 46) & blank[1:]
    line = np.cumsum(newline)[begin] if len(begin) else np.empty(0, np.int64)
    sentence = line + (np.cumsum(stop)[begin] if len(begin) else 0)
    return word_hashes(lowered, begin, end), bounds, line, sentence


def _places(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Position of each hash in the sorted terms, -1 where it is none."""
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


class Templates:
    """The templates as sparse vectors over their own terms."""

    def __init__(self, templates=TEMPLATES):
        raw = [t.encode() for _, t in templates]
        hashes, bounds, _, _ = _tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        self.names = [n for n, _ in templates]
        self.terms, which = np.unique(hashes, return_inverse=True)
        self.counts = np.zeros((len(raw), len(self.terms)))
        np.add.at(self.counts, (np.repeat(np.arange(len(raw)), np.diff(bounds)), which), 1)
        self.weights, self.other = np.ones(len(self.terms)), 1.0

    def weigh(self, documents: int, having: dict[int, int]) -> None:
        """Set term weights from document frequencies (by the term's hash)."""
        df = np.array([having.get(t, 0) for t in self.terms.tolist()])
        self.weights, self.other = np.log((documents + 2) / (df + 1)), float(np.log(documents + 2))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Position of each term among the templates' terms, -1 for others."""
        return _places(self.terms, hashes)

    def best(self, places: np.ndarray, segment: np.ndarray, n: int, least: float, width: int = 1, owner: np.ndarray | None = None) -> Iterator[tuple[int, float, str]]:
        """(segment, cosine, name) of the segments close enough to a template; segments are numbered 0 … n-1.

        With a width, of `width` segments in a row that have the same owner, named by the first.
        """
        known = places >= 0
        squares = np.bincount(segment[known], weights=self.weights[places[known]] ** 2, minlength=n)
        others = np.bincount(segment[~known], minlength=n) * self.other**2
        terms = np.bincount(segment[known], minlength=n)
        first = np.arange(n)
        if width > 1:
            if n < width:
                return
            squares, others, terms = (np.diff(np.r_[0, np.cumsum(c)][np.add.outer(first[: n - width + 1], (0, width))], axis=1)[:, 0] for c in (squares, others, terms))
            first = first[: n - width + 1][owner[: n - width + 1] == owner[width - 1 :]]
            squares, others, terms = squares[first], others[first], terms[first]
        # repeated known terms weigh more than their squares: their true part is largest if all of them are one term
        most = squares * np.maximum(terms, 1)
        hopeful = np.flatnonzero((squares > 1e-9) & (most >= least**2 * (most + others) * (1 - 1e-9)))
        vectors = self.counts * self.weights
        norms = np.linalg.norm(vectors, axis=1)
        for s in first[hopeful]:
            a, b = np.searchsorted(segment, [s, s + width])
            own = places[a:b]
            v = np.bincount(own[own >= 0], minlength=len(self.terms)) * self.weights
            unknown = np.count_nonzero(own < 0) * self.other**2
            # the part along known terms bounds every cosine
            inside = v @ v
            if inside < least**2 * (inside + unknown):
                continue
            cosine = vectors @ v / (norms * np.sqrt(inside + unknown) + 1e-12)
            k = int(np.argmax(cosine))
            if cosine[k] >= least:
                yield int(s), float(cosine[k]), self.names[k]


def fitted(docs: DataFrame, templates=TEMPLATES) -> tuple[Templates, Templates]:
    """Notices and license texts, weighed by the document frequencies of their terms over all documents."""
    model = Templates(templates), Templates(license_texts())
    terms = np.union1d(*(m.terms for m in model))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                hashes, bounds, _, _ = _tokens(data, offsets)
                place = _places(terms, hashes)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
                pairs = np.unique(text[place >= 0] * len(terms) + place[place >= 0])
                total += np.bincount(pairs % len(terms), minlength=len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    documents, having = docs.count(), {int(terms[r.term]): r.n for r in rows}
    for m in model:
        m.weigh(documents, having)
    return model


def own_licenses(docs: DataFrame, model: tuple[Templates, Templates], least: float = LEAST_COSINE) -> DataFrame:
    """(doc_id, path, license, cosine, origin) of all documents: the best match of any of their segments, null without one.

    `origin` is "file" where the whole text is a license, otherwise "header".  Of equal matches the earlier template counts.
    """
    notices, whole = model
    kind = docs.schema["doc_id"].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found: list = [(None, None, None)] * batch.num_rows
            for first, data, offsets in slices(batch.column(2)):
                hashes, bounds, line, sentence = _tokens(data, offsets)
                place = notices.places(hashes)
                n = len(offsets) - 1
                text = np.repeat(np.arange(n), np.diff(bounds))
                matches = []
                for width, segment in ((1, sentence), *((w, line) for w in range(1, WINDOW_LINES + 1))):
                    heads = np.r_[True, (np.diff(segment) != 0) | (np.diff(text) != 0)][: len(text)]
                    owner = text[heads]
                    for s, cosine, name in notices.best(place, np.cumsum(heads) - 1, len(owner), least, width, owner):
                        matches.append(("header", owner[s], cosine, name))
                for templates, places in ((notices, place), (whole, whole.places(hashes))):
                    for s, cosine, name in templates.best(places, text, n, least):
                        matches.append(("file", s, cosine, name))
                for origin, s, cosine, name in matches:
                    at = first + int(s)
                    if found[at][1] is None or (origin, found[at][2]) == ("file", "header") or cosine > found[at][1]:
                        found[at] = (name, cosine, origin)
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else ((), (), ()), (pa.string(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "path", "license", "cosine", "origin"])

    return docs.select("doc_id", F.col("path").cast("string"), "text").mapInArrow(batches, f"doc_id {kind}, path string, license string, cosine double, origin string")


def licenses(docs: DataFrame, model: tuple[Templates, Templates], least: float = LEAST_COSINE) -> DataFrame:
    """`own_licenses` with inheritance: origin "inherited" and the directory in `directory` where a document has none of its own.

    Paths are split at "/"; a null path has no directory.  Of several license files in one directory the closest match counts,
    ties by name.  Documents that find nothing keep nulls.
    """
    own = own_licenses(docs, model, least)
    parts = F.split("path", "/")
    parent = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    files = own.where("origin = 'file' and path is not null").withColumn("directory", parent)
    named = files.groupBy("directory").agg(F.max_by("license", F.struct("cosine", "license")).alias("directory_license"))
    rows = own.withColumn("row", F.monotonically_increasing_id())
    bare = rows.where("license is null and path is not null").select("row", F.explode(F.sequence(F.lit(0), F.size(parts) - 1)).alias("depth"), parts.alias("parts"))
    above = bare.select("row", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("directory"))
    nearest = above.join(named, "directory").groupBy("row").agg(F.max_by(F.struct("directory", "directory_license"), "depth").alias("up"))
    joined = rows.join(nearest, "row", "left")
    license_ = F.coalesce("license", "up.directory_license").alias("license")
    origin = F.when(F.col("license").isNotNull(), F.col("origin")).when(F.col("up").isNotNull(), "inherited").alias("origin")
    return joined.select("doc_id", "path", license_, "cosine", origin, F.col("up.directory").alias("directory"))
