"""Licence scan with a positional index of rare words.

The index holds, for every licence word, the templates and positions it stands at. Of each
template only its words of highest IDF (counted over all documents) are looked up in a file; a hit at
place p of a word at position q proposes that the template starts at p - q. Proposals that
enough of the rare words agree on are verified: the template's mandatory phrase must stand there
word by word, and the share of its other words found in place is the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillwork.llm.shared import narrow
from tillwork.llm.words import Words, find_words, text_slices, word_hashes


@dataclass(frozen=True)
class Template:
    """A licence notice; its mandatory phrase is the words [key_from, key_to)."""

    label: str
    words: tuple[str, ...]
    key_from: int
    key_to: int
    base: bool = False

    @staticmethod
    def of(label: str, before: str, key: str, after: str = "", base: bool = False) -> Template:
        a, k, b = before.split(), key.split(), after.split()
        return Template(label, (*a, *k, *b), len(a), len(a) + len(k), base)


BASE = [
    Template.of("mit", "", "under the mit license", base=True),
    Template.of("apache-2", "", "apache license version 2", base=True),
    Template.of("cc-by-nc", "", "cc by nc", base=True),
]

# short notices of well-known licences: words before, the mandatory phrase, words after
TEMPLATES = [
    *BASE,
    Template.of("mit", "", "permission is hereby granted free of charge to any person obtaining a copy", "of this software and associated documentation files"),
    Template.of("apache-2", "licensed under the", "apache license version 2 0", "the license you may not use this file except in compliance with the license"),
    Template.of("apache-2", "", "www apache org licenses license 2 0"),
    Template.of("bsd", "", "redistribution and use in source and binary forms with or without modification", "are permitted provided that the following conditions are met"),
    Template.of("bsd", "under the", "bsd license"),
    Template.of("isc", "", "permission to use copy modify and or distribute this software for any purpose", "with or without fee is hereby granted"),
    Template.of("gpl-3", "this work is licensed under the", "gnu general public license version 3"),
    Template.of("gpl-2", "this work is licensed under the", "gnu general public license version 2"),
    Template.of("lgpl", "under the terms of the", "gnu lesser general public license"),
    Template.of("agpl-3", "under the terms of the", "gnu affero general public license"),
    Template.of("mpl-2", "this source code form is subject to the terms of the", "mozilla public license v 2 0"),
    Template.of("cc-by-nc", "this work is licensed under a", "creative commons attribution noncommercial"),
    Template.of("cc-by-sa", "licensed under", "cc by sa"),
    Template.of("cc-by-sa", "this work is licensed under a", "creative commons attribution sharealike"),
    Template.of("cc-by", "licensed under", "cc by 4 0"),
    Template.of("cc-by", "this work is licensed under a", "creative commons attribution 4 0 international license"),
    Template.of("unlicense", "this is", "free and unencumbered software released into the public domain"),
]

RARE_WORDS = 2  # rare words looked up of each template's mandatory phrase; both must be in place


def _wanted(templates: list[Template]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The licence words, their hashes in order, and the word of each hash."""
    vocabulary = sorted({w for t in templates for w in t.words})
    data = "\n".join(vocabulary).encode()
    found = find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    hashes = word_hashes(found)
    if [found.text(i).decode() for i in range(len(hashes))] != vocabulary:
        raise ValueError("template words must be single lower-case words")
    order = np.argsort(hashes)
    return vocabulary, hashes[order], order


def _licence_places(words: Words, known: np.ndarray, order: np.ndarray, vocabulary: list[bytes]) -> np.ndarray:
    """For every word the number of the licence word it is, or -1; equal hashes are compared byte by byte."""
    hashes = word_hashes(words)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[at] == hashes)
    number, start = order[at[hit]], words.start[hit]
    length = np.array([len(w) for w in vocabulary])
    same = length[number] == words.end[hit] - start
    for j, column in enumerate(zip(*[w.ljust(length.max(), b"\0") for w in vocabulary], strict=True)):
        long = np.flatnonzero(same & (length[number] > j))
        same[long] = words.data[start[long] + j] == np.array(column, np.uint8)[number[long]]
    out = np.full(len(hashes), -1, np.int32)
    out[hit[same]] = number[same]
    return out


def document_frequency(docs: DataFrame, templates: list[Template]) -> tuple[dict[str, int], int]:
    """In how many documents each licence word stands, and the number of documents, over all of them.

    Tasks return one row per licence word, whose number the templates fix.
    """
    vocabulary, known, order = _wanted(templates)
    names = [w.encode() for w in vocabulary]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(len(names), np.int64), 0
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                words = find_words(data, offsets)
                place = _licence_places(words, known, order, names)
                hit = np.flatnonzero(place >= 0)
                doc = np.searchsorted(words.first, hit, "right") - 1
                seen += np.bincount(np.unique(doc * len(names) + place[hit]) % len(names), minlength=len(names))
                rows += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(names)), -1], pa.int32()), pa.array([*seen, rows], pa.int64())], names=["word", "n"])

    sums = narrow(docs, "text").mapInArrow(count, "word int, n long").groupBy("word").agg({"n": "sum"}).collect()
    total = {w: n for w, n in sums}
    return {w: total.get(i, 0) for i, w in enumerate(vocabulary)}, total.get(-1, 0)


def rare_positions(template: Template, frequency: dict[str, int], rows: int, rare: int = RARE_WORDS) -> list[int]:
    """Positions of the mandatory phrase's words of highest IDF; ties go to the earlier position."""
    idf = [math.log((rows + 1) / (frequency[w] + 1)) for w in template.words]
    key = range(template.key_from, template.key_to)
    return sorted(sorted(key, key=lambda q: (-idf[q], q))[:rare])


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, rare: int = RARE_WORDS) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every document.

    n_base counts the places of base phrases, first_word and last_word are their least and
    greatest start (words from 0). labels are those of all templates whose mandatory phrase stands
    in the text; score is the largest share of such a template's words found in place, 0 without
    any. spans lists label, first word and share of every verified place. Null text counts as
    empty; whole texts are read; repeated rows are judged each; empty in, empty out.
    """
    frequency, rows = document_frequency(docs, templates)
    vocabulary, known, order = _wanted(templates)
    number = {w: i for i, w in enumerate(vocabulary)}
    names = [w.encode() for w in vocabulary]
    index: dict[int, list[tuple[int, int]]] = {}  # licence word to (template, position)
    for t, template in enumerate(templates):
        for q in rare_positions(template, frequency, rows, rare):
            index.setdefault(number[template.words[q]], []).append((t, q))
    needed = [len(rare_positions(t, frequency, rows, rare)) for t in templates]
    spelled = [np.array([number[w] for w in t.words], np.int32) for t in templates]

    def verified(place: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, template, first word (of the template, in the batch) and share of each true place."""
        found = []
        proposals: dict[int, list[np.ndarray]] = {}
        for word, postings in index.items():
            at = np.flatnonzero(place == word)
            for t, q in postings:
                proposals.setdefault(t, []).append(at - q)
        for t, starts in proposals.items():
            template, spelling = templates[t], spelled[t]
            start, votes = np.unique(np.concatenate(starts), return_counts=True)
            start = start[votes >= needed[t]]
            text = np.searchsorted(first, start + template.key_from, "right") - 1
            lo, hi = first[text], first[np.minimum(text + 1, len(first) - 1)]
            same = np.zeros((len(start), len(spelling)), bool)
            for q, word in enumerate(spelling):
                at = start + q
                inside = (at >= lo) & (at < hi)
                same[inside, q] = place[at[inside]] == word
            true = same[:, template.key_from : template.key_to].all(axis=1)
            found.append((text[true], np.full(true.sum(), t), start[true], same[true].mean(axis=1)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 4

    base, key_from = np.array([t.base for t in templates]), np.array([t.key_from for t in templates])
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first_word: long, share: double>>"
    )
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("share", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                words = find_words(data, offsets)
                text, kind, start, share = verified(_licence_places(words, known, order, names), words.first)
                columns: dict[str, list] = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
                by_text = np.argsort(text, kind="stable")
                edge = np.searchsorted(text[by_text], np.arange(part.num_rows + 1))
                for i in range(part.num_rows):
                    own = by_text[edge[i] : edge[i + 1]]
                    if not len(own):
                        for name, value in zip(columns, (0, None, None, "", "", 0.0, []), strict=True):
                            columns[name].append(value)
                        continue
                    at, basic = start[own] + key_from[kind[own]] - words.first[i], own[base[kind[own]]]
                    places = start[basic] - words.first[i]
                    columns["n_base"].append(len(basic))
                    columns["first_word"].append(int(places.min()) if len(basic) else None)
                    columns["last_word"].append(int(places.max()) if len(basic) else None)
                    columns["base_labels"].append(",".join(sorted({templates[k].label for k in kind[basic]})))
                    columns["labels"].append(",".join(sorted({templates[k].label for k in kind[own]})))
                    columns["score"].append(float(share[own].max()))
                    columns["spans"].append(sorted(({"label": templates[k].label, "first_word": int(p), "share": float(s)} for k, p, s in zip(kind[own], at, share[own], strict=True)), key=str))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))
                arrays = [pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(words.first), pa.int64()), *arrays],
                    names=["doc_id", "n_words", *columns],
                )

    return narrow(docs, "doc_id", "text").mapInArrow(scan, schema)
