"""License notices: fixed phrases, and an exact containment join with license templates.

A text block is a line, or a window of as many words as the template has, over all of a
text's words and so across line ends: wrapped notices are found there. A template is found
in a block that holds at least CONTAINMENT of the template's distinct words, and the word
that names the license where the template has it. For lines, the join orders words by how many blocks of the whole corpus
hold them, rarest first; a block that reaches the threshold must share a word with the
template's prefix (prefix filter), have enough distinct words (length filter), and enough
words left on both sides behind the shared one (positional filter). What passes is counted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, small_batches, text_slices

CONTAINMENT = 0.8
#: Phrases that count as base places, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Openings of public license texts and usual notices, with their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("proprietary", "All rights reserved"),
]
#: The word that tells a label's templates from other licenses' notices of the same form.
NAMING = {"mit": "mit", "cc-by-nc": "nc", "apache-2": "apache", "gpl": "gnu", "mpl-2": "mozilla"}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found array<struct<template:int,label:string,line:long,overlap:int,containment:double>>, wrapped array<struct<template:int,label:string,first_word:long,last_word:long,overlap:int,containment:double>>"


def words_of(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and characters beyond ASCII, after A-Z are lower-cased."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class TemplateIndex:
    """Templates as word sets in global order, with an index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], containment: float, naming: dict[str, str] | None = None):
        self.order = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in words_of(t)}, key=lambda w: (counts.get(w, 0), w)))}
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(set(words_of(t)), key=self.order.__getitem__) for _, t in templates]
        self.need = [math.ceil(containment * len(s) - 1e-9) for s in self.sets]
        self.length = [len(words_of(t)) for _, t in templates]
        self.must = [{(naming or {}).get(label, "").encode()}.intersection(s) for label, s in zip(self.labels, self.sets, strict=True)]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for k, (s, need) in enumerate(zip(self.sets, self.need, strict=True)):
            for i, w in enumerate(s[: len(s) - need + 1]):
                self.prefix.setdefault(w, []).append((k, i))

    def matches(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(template, overlap) of all templates that this block's words contain."""
        distinct = set(words)
        shared = distinct & self.prefix.keys()
        if not shared:
            return []
        place = {w: j for j, w in enumerate(sorted(distinct & self.order.keys(), key=self.order.__getitem__))}
        tried: set[int] = set()
        out = []
        for w in sorted(shared, key=self.order.__getitem__):
            for k, i in self.prefix[w]:
                if k in tried:
                    continue
                tried.add(k)  # w is the rarest shared word, so nothing before it counts
                s, need = self.sets[k], self.need[k]
                if len(distinct) < need or min(len(s) - i, len(distinct) - place[w]) < need:
                    continue
                if (overlap := sum(x in distinct for x in s)) >= need and self.must[k] <= distinct:
                    out.append((k, overlap))
        return sorted(out)

    def windows(self, words: list[bytes], line_of: Callable[[], list[int]]) -> list[tuple[int, int, int, int]]:
        """(template, first word, last word, overlap) of windows over more than one line that hold a template.

        Windows start and end at words of the template. Of windows that share words the one
        of the largest overlap stays, of equal ones the shortest and then the first; where it
        stands on one line, matches() has it.
        """
        distinct = set(words)
        out = []
        for k, (s, need) in enumerate(zip(self.sets, self.need, strict=True)):
            if not need or sum(x in distinct for x in s) < need or not self.must[k] <= distinct:
                continue
            kept = frozenset(s)
            at = [i for i, w in enumerate(words) if w in kept]
            inside: Counter[bytes] = Counter()
            left, reach, best = 0, -1, None
            for i in at:
                inside[words[i]] += 1
                while i - at[left] >= self.length[k] or inside[words[at[left]]] > 1:
                    w = words[at[left]]
                    inside[w] -= 1
                    if not inside[w]:
                        del inside[w]
                    left += 1
                if len(inside) < need or any(w not in inside for w in self.must[k]):
                    continue
                here = (-len(inside), i - at[left], at[left])
                if best and at[left] > reach:
                    out.append((k, best[2], best[2] + best[1], -best[0]))
                    best = None
                best, reach = min(best or here, here), i
            if best:
                out.append((k, best[2], best[2] + best[1], -best[0]))
        lines = line_of() if out else []
        return [x for x in out if lines[x[1]] != lines[x[2]]]


def _block_counter(vocabulary: frozenset[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            texts = batch.column(0)
            for text in (t for lo, n in text_slices(texts) for t in texts.slice(lo, n).to_pylist()):
                whole = (text or "").encode("utf-8", "surrogatepass").lower()
                if vocabulary.isdisjoint(_WORD.findall(whole)):
                    continue
                for line in whole.split(b"\n"):
                    total.update(vocabulary.intersection(_WORD.findall(line)))
            give_back()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    return count


def _scanner(index: TemplateIndex, phrases: dict[str, str]):
    needles = [(f" {p} ".encode(), label) for p, label in phrases.items()]

    def scan(text: str | None) -> dict:
        whole = (text or "").encode("utf-8", "surrogatepass").lower()
        words = _WORD.findall(whole)
        joined = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for needle, label in needles:
            at = joined.find(needle)
            while at >= 0:
                places.append(joined.count(b" ", 0, at))
                base.add(label)
                at = joined.find(needle, at + 1)
        found, wrapped = [], []
        if not index.prefix.keys().isdisjoint(words):
            lines = [_WORD.findall(line) for line in whole.split(b"\n")]
            for n, line in enumerate(lines):
                for k, overlap in index.matches(line):
                    found.append({"template": k, "label": index.labels[k], "line": n, "overlap": overlap, "containment": overlap / len(index.sets[k])})
            if len(lines) > 1:
                for k, first, last, overlap in index.windows(words, lambda: [n for n, line in enumerate(lines) for _ in line]):
                    wrapped.append({"template": k, "label": index.labels[k], "first_word": first, "last_word": last, "overlap": overlap, "containment": overlap / len(index.sets[k])})
        return {
            "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {f["label"] for f in found + wrapped})),
            "score": max([1.0] * bool(places) + [f["containment"] for f in found + wrapped], default=0.0), "found": found, "wrapped": wrapped,
        }

    return scan


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None, containment: float = CONTAINMENT, naming: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of docs: id and OUT, found holding every line and template at or over the threshold,
    wrapped the places of templates that go over line ends. naming is NAMING for TEMPLATES, else nothing.

    Null text counts as empty: no words, no labels (empty strings), score 0. Score is 1 where
    a phrase stands, else the largest containment found. Repeated rows give repeated rows.
    """
    naming = NAMING if templates is None and naming is None else naming
    templates = TEMPLATES if templates is None else templates
    small_batches(docs.sparkSession)
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))
    counted = docs.select(text_col).mapInArrow(_block_counter(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {bytes(r["word"]): r["n"] for r in counted.collect()}  # a row for each template word at most
    scan = _scanner(TemplateIndex(templates, counts, containment, naming), PHRASES if phrases is None else phrases)
    kind = docs.schema[id_col].dataType.simpleString()
    cols = [c.split()[0] for c in OUT.split(" array")[0].replace(" found", "").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("line", pa.int64()), ("overlap", pa.int32()), ("containment", pa.float64())]))
        wrapped = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("overlap", pa.int32()), ("containment", pa.float64())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), found, wrapped]
        for batch in batches:
            texts = batch.column("t")
            rows = [scan(t) for lo, n in text_slices(texts) for t in texts.slice(lo, n).to_pylist()]
            give_back()
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], k) for c, k in zip([*cols, "found", "wrapped"], kinds, strict=True))], [id_col, *cols, "found", "wrapped"])

    return docs.select(F.col(id_col), F.col(text_col).alias("t")).mapInArrow(run, f"{id_col} {kind}, {OUT}")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found", "wrapped")


def _sql() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    rows = [(k, label, words_of(t)) for k, (label, t) in enumerate(TEMPLATES)]
    must = {k: NAMING[label] if NAMING.get(label, "").encode() in ws else "" for k, label, ws in rows}
    values = ", ".join(f"({k}, '{label}', '{w.decode()}', {len(set(ws))}, {math.ceil(CONTAINMENT * len(set(ws)) - 1e-9)}, {len(ws)}, '{must[k]}')" for k, label, ws in rows for w in sorted(set(ws)))
    phrases = ", ".join(f"(['{"', '".join(p.split())}'], '{label}')" for p, label in PHRASES.items())
    return f"""
WITH d AS (SELECT doc_id, {low} AS t, {words.format(low)} AS w FROM documents),
ph(p, label) AS (VALUES {phrases}),
places AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d WHERE len(w) > 0) x JOIN ph ON list_slice(x.w, i + 1, i + len(p)) = p),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY doc_id),
tw(k, label, word, n, need, size, must) AS (VALUES {values}),
lines AS (SELECT doc_id, line, list_distinct({words.format("l")}) AS w FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS line FROM d)),
hits AS (SELECT doc_id, k, label, n, count(*) AS overlap FROM (SELECT doc_id, line, unnest(w) AS word FROM lines) JOIN tw USING (word) GROUP BY doc_id, line, k, label, n, need, must HAVING count(*) >= need AND (must = '' OR bool_or(word = must))),
known AS (SELECT doc_id, i, k, label, word, n, need, size, must FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d) JOIN tw USING (word)),
likely AS (SELECT x.* FROM known x SEMI JOIN (SELECT doc_id, k FROM known GROUP BY doc_id, k, need HAVING count(DISTINCT word) >= need) y ON x.doc_id IS NOT DISTINCT FROM y.doc_id AND x.k = y.k),
windows AS (SELECT a.doc_id, a.k, a.label, a.n, count(DISTINCT b.word) AS overlap FROM likely a JOIN likely b ON a.doc_id = b.doc_id AND a.k = b.k AND b.i BETWEEN a.i AND a.i + a.size - 1
  GROUP BY a.doc_id, a.k, a.label, a.n, a.need, a.must, a.i HAVING count(DISTINCT b.word) >= a.need AND (a.must = '' OR bool_or(b.word = a.must))),
labelled AS (SELECT doc_id, label, 1 AS is_base, 1.0::DOUBLE AS s FROM places UNION ALL SELECT doc_id, label, 0, overlap::DOUBLE / n FROM (SELECT doc_id, label, overlap, n FROM hits UNION ALL SELECT doc_id, label, overlap, n FROM windows)),
agg AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base = 1) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(s) AS score FROM labelled GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN agg USING (doc_id)
"""


OP4_SQL = _sql()
