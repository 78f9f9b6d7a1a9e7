"""License scans by templates with markup.

A template is plain license wording with optional regions ``[[ ... ]]`` and replaceable regions ``{{least-most}}`` (so
many words of any kind). It is compiled to an automaton over words: a state for each place between words, an empty
step around an optional region, a step on any word in a replaceable one. A text is accepted where the automaton gets
to its end, so mandatory wording must match exactly. Case (A-Z), punctuation and line breaks don't matter: words are
runs of digits, ASCII letters and characters beyond ASCII.

Automata start only where a template's opening words stand. All states advance together over a document's words, so
the work is bounded by the words times the states of the templates that start there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemerge.llm.base import query, table

# --- fixed values: base phrases and their labels
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# --- fixed values: license wording with optional and replaceable regions, and labels
TEMPLATES = {
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice [[including the next paragraph]] shall be included in all copies or substantial "
    "portions of the software [[the software is provided as is without warranty of any kind]]": "mit-text",
    "licensed under the apache license version 2 0 [[the license]]": "apache-2.0-notice",
    "this {{1-3}} is licensed under the gnu general public license version {{1-1}}": "gpl-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version {{1-1}} of the license or [[at your option]] "
    "any later version": "gpl-or-later-notice",
    "licensed under [[the]] [[creative commons]] cc by nc 4 0": "cc-by-nc-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc-text",
}

#: Words of a text: A-Z in lower case; digits, letters and all bytes beyond ASCII stay; the rest separates.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in b"".join(bytes([i]) for i in range(256)).lower())


@dataclass(frozen=True)
class Automaton:
    """``steps[state]`` has (word or None for any, next state); states include what empty steps reach."""
    label: str
    opening: tuple[bytes, ...]
    start: frozenset[int]
    steps: dict[int, tuple[tuple[bytes | None, frozenset[int]], ...]]
    end: int

    def accepts(self, words: list[bytes], at: int) -> int | None:
        """End of the longest match that starts at word ``at``."""
        states, best = self.start, None
        while True:
            if self.end in states:
                best = at
            if at == len(words):
                return best
            word = words[at]
            states = frozenset().union(*(to for s in states for w, to in self.steps.get(s, ()) if w is None or w == word))
            if not states:
                return best
            at += 1


def parsed(template: str) -> list:
    """The template as a list of words, (least, most) for a replaceable and a list for an optional region."""
    stack: list[list] = [[]]
    for piece in template.replace("[[", " [[ ").replace("]]", " ]] ").split():
        if piece == "[[":
            stack.append([])
        elif piece == "]]":
            region = stack.pop()
            stack[-1].append(region)
        elif m := re.fullmatch(r"\{\{(\d+)-(\d+)\}\}", piece):
            stack[-1].append((int(m[1]), int(m[2])))
        else:
            stack[-1].append(piece)
    if len(stack) != 1:
        raise ValueError(f"an optional region is not closed: {template}")
    return stack[0]


def compiled(template: str, label: str) -> Automaton:
    steps: dict[int, list[tuple[bytes | None, int]]] = {}
    empty: dict[int, set[int]] = {}
    count = 0

    def add(items: list, at: int) -> int:
        nonlocal count
        for item in items:
            if isinstance(item, list):
                end = add(item, at)
                empty.setdefault(at, set()).add(end)
                at = end
                continue
            least, most, word = (*item, None) if isinstance(item, tuple) else (1, 1, item.encode())
            skips = []
            for i in range(most):
                if i >= least:
                    skips.append(at)
                count += 1
                steps.setdefault(at, []).append((word, count))
                at = count
            for s in skips:
                empty.setdefault(s, set()).add(at)
        return at

    end = add(parsed(template), 0)

    def closed(state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in empty.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    start = closed(0)
    opening = {w for s in start for w, _ in steps.get(s, ())}
    if None in opening:
        raise ValueError(f"a template begins with a word of its own: {template}")
    return Automaton(label, tuple(sorted(opening)), start,
                     {s: tuple((w, closed(to)) for w, to in v) for s, v in steps.items()}, end)


@cache
def _automata() -> tuple[tuple[Automaton, ...], dict[bytes, list[Automaton]]]:
    made = tuple(compiled(t, label) for t, label in TEMPLATES.items())
    by_word: dict[bytes, list[Automaton]] = {}
    for a in made:
        for w in a.opening:
            by_word.setdefault(w, []).append(a)
    return made, by_word


@dataclass(frozen=True)
class Scan:
    n_words: int
    places: list[tuple[int, str]]
    matches: list[tuple[int, int, str]]

    @property
    def score(self) -> float:
        """0 without a finding, 0.5 for phrases alone, 1 if a whole template is accepted."""
        return 1.0 if self.matches else 0.5 if self.places else 0.0


def scan(text: str | None) -> Scan:
    """Base phrases (start, label) and accepted templates (start, end, label) of a whole text; null counts as empty."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    present = set(words)
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        if present.issuperset(parts):
            places += [(i, label) for i, w in enumerate(words) if w == parts[0] and words[i:i + len(parts)] == parts]
    _, by_word = _automata()
    openings = {w: by_word[w] for w in by_word.keys() & present if any(_possible(a, present) for a in by_word[w])}
    matches = []
    if openings:
        for i, w in enumerate(words):
            for a in openings.get(w, ()):
                if (end := a.accepts(words, i)) is not None:
                    matches.append((i, end, a.label))
    return Scan(len(words), places, matches)


@cache
def _mandatory(template: str) -> frozenset[bytes]:
    return frozenset(x.encode() for x in parsed(template) if isinstance(x, str))


def _possible(automaton: Automaton, present: set[bytes]) -> bool:
    return any(label == automaton.label and _mandatory(t) <= present for t, label in TEMPLATES.items())


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            found = scan(text.as_py())
            starts = [i for i, _ in found.places]
            base = {label for _, label in found.places}
            rows.append((found.n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                         ",".join(sorted(base | {label for *_, label in found.matches})), found.score))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], OUT)


OUT = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def scan_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for each row of ``docs``: words, base places with their smallest and largest start, labels, score.

    Null and empty texts have no words and empty labels; repeated rows stay; other columns are not read.
    """
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(_scanned, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                       "base_labels string, labels string, score double")


def _regex(items: list, spaced: bool = False) -> str:
    """The same wording as a regular expression over words, each with a space behind it."""
    out = ""
    for item in items:
        if isinstance(item, list):
            out += f"(?:{_regex(item)})?"
        elif isinstance(item, tuple):
            out += r"(?:[^ ]+ ){%d,%d}" % item
        else:
            out += item + " "
    return out


def _sql() -> str:
    labels = ", ".join(f"CASE WHEN regexp_matches(line, ' {_regex(parsed(t))}') THEN '{label}' END"
                       for t, label in TEMPLATES.items())
    places = " || ".join(
        "[{'i': i, 'label': '%s'} FOR i IN range(0, len(w)) IF %s]" % (
            label, " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(phrase.split())))
        for phrase, label in PHRASES.items())
    return rf"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
found AS (
  SELECT doc_id, w, {places} AS p,
    list_filter([{labels}], lambda x: x IS NOT NULL) AS more
  FROM (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS line FROM words)),
named AS (SELECT *, list_sort(list_distinct([x.label FOR x IN p])) AS base FROM found)
SELECT doc_id, len(w) AS n_words, len(p) AS n_base, list_min([x.i FOR x IN p]) AS first_word,
       list_max([x.i FOR x IN p]) AS last_word, array_to_string(base, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CASE WHEN len(more) > 0 THEN 1.0 WHEN len(p) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM named"""


@query("op4_license_scan", _sql())
def op4_license_scan(spark, folder):
    return scan_documents(table(spark, folder, "documents", "doc_id", "text"))
