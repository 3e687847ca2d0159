"""Licence scans: templates with markup, compiled into token automata.

A template is wording with two kinds of markup: ``[[ ... ]]`` may be missing, and ``{{a,b}}``
stands for a to b words of any kind (a name, a year, a clause that licensors reword). What is
left is mandatory: a text matches where its words equal the mandatory ones exactly, in order,
with only such gaps. A template becomes a nondeterministic automaton over words; its states are
the bits of one integer, so a step is a mask, a shift and the closure over optional regions.

Words of a text are hashed together and looked up in the templates' small vocabulary; automata
run only from places where the first two mandatory words of a template stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.tables import ready
from tidemark.llm.terms import folded, hashed
from tidemark.llm.texts import as_bytes, hashed_words

# Phrases that always count, and the label of each.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public licence wording with markup. A template begins with two mandatory words.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[the software]] "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
            "the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 [[the license]] you may not use this file except in compliance with the license "
                   "you may obtain a copy of the license at {{0,12}} unless required by applicable law or agreed to in writing software "
                   "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "licensed under the [[gnu]] [[lesser]] general public license"),
    ("gpl-2.0", "licensed under the gnu general public license [[as published by the free software foundation]] version 2"),
    ("gpl-3.0", "licensed under the gnu general public license [[as published by the free software foundation]] version 3"),
    ("gpl-2.0", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                "the free software foundation either version 2 of the license or [[at your option]] any later version"),
    ("gpl-3.0", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                "the free software foundation either version 3 of the license or [[at your option]] any later version"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
            "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
            "[[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
            "in the documentation and or other materials provided with the distribution [[3]] [[neither the name of {{1,12}} "
            "may be used to endorse or promote products derived from this software without specific prior written permission]]"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
            "the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license [[v]] [[version]] 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
             "arising from the use of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "licensed under [[a]] [[the]] cc0 [[1 0]]"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under [[a]] [[the]] cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[the]] cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under [[a]] [[the]] cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "licensed under [[a]] [[the]] cc by nc nd 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 [[international]] license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 [[international]] license"),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 [[international]] license"),
)

_MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+),(\d+)\}\}|[^\s\[\]{}]+")
#: Mandatory words of the longest accepted wording over these and so many more: the score.
DOUBT = 2


class MarkupError(ValueError):
    """A template whose regions do not nest, or that does not begin with two mandatory words."""


@dataclass
class Automaton:
    """State i stands before token i; a state's bit is set while it can be reached.

    ``enters[word]`` holds the states that the word takes to the next one, ``wild`` those that
    any word does. ``skips`` lists, from left to right, states from which another is reached
    without a word, so one pass over them is the closure.
    """

    label: str
    mandatory: int
    first: tuple[str, str]
    enters: dict[str, int]
    wild: int
    skips: list[tuple[int, int]]
    final: int

    @classmethod
    def of(cls, label: str, template: str) -> Automaton:
        tokens: list[str | None] = []
        skips: list[tuple[int, int]] = []
        opened: list[int] = []
        mandatory = 0
        for match in _MARKUP.finditer(template.lower()):
            mark = match[0]
            if mark == "[[":
                opened.append(len(tokens))
            elif mark == "]]":
                if not opened:
                    raise MarkupError(template)
                skips.append((opened.pop(), len(tokens)))
            elif match[1]:
                least, most = int(match[1]), int(match[2])
                end = len(tokens) + most
                skips += [(at, at + 1) for at in range(len(tokens) + least, end)]
                tokens += [None] * most
            else:
                tokens.append(mark)
                mandatory += not opened
        if opened or len(tokens) < 2 or None in tokens[:2] or any(at < 2 for at, _ in skips):
            raise MarkupError(template)
        enters: dict[str, int] = {}
        for at, token in enumerate(tokens):
            if token is not None:
                enters[token] = enters.get(token, 0) | 1 << at
        wild = sum(1 << at for at, token in enumerate(tokens) if token is None)
        return cls(label, mandatory, (tokens[0], tokens[1]), enters, wild, sorted(skips), 1 << len(tokens))

    def closed(self, states: int) -> int:
        for origin, target in self.skips:
            if states >> origin & 1:
                states |= 1 << target
        return states

    def accepts(self, words: Iterator[str | None]) -> bool:
        """Whether some beginning of ``words`` matches."""
        states = self.closed(1)
        for word in words:
            if states & self.final or not states:
                break
            states = self.closed((states & (self.enters.get(word, 0) | self.wild)) << 1)
        return bool(states & self.final)


class Scanner:
    """Compiled phrases and templates over one vocabulary."""

    def __init__(self, phrases: tuple[tuple[str, str], ...] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.phrases = [(phrase.split(), label) for phrase, label in phrases]
        self.automata = [Automaton.of(label, template) for label, template in templates]
        known = {word for words, _ in self.phrases for word in words}.union(*[automaton.enters for automaton in self.automata])
        words = sorted(known)
        keys = hashed([word.encode() for word in words])
        order = np.argsort(keys)
        self.keys, self.names = keys[order], [words[at] for at in order.tolist()] + [None]
        self.number = {word: at for at, word in enumerate(self.names) if word}

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary; its size for every other word."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, len(self.keys))

    def standing(self, words: list[str], numbers: np.ndarray) -> np.ndarray:
        """Where the words stand one after the other."""
        hit = np.ones(max(len(numbers) - len(words) + 1, 0), dtype=bool)
        for step, word in enumerate(words):
            hit &= numbers[step : step + len(hit)] == self.number[word]
        return np.flatnonzero(hit)

    def found(self, hashes: np.ndarray) -> tuple[list[np.ndarray], list[Automaton]]:
        """Places of each phrase, and the automata that accept a stretch of the text."""
        numbers = self.numbers(hashes)
        if (numbers == len(self.keys)).all():
            return [np.zeros(0, dtype=np.int64)] * len(self.phrases), []
        base = [self.standing(words, numbers) for words, _ in self.phrases]
        starts: dict[tuple[str, str], list[int]] = {}
        accepted = []
        for automaton in self.automata:
            if automaton.first not in starts:
                starts[automaton.first] = self.standing(list(automaton.first), numbers).tolist()
            if any(automaton.accepts(self._spoken(numbers, start)) for start in starts[automaton.first]):
                accepted.append(automaton)
        return base, accepted

    def _spoken(self, numbers: np.ndarray, start: int) -> Iterator[str | None]:
        return (self.names[number] for number in numbers[start:])


_COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of all phrases, the first and last of which start at
    ``first_word`` and ``last_word`` (from 0, null without one). ``base_labels`` are theirs;
    ``labels`` adds those of the templates that the text matches; both are distinct, sorted and
    joined by commas, empty without one. ``score`` is m / (m + DOUBT) for the m mandatory words
    of the longest phrase or template found, 0 without one.

    A null or empty text has no words. Repeated rows are scanned each; other columns are not
    read; an empty table gives an empty table.
    """
    ready(docs.sparkSession)
    scanner = scanner or Scanner()
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema(
        [("doc_id", to_arrow_type(kind)), *[(name, pa.int64()) for name in ("n_words", "n_base", "first_word", "last_word")]]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    )

    def row(hashes: np.ndarray) -> tuple:
        base, accepted = scanner.found(hashes)
        places = np.concatenate(base)
        held = [(label, len(words)) for (words, label), at in zip(scanner.phrases, base, strict=True) if len(at)]
        longest = max([size for _, size in held] + [automaton.mandatory for automaton in accepted], default=0)
        edges = (int(places.min()), int(places.max())) if len(places) else (None, None)
        labels = {label for label, _ in held}
        listed = [",".join(sorted(some)) for some in (labels, labels | {automaton.label for automaton in accepted})]
        return len(hashes), len(places), *edges, *listed, longest / (longest + DOUBT)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (folded(text) for text in as_bytes(batch.column("text")))
            rows = [row(hashes) for _, (group,) in hashed_words(texts) for hashes in group]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)] if rows else [pa.array([], f.type) for f in list(schema)[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(scanned, f"doc_id {kind.simpleString()}, {_COLUMNS}")
