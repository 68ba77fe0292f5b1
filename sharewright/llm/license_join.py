"""License scan: exact set-similarity join of text blocks with license templates.

Blocks are sentences of lines; a block matches a template when at least ``threshold`` of the template's distinct words
occur in it. Word frequencies over the blocks of the whole corpus order the words (rarest first); prefix, length and
positional filters then find every match. Templates are a parameter: their words and their frequencies are bounded by it,
so the join needs no shuffle of texts.

A sentence wrapped over lines (or cut at ``;``) is matched too: its words are looked up together, and a template met only
that way counts if a window of half as many words again as the template has meets it. So words strewn over long lines or
lists are no notice. Blank lines and ``.!?`` end a sentence.

Null text counts as empty: no words, no labels, score 0. Repeated rows are judged one by one; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK = re.compile(r"\n|[.!?;](?=[ \t\r\n]|$)")
THRESHOLD = 0.9
#: Half template lengths in a window over wrapped lines.
WINDOW = 3

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Templates of the method: label, text of the block.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under the creative commons attribution license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "copyright all rights reserved"),
]

#: doc_id crosses as a string: a column of numbers with nulls would become floating point on the Python side.
SCHEMA = ("doc_id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_blocks long")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(ASCII_LOWER))


def sentences_of(text: str | None) -> Iterator[list[list[str]]]:
    """Sentences as lists of their blocks' words, in order."""
    lowered = (text or "").translate(ASCII_LOWER)
    sentence, line_has_words, at = [], False, 0
    while at <= len(lowered):
        cut = BLOCK.search(lowered, at)
        words = WORD.findall(lowered, at, cut.start() if cut else len(lowered))
        if words:
            sentence.append(words)
            line_has_words = True
        sign = cut.group() if cut else None
        if sentence and (sign not in ("\n", ";") or sign == "\n" and not line_has_words):
            yield sentence
            sentence = []
        if cut is None:
            return
        if sign == "\n":
            line_has_words = False
        at = cut.end()


def blocks_of(text: str | None) -> Iterator[frozenset]:
    """Word sets of the blocks of a text."""
    for sentence in sentences_of(text):
        yield from map(frozenset, sentence)


def base_places(words: list[str], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(word number, label) of every place where the words of a phrase stand consecutively."""
    heads: dict[str, list] = {}
    for phrase, label in phrases.items():
        parts = phrase.split(" ")
        heads.setdefault(parts[0], []).append((parts, label))
    return [(i, label) for i, w in enumerate(words) if w in heads
            for parts, label in heads[w] if words[i:i + len(parts)] == parts]


class TemplateIndex:
    """Prefix index of the templates under one global word order (rarest first)."""

    def __init__(self, templates, frequency: dict[str, int], threshold: float):
        vocabulary = sorted({w for _, text in templates for w in words_of(text)})
        order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.templates, self.prefix = [], {}
        for label, text in templates:
            tokens = sorted({self.rank[w] for w in words_of(text)})
            if not tokens:
                continue
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            number = len(self.templates)
            self.templates.append((label, frozenset(tokens), need, len(words_of(text))))
            for place in range(len(tokens) - need + 1):
                self.prefix.setdefault(tokens[place], []).append((number, place, len(tokens), need))
        self.least = min((need for _, _, need, _ in self.templates), default=1)

    def matches(self, block: frozenset) -> dict[int, float]:
        """Number and containment of every template met by the block."""
        rank = self.rank
        mine = sorted(rank[w] for w in block if w in rank)
        if len(mine) < self.least:
            return {}
        seen: dict[int, bool] = {}
        for j, token in enumerate(mine):
            for number, place, length, need in self.prefix.get(token, ()):
                # the first shared word of a pair decides; words behind it bound what can still be shared
                if number not in seen:
                    seen[number] = len(mine) >= need and 1 + min(length - place - 1, len(mine) - j - 1) >= need
        have = set(mine)
        out = {}
        for number, alive in seen.items():
            if alive:
                _, tokens, need, _ = self.templates[number]
                shared = len(tokens & have)
                if shared >= need:
                    out[number] = shared / len(tokens)
        return out

    def wrapped(self, sentence: list[list[str]], number: int) -> float:
        """Largest containment of a template in a window of the sentence's words; 0 if no window meets it."""
        _, tokens, need, length = self.templates[number]
        ranks = [self.rank.get(w) for block in sentence for w in block]
        inside, best, width = Counter(), 0, length * WINDOW // 2
        for i, rank in enumerate(ranks):
            if rank in tokens:
                inside[rank] += 1
            gone = ranks[i - width] if i >= width else None
            if gone in tokens:
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
            best = max(best, len(inside))
        return best / len(tokens) if best >= need else 0.0


def word_frequencies(docs: DataFrame, vocabulary: frozenset) -> dict[str, int]:
    """Blocks of the whole corpus that hold each template word; at most one row per template word."""
    def count(batches):
        total = Counter()
        for batch in batches:
            for text in batch["text"]:
                lowered = text or ""
                for block in BLOCK.split(lowered.translate(ASCII_LOWER)):
                    total.update(vocabulary.intersection(WORD.findall(block)))
        yield pd.DataFrame({"word": list(total), "n": list(total.values())}, columns=["word", "n"]).astype({"word": "object", "n": "int64"})

    rows = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").sum("n").collect()
    return {r[0]: r[1] for r in rows}


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document; ``labels`` joins the phrase labels and the labels of all templates met."""
    vocabulary = frozenset(w for _, text in templates for w in words_of(text))
    index = TemplateIndex(templates, word_frequencies(docs, vocabulary), threshold)

    def scan(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                base = base_places(words, phrases)
                labels, score, n_blocks = {label for _, label in base}, 1.0 if base else 0.0, 0
                base_labels = ",".join(sorted(labels))
                for sentence in sentences_of(text):
                    alone = [index.matches(frozenset(block)) for block in sentence]
                    found = [(number, part) for met in alone for number, part in met.items()]
                    n_blocks += sum(map(bool, alone))
                    if len(sentence) > 1:
                        met = {number for number, _ in found}
                        together = [(number, index.wrapped(sentence, number))
                                    for number in index.matches(frozenset().union(*sentence))]
                        together = [(number, part) for number, part in together if part]
                        n_blocks += any(number not in met for number, _ in together)
                        found += together
                    for number, part in found:
                        labels.add(index.templates[number][0])
                        score = max(score, part)
                rows.append((doc_id, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                             base_labels, ",".join(sorted(labels)), score, n_blocks))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "labels", "score", "n_blocks"]).astype(
                {"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(scan, SCHEMA).withColumn(
        "doc_id", F.col("doc_id").cast("long"))
