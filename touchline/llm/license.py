"""Licence scans: notices and identifier tags by one Aho-Corasick pass, licence expressions by a shunting-yard parser.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z, so every other byte separates. The automaton
runs over the words joined by single spaces and reports phrases whose words stand consecutively, wherever they are. Base phrases give
the base labels and places; the notices below and ``SPDX-License-Identifier:`` tags add labels of the method.

A tag's expression is the longest valid one that begins behind the tag, on its line: identifiers, ``AND``, ``OR``, ``WITH`` and parentheses, ``WITH``
binding strongest and ``OR`` weakest. What cannot continue it ends it, as a comment closer, a full stop behind a name or running text do. It is evaluated by how freely a text may be used (``FREEDOM``): ``AND`` takes the smaller, ``OR`` the
larger value, ``WITH`` an exception adds ``EXCEPTION``. A tag without a valid expression counts as ``UNKNOWN`` and adds no label. A document's score is
the smallest value of its base labels, notices and expressions (names inside an expression are no notices), and 0 where nothing was found. A null text counts as empty: no words, no places,
null first and last word, empty labels, score 0. Each row is judged for itself, repeated rows included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the contract.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of well-known licences, in words.
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit",
    "apache license": "apache", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "isc license": "isc", "cc0": "cc0", "public domain": "public-domain", "the unlicense": "unlicense",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "creative commons attribution": "cc-by",
}
TAG = "spdx license identifier"
#: How freely texts under a label may be used.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "apache": 0.9, "cc-by": 0.9,
    "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}
UNKNOWN = 0.5
EXCEPTION = 0.2

_WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_TABLE = bytes(_WORD_BYTES[c] for c in range(256)).lower()
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+|\S")
_TAG = re.compile(r"spdx-license-identifier:", re.IGNORECASE)
_TAG_TOKEN = re.compile(rf"[\r\n]|{_TOKEN.pattern}")
_PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}


def family(identifier: str) -> str | None:
    """Label of a licence identifier by its longest known beginning, as ``Apache-2.0`` gives ``apache``."""
    name = identifier.lower().rstrip("+")
    fits = [label for label in FREEDOM if name == label or name.startswith(f"{label}-")]
    return max(fits, key=len, default=None)


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the expression in postfix order, or None if it is malformed."""
    output: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        word = token.upper()
        if token == "(" and operand_next:
            held.append(token)
        elif token == ")" and not operand_next:
            while held and held[-1] != "(":
                output.append(held.pop())
            if not held:
                return None
            held.pop()
        elif word in _PRECEDENCE and not operand_next:
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[word]:
                output.append(held.pop())
            held.append(word)
            operand_next = True
        elif operand_next and word not in _PRECEDENCE and re.match(r"[A-Za-z0-9]", token):
            output.append(token)
            operand_next = False
        else:
            return None
    if operand_next or "(" in held:
        return None
    return output + held[::-1]


def expression_after(text: str, start: int) -> tuple[str, int]:
    """The longest valid expression from ``start`` on, within the line, and where it ends; empty if there is none."""
    tokens: list[str] = []
    valid, stop, depth, operand_next = 0, start, 0, True
    for match in _TAG_TOKEN.finditer(text, start):
        token = match[0]
        name = token.rstrip(".:-")
        word = name.upper()
        if token in ("(", ")"):
            if (token == "(") != operand_next or (token == ")" and not depth):
                break
            depth += 1 if token == "(" else -1
        elif word in _PRECEDENCE:
            if operand_next or name != token:
                break
            operand_next = True
        elif operand_next and re.match(r"[A-Za-z0-9]", name):
            operand_next = False
        else:
            break
        tokens.append(name)
        if not operand_next and not depth:
            valid, stop = len(tokens), match.end()
        # A full stop or comment closer behind a name.
        if name != token:
            break
    return " ".join(tokens[:valid]), stop


def evaluated(expression: str) -> tuple[float, set[str]]:
    """Freedom of an expression and the labels of its licences."""
    order = postfix(expression)
    if order is None:
        return UNKNOWN, set()
    stack: list[float] = []
    labels: set[str] = set()
    exceptions = {i - 1 for i, token in enumerate(order) if token == "WITH"}
    for i, token in enumerate(order):
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append({"AND": min(left, right), "OR": max(left, right), "WITH": min(1.0, left + EXCEPTION)}[token])
        else:
            label = None if i in exceptions else family(token)
            if label:
                labels.add(label)
            stack.append(FREEDOM.get(label, UNKNOWN))
    return stack[0], labels


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in (*BASE, *NOTICES, TAG):
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scanned(text: str | None, phrases: ahocorasick.Automaton) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score`` of one text."""
    words = (text or "").encode().translate(_TABLE).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    tagged = False
    # Spaces are counted on (or back) from the last place, so a text of many notices is read once.
    at, spaces = 0, 0
    for end, phrase in phrases.iter(line):
        if phrase in BASE:
            base.add(BASE[phrase])
            start = end - len(phrase)
            spaces += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            places.append(spaces - 1)
        tagged = tagged or phrase == TAG
        if phrase in NOTICES:
            labels.add(NOTICES[phrase])
    noticed = set(labels)
    values = []
    outside: list[str] = []
    begin = 0
    for tag in _TAG.finditer(text) if tagged else ():
        expression, stop = expression_after(text, tag.end())
        value, named = evaluated(expression)
        outside.append(text[begin : tag.end()])
        begin = max(begin, stop)
        values.append(value)
        labels |= named
    if outside:
        # The tag's name stands where an expression was, so no phrase reaches across it.
        rest = (f" {TAG} ".join([*outside, text[begin:]])).encode().translate(_TABLE).split()
        found = phrases.iter(" " + b" ".join(rest).decode("latin-1") + " ")
        noticed = {NOTICES[phrase] for _, phrase in found if phrase in NOTICES}
    labels |= base
    values += [FREEDOM[label] for label in (base | noticed)]
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(labels)), float(min(values, default=0.0)),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document, in one pass without a shuffle."""
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            rows = [scanned(value.as_py(), phrases) for value in batch.column("text")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double"
    )
    return docs.select("doc_id", "text").mapInArrow(task, schema)
