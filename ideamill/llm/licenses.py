"""Licence scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by shunting-yard.

A text's A-Z are lower-cased and its words are runs of ASCII letters, digits and non-ASCII characters. One automaton
finds the notice phrases on word borders, a second one the identifier tags (``SPDX-License-Identifier:`` and the like)
in the text itself. What follows a tag is read as a licence expression, as far as it is one: names joined by ``with``,
``and`` and ``or`` (in this order of strength) and brackets. Each name adds its family's label. An expression's level of
obligation is the highest of both sides of ``and``, the lowest of both sides of ``or``, and a step lower after ``with``.

Contract: a null text is an empty one and has no words and no notices; repeated rows give repeated rows; a null key is
kept; phrases that overlap are all found; a text of any length is scanned whole; an unfinished or unbalanced expression
counts up to its longest well-formed start; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ideamill.llm.common import raw_texts

# The phrases every scan counts, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further notice phrases.
NOTICES = {
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl",
    "gnu gpl": "gpl", "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd",
    "isc license": "isc", "boost software license": "bsl", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd", "creative commons attribution": "cc-by",
    "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "dedicated to the public domain": "public-domain", "this is free and unencumbered software": "unlicense",
    "all rights reserved": "reserved", "proprietary and confidential": "reserved",
}
# Starts of identifiers (the longest that fits counts) and their labels.
IDENTIFIERS = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "0bsd": "bsd", "isc": "isc",
    "mpl": "mpl", "epl": "epl", "bsl": "bsl", "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc",
    "cc-by-nd": "cc-by-nd", "unlicense": "unlicense", "licenseref-proprietary": "reserved",
}
# Level of obligation of each label, from none to no use at all.
LEVELS = {
    "public-domain": 0.1, "cc0": 0.1, "unlicense": 0.1, "mit": 0.2, "isc": 0.2, "bsd": 0.2, "bsl": 0.2, "apache": 0.25, "cc-by": 0.3,
    "epl": 0.5, "mpl": 0.5, "lgpl": 0.5, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.9, "reserved": 1.0,
    "unknown": 0.4,
}
TAGS = ("spdx-license-identifier:", "license-expression:", "spdx-license:")
EXCEPTION_STEP = 0.1
STRENGTH = {"or": 1, "and": 2, "with": 3}
SCHEMA = ("n_words long, notices array<struct<phrase: string, label: string, word: long>>, "
          "expressions array<struct<text: string, labels: array<string>, level: double>>, labels string, score double")

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
WORD_TABLE = bytes(c if c >= 0x80 or c in _KEPT else ord(chr(c).lower()) if 65 <= c <= 90 else 32 for c in range(256))
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")


@cache
def _automata():
    """The automata over words and over the text, built once per worker."""
    import ahocorasick

    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in (NOTICES | BASE).items():
        words.add_word(f" {phrase} ", (phrase, label))
    for tag in TAGS:
        tags.add_word(tag, tag)
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def label_of(name: str) -> str:
    """The label of the longest known identifier that the name starts with, on a border of its parts."""
    parts = re.split(r"(?=[-.+])", name.rstrip("+"))
    for end in range(len(parts), 0, -1):
        if found := IDENTIFIERS.get("".join(parts[:end])):
            return found
    return "unknown"


def tokens_at(text: str, place: int) -> Iterator[tuple[str, int]]:
    """The tokens of an expression from place on and where each ends; a line's end stops them."""
    while found := _TOKEN.match(text, place):
        place = found.end()
        yield found[1], place


def to_postfix(text: str, place: int) -> tuple[list[str], int]:
    """The longest well-formed expression at place in postfix order, and where it ends; empty if there is none."""
    output: list[str] = []
    waiting: list[str] = []
    # The output only grows, so its length and the few operators on top tell a complete start.
    length, top, stop, operand, depth = 0, [], place, True, 0
    for token, end in tokens_at(text, place):
        if token.endswith(":"):  # the next tag
            break
        if operand:
            if token == "(":
                waiting.append(token)
                depth += 1
                continue
            if token == ")" or token in STRENGTH:
                break
            output.append(token)
            operand = False
        elif token in STRENGTH:
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[token]:
                output.append(waiting.pop())
            waiting.append(token)
            operand = True
            continue
        elif token == ")" and depth:
            while waiting[-1] != "(":
                output.append(waiting.pop())
            waiting.pop()
            depth -= 1
        else:
            break
        if not depth:
            length, top, stop = len(output), waiting[::-1], end
    return output[:length] + top, stop


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """Labels and level of obligation of an expression in postfix order."""
    held: list[tuple[set[str], float, str]] = []
    for token in postfix:
        if token not in STRENGTH:
            label = label_of(token)
            held.append(({label}, LEVELS[label], token))
            continue
        (right, high, _), (left, low, name) = held.pop(), held.pop()
        if token == "with":
            held.append((left, max(0.0, low - EXCEPTION_STEP), name))
        else:
            held.append((left | right, max(low, high) if token == "and" else min(low, high), name))
    return held[0][:2]


def scan_text(raw: bytes) -> tuple[int, list[tuple], list[tuple], str, float]:
    """Words, notices (phrase, label, word), expressions (text, labels, level), labels and score of a text."""
    words = raw.translate(WORD_TABLE).split()
    if not words:
        return 0, [], [], "", 0.0
    phrases, tags = _automata()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    notices, seen, word = [], 0, 0
    for last, (phrase, label) in phrases.iter(line):
        # A phrase's match ends on the space behind its last word.
        word += line.count(" ", seen, last)
        seen = last
        notices.append((phrase, label, word - phrase.count(" ") - 1))
    expressions = []
    if b":" in raw:
        low = raw.lower()
        if b"license" in low:
            text = low.decode("utf-8", "replace")
            for last, _ in tags.iter(text):
                postfix, end = to_postfix(text, last + 1)
                if postfix:
                    labels, level = evaluate(postfix)
                    expressions.append((text[last + 1:end].strip(), sorted(labels), level))
    labels = {label for _, label, _ in notices}.union(*(found for _, found, _ in expressions))
    score = max([LEVELS[label] for _, label, _ in notices] + [level for *_, level in expressions], default=0.0)
    return len(words), notices, expressions, ",".join(sorted(labels)), score


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, notices, expressions, labels and score (its highest level, 0 if none)."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(SCHEMA)])
    arrow = pa.schema([
        ("n_words", pa.int64()),
        ("notices", pa.list_(pa.struct([("phrase", pa.string()), ("label", pa.string()), ("word", pa.int64())]))),
        ("expressions", pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("level", pa.float64())]))),
        ("labels", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            columns: list[list] = [[] for _ in arrow]
            for raw in raw_texts(b.column(1)):
                n, notices, expressions, labels, score = scan_text(raw)
                found = (n, [dict(zip(("phrase", "label", "word"), x)) for x in notices],
                         [dict(zip(("text", "labels", "level"), x)) for x in expressions], labels, score)
                for column, value in zip(columns, found):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, f.type) for c, f in zip(columns, arrow)]], ["doc_id", *arrow.names])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def joined_labels(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_digests(docs: DataFrame) -> DataFrame:
    """The places and labels of the base phrases next to all labels and the score."""
    base = F.filter("notices", lambda x: x["phrase"].isin(*BASE))
    return scanned(docs).withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        joined_labels(F.col("base.label")).alias("base_labels"), "labels", "score")
