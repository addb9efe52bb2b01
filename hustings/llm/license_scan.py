"""License scans: an Aho-Corasick automaton and a shunting-yard expression parser.

The automaton runs twice over each text: over its words (ASCII letters in lower
case, digits and non-ASCII characters; one space between) for notice phrases,
and over the lower-cased text for identifier tags. What follows a tag is read as
a license expression: AND, OR, WITH and parentheses, by precedence WITH, AND, OR,
are ordered by the shunting-yard algorithm and evaluated into the identifiers
named and whether one choice of them is permissive. Known identifiers, and those that
begin with LicenseRef-, are labels; other words are not.

score: 1 for a document with a well-formed expression of such identifiers alone, else 1
minus the product of (1 - weight) over the labels of its phrases, 0 without any.

Defined cases: a null text is empty; empty texts have no words, labels or score;
overlapping places of a phrase all count; a malformed expression gives no labels;
repeated rows are scanned alike; a text of any length is
scanned in one pass, with a few times its bytes.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from hustings.llm._spark import map_arrow

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further phrases of the method, their labels and weights.
NOTICES = {
    "mit license": ("mit", 0.95),
    "apache license version 2 0": ("apache-2.0", 0.98),
    "apache license": ("apache", 0.9),
    "bsd license": ("bsd", 0.9),
    "mozilla public license": ("mpl", 0.95),
    "gnu general public license": ("gpl", 0.98),
    "lesser general public license": ("lgpl", 0.98),
    "affero general public license": ("agpl", 0.98),
    "creative commons attribution": ("cc-by", 0.9),
    "creative commons zero": ("cc0", 0.9),
    "public domain": ("public-domain", 0.5),
    "isc license": ("isc", 0.9),
}
BASE_WEIGHT = {"cc-by": 0.7, "gpl": 0.9, "reserved": 0.9}
TAGS = ("spdx-license-identifier:", "license-expression:")
PERMISSIVE = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "cc-by-4.0", "unlicense", "zlib", "0bsd"}
#: Further identifiers and exceptions of the public list.
KNOWN = PERMISSIVE | {
    "agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later", "artistic-2.0", "bsl-1.0", "cc-by-3.0", "cc-by-nc-4.0", "cc-by-nd-4.0", "cc-by-sa-3.0", "cc-by-sa-4.0", "classpath-exception-2.0",
    "epl-1.0", "epl-2.0", "eupl-1.2", "gcc-exception-3.1", "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "lgpl-2.1", "lgpl-2.1-only",
    "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later", "llvm-exception", "mpl-1.1", "mpl-2.0", "odbl-1.0", "ofl-1.1", "postgresql", "python-2.0", "wtfpl",
}
_PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}
_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*)")

#: Bytes to words: A-Z to a-z, other ASCII but letters and digits to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def parse_expression(text: str, place: int = 0) -> list[str] | None:
    """The expression at a place of text in postfix order, or None if it is malformed. It ends with its line."""
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether the last token ends an operand
    depth = 0
    while m := _TOKEN.match(text, place):
        token = m[1]
        operator = token.upper() if token.upper() in _PRECEDENCE else None
        if operator:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[operator]:
                out.append(stack.pop())
            stack.append(operator)
            operand = False
        elif token == "(":
            if operand:
                break
            stack.append(token)
            depth += 1
        elif token == ")":
            if not depth or not operand:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            if operand:
                break  # the expression ends before the next word
            out.append(token.rstrip("."))
            operand = True
        place = m.end()
    if depth or not operand:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """(identifiers, whether a choice among them is permissive throughout)."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (right, right_free), (left, left_free) = stack.pop(), stack.pop()
            free = {"OR": left_free or right_free, "AND": left_free and right_free, "WITH": left_free}[token]
            stack.append((left | right, free))
        else:
            stack.append(({token.lower()}, token.lower() in PERMISSIVE))
    return stack[0]


def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES}:
        phrases.add_word(f" {phrase} ", (len(phrase) + 2, BASE.get(phrase), NOTICES.get(phrase)))
    for tag in TAGS:
        tags.add_word(tag, None)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(text: str, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, permissive, score)."""
    raw = text.encode()
    words = raw.translate(_FOLD).split()
    line = f" {b' '.join(words).decode()} "
    starts: list[int] = []
    base: set[str] = set()
    weights: dict[str, float] = {}
    # places come by their ends; a start's word number is the count of spaces before it
    seen = number = 0
    for end, (length, label, notice) in phrases.iter(line):
        start = end - length + 1
        if label:
            if start >= seen:
                number += line.count(" ", seen, start)
            else:
                number -= line.count(" ", start, seen)
            seen = start
            starts.append(number)
            base.add(label)
            weights[label] = max(weights.get(label, 0.0), BASE_WEIGHT[label])
        if notice:
            weights[notice[0]] = max(weights.get(notice[0], 0.0), notice[1])
    labels, permissive, whole = {*weights}, None, False
    if b"identifier:" in (low := raw.translate(_LOWER)) or b"expression:" in low:
        folded = low.decode()
        for end, _ in tags.iter(folded):
            postfix = parse_expression(text, end + 1)
            if postfix:
                named, free = evaluate(postfix)
                known = {x for x in named if x in KNOWN or x.startswith("licenseref-")}
                labels |= known
                permissive = free if permissive is None else permissive and free
                whole = whole or known == named
    doubt = 1.0
    for label in sorted(weights):
        doubt *= 1 - weights[label]
    join = lambda x: ",".join(sorted(x))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), join(base), join(labels), permissive, 1.0 if whole else 1 - doubt


_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("permissive", pa.bool_()), ("score", pa.float64())]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: identifier, n_words, n_base, first_word, last_word, base_labels, labels, permissive and score."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        phrases, tags = _automata()
        rows = [scan_text(text.as_py() or "", phrases, tags) for text in batch.column(1)]
        columns = [pa.array(x, kind) for x, (_, kind) in zip(zip(*rows, strict=True), _FIELDS, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *(n for n, _ in _FIELDS)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, permissive boolean, score double"
    return map_arrow(docs.select(id_col, text_col), over, schema)
