"""Personal data: exact patterns, and a semi-Markov conditional random field for other spellings.

The base patterns are found by linear scans of each whole text. Lines with an at sign
or a spelled dot, and numbers up to the next words, are cut into tokens, and a semi-Markov
CRF scores candidate segments by features of the whole span (shape, number of digits, checksum,
octets, neighbours). Candidates are what can be an entity at all: segments of up to
MAX_TOKENS tokens in one line that hold LEAST_DIGITS to MOST_DIGITS digits and no
word, or four numbers, or one at and a dot behind it. A dynamic program chooses
boundaries and types of all their entities together. Spans whose score beats
leaving their tokens alone by MARGIN, and which touch no base span, are added to the
base ones: phones without a plus, cards with other separators, addresses spelled
"name at host dot tld" or with brackets.

The weights are learned at call time by the likelihood of a fixed set of generated
sentences (forward and backward sums over all segmentations, Adagrad); they need no
labelled corpus and are a few thousand numbers.

Defined cases: a null text is empty and has no spans; offsets count code points;
of overlapping base spans of different kinds all stay; repeated rows are alike. A
text of any length is read whole, one line at a time, in time that is linear in it: a
line takes about 150 bytes of memory a token, and segments never reach over lines; the features of
a segment take the first 40 and 60 characters of its coarse and fine shape. An empty table gives no rows; extra columns
play no part.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from heapq import merge
from itertools import accumulate, product
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hustings.llm._spark import map_arrow

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MARGIN, SIZE = 40, 3.0, 1 << 14
_ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that hold, by start and kind."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = "".join(c for c in m[0] if c.isdigit())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_DIGITS = re.compile(r"[0-9]+")
#: A number and what follows it up to a word: all that a segment of numbers can be in.
_RUN = re.compile(r"[0-9][^A-Za-z\n]*")
_ADDRESS = re.compile(r"@|\b[Dd][Oo][Tt]\b")
#: Digits of a number's span; octets have fewer, in four parts.
LEAST_DIGITS, MOST_DIGITS = 9, 19
#: Codes of segments, scored, that a worker remembers; the memo starts afresh when it is full.
MEMO = 50_000
#: The character of a number of no digits.
_NUMBER = 0xE000
_DOUBLED = str.maketrans("0123456789", "0246813579")


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Parts of the text that hold all candidates, with the tokens beside them: whole lines with an at sign or a spelled
    dot, and in other lines what is between two words, if it has enough digits."""
    address = [(-1, -1)]
    for m in _ADDRESS.finditer(text):
        if m.start() >= address[-1][1]:
            end = text.find("\n", m.start())
            address.append((text.rfind("\n", 0, m.start()) + 1, len(text) if end < 0 else end))
    yield from address[1:]
    for m in _RUN.finditer(text):
        a, b = m.span()
        if b - a < 2 * 4 - 1:
            continue
        k = bisect_right(address, (a, len(text))) - 1
        if a < address[k][1]:
            continue
        parts = _DIGITS.findall(m[0])
        if sum(map(len, parts)) < LEAST_DIGITS and len(parts) < 4:
            continue
        # a sign or bracket in front, and the words on both sides
        while a and text[a - 1] in "+( ":
            a -= 1
        while a and text[a - 1].isascii() and text[a - 1].isalpha():
            a -= 1
        if a and not text[a - 1].isspace() and m.start() - a < 3:
            a -= 1
        while b < len(text) and text[b].isascii() and text[b].isalpha():
            b += 1
        yield a, b


def _luhn(digits: str) -> bool:
    return (sum(map(int, digits[::-2])) + sum(map(int, digits[-2::-2].translate(_DOUBLED)))) % 10 == 0


class Line:
    """Tokens of a line, or of a part of it, and the candidate segments among them.

    A token's class is one character: a private one for the length of a number, "a"
    for a word, "A" and "D" for the words at and dot, else the mark itself. codes
    has two characters for each token, whether a gap is before it and its class,
    between paddings; all that a segment's features see, but for its digits, is a slice.
    """

    def __init__(self, text: str, a: int, b: int):
        self.text = text
        found = [*_TOKEN.finditer(text, a, b)]
        self.start, self.end = [m.start() for m in found], [m.end() for m in found]
        self.n = len(found)
        self.kind = [_class(m[0]) for m in found]
        self.digits = [e - s if _is_number(k) else 0 for s, e, k in zip(self.start, self.end, self.kind, strict=True)]
        gaps = [" " if s > e else "_" for s, e in zip(self.start, [self.start[0] if found else 0, *self.end], strict=False)]
        self.codes = "".join(["\n\n", *(g + k for g, k in zip(gaps, self.kind, strict=True)), "\n\n"])

    def numbers(self) -> Iterator[tuple[int, list[int]]]:
        """(end, first tokens) of segments that may be phones, cards or octets, by end."""
        kind, digits = self.kind, self.digits
        for j in range(1, self.n + 1):
            if not digits[j - 1]:
                continue
            total = parts = 0
            firsts = []
            for i in range(j - 1, max(-1, j - 1 - MAX_TOKENS), -1):
                if here := digits[i]:
                    total += here
                    parts += 1
                    if total > MOST_DIGITS:
                        break
                elif kind[i] in "aAD":
                    break
                elif kind[i] not in "+(":
                    continue
                if total >= LEAST_DIGITS or parts == 4:
                    firsts.append(i)
            if firsts:
                yield j, firsts

    def addresses(self) -> dict[int, list[int]]:
        """First tokens, by end, of segments with one at and a dot behind it, and blanks only beside these and their brackets."""
        kind, codes = self.kind, self.codes
        gap = lambda k: codes[2 * k + 2] == " "  # noqa: E731  before token k
        out: dict[int, list[int]] = {}
        for at in range(1, self.n - 2):
            if kind[at] not in "@A":
                continue
            dots = "D" if kind[at] == "A" else ".D"
            ends, dot = [], False
            for j in range(at + 1, min(self.n, at + MAX_TOKENS)):
                if kind[j] in "@A" or gap(j) and not (kind[j] in dots + "[(<])>" or kind[j - 1] in dots + "@A[(<])>"):
                    break
                if dot and kind[j] == "a":
                    ends.append(j + 1)
                dot = dot or kind[j] in dots
            for i in range(at - 1, max(-1, at - 1 - MAX_TOKENS), -1) if ends else ():
                if kind[i] in "@A" or gap(i + 1) and not (kind[i + 1] in "@A[(<" or kind[i] in "[(<"):
                    break
                if kind[i] in "aD" or self.digits[i]:
                    for j in ends:
                        if j - i <= MAX_TOKENS:
                            out.setdefault(j, []).append(i)
        return out

    def by_end(self) -> Iterator[tuple[int, list[int]]]:
        """(end, first tokens) of all candidates, by end; an end may come twice."""
        address = self.addresses() if "@" in self.codes or "A" in self.codes else None
        return merge(self.numbers(), sorted(address.items()), key=itemgetter(0)) if address else self.numbers()

    def key(self, i: int, j: int) -> str:
        """The segment's codes between its neighbours'."""
        return self.codes[2 * i : 2 * j + 4]

    def facts(self, i: int, j: int) -> tuple[bool | None, bool | None]:
        """Whether a card's checksum holds, and whether four numbers are octets; None where that isn't asked."""
        parts = [self.text[self.start[k] : self.end[k]] for k in range(i, j) if self.digits[k]]
        total = sum(map(len, parts))
        return _luhn("".join(parts)) if 12 <= total <= MOST_DIGITS else None, all(len(p) <= 3 and int(p) <= 255 for p in parts) if len(parts) == 4 and total <= 12 else None

    def span(self, i: int, j: int) -> tuple[int, int]:
        return self.start[i], self.end[j - 1]


def _class(word: str) -> str:
    if "0" <= word[0] <= "9":
        return chr(_NUMBER + min(len(word), MOST_DIGITS + 1))
    if word[0].isascii() and word[0].isalpha():
        low = word.lower()
        return "A" if low == "at" else "D" if low == "dot" else "a"
    return "?" if _is_number(word) else word


def _is_number(kind: str) -> bool:
    return _NUMBER < ord(kind) <= _NUMBER + MOST_DIGITS + 1


_MAIL = re.compile(r"(?:9|[aD.%+_-])+ ?[\[(<]? ?[@A] ?[\])>]? ?a(?:9|-a?)*(?: ?[\[(<]? ?[.D] ?[\])>]? ?a(?:9|-a?)*)+")


def span_features(key: str, checked: bool | None, octets: bool | None) -> np.ndarray:
    """Indices of the features of a whole segment, from its codes and facts."""
    before, after, kinds, gaps = key[1], key[-1], key[3:-2:2], key[2:-2:2]
    parts = [ord(k) - _NUMBER for k in kinds if _is_number(k)]
    total, marks = sum(parts), [k for k in kinds if not _is_number(k) and k not in "aAD"]
    plain = lambda k, most: f"9{min(ord(k) - _NUMBER, most)}" if _is_number(k) else k
    shape = "".join((" " if g == " " and n else "") + plain(k, 6) for n, (g, k) in enumerate(zip(gaps, kinds, strict=True)))
    coarse = "".join((" " if g == " " and n else "") + ("9" if _is_number(k) else k) for n, (g, k) in enumerate(zip(gaps, kinds, strict=True)))
    words = sum(k in "aAD" for k in kinds)
    mail = bool(_MAIL.fullmatch(coarse))
    edges = lambda k: "9" if _is_number(k) else k
    glued = f"{before != chr(10) and gaps[0] == '_'} {after != chr(10) and key[-2] == '_'}"
    kinds_of_marks = "".join(sorted(set(marks)))
    names = [
        "bias", f"coarse {coarse[:40]}", f"shape {shape[:60]}", f"digits {total}", f"parts {parts[:8]}", f"marks {kinds_of_marks}", f"luhn {checked}", f"octets {octets} {marks == ['.'] * 3}",
        f"mail {mail}", f"mail {mail} {min(words, 9)}", f"mail {mail} {'A' in kinds} {'D' in kinds} {glued}", f"edges {edges(kinds[0])} {edges(kinds[-1])}", f"before {edges(before)}", f"after {edges(after)}",
        f"glued {glued}", f"only {words == 0} {total > 0}", f"one mark {len(set(marks)) <= 1 and ' ' not in gaps[1:]} {total}", f"blanks {min(gaps[1:].count(' '), 6)} {len(marks)}",
    ]
    return np.array([zlib.crc32(n.encode()) % SIZE for n in names])


class SemiCRF:
    """A weight for each kind and feature; leaving a token alone scores 0."""

    def __init__(self):
        self.weights = np.zeros((len(KINDS), SIZE))
        self.memo: dict[str, tuple[float, dict]] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "memo": {}}

    def _scored(self, key: str) -> tuple[float, dict]:
        """(best score, best score and kind for each pair of facts) of segments with these codes, less MARGIN."""
        sizes = [ord(k) - _NUMBER for k in key[3:-2:2] if _is_number(k)]
        asked = (12 <= sum(sizes) <= MOST_DIGITS, len(sizes) == 4 and sum(sizes) <= 12)
        found = {}
        for facts in product(*((False, True) if a else (None,) for a in asked)):
            scores = self.weights[:, span_features(key, *facts)].sum(1)
            kind = int(scores.argmax())
            found[facts] = float(scores[kind]) - MARGIN, kind
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[key] = out = max(found.values())[0], found
        return out

    def decode(self, line: Line) -> list[Span]:
        """The best segmentation's entities. Between ends of candidates the best score stays as it is."""
        reached, best, how = [0], [0.0], [None]  # ends, ascending, with the best score up to each
        codes, memo = line.codes, self.memo
        for j, firsts in line.by_end():
            top, step = best[-1], None
            for i in firsts:
                key = codes[2 * i : 2 * j + 4]
                most, scored = memo.get(key) or self._scored(key)
                if most > 0:
                    gain, kind = scored[line.facts(i, j)]
                    k = bisect_right(reached, i) - 1
                    if gain > 0 and best[k] + gain > top:
                        top, step = best[k] + gain, (k, i, kind)
            if step:
                reached.append(j)
                best.append(top)
                how.append(step)
        out, at = [], len(how) - 1
        while at:
            k, i, kind = how[at]
            out.append((KINDS[kind], *line.span(i, reached[at])))
            at = k
        return out[::-1]

    def fit(self, examples: list[tuple[str, set[Span]]], epochs: int = 10, rate: float = 0.5, decay: float = 1e-3) -> SemiCRF:
        """Adagrad on the likelihood of marked lines, by forward and backward sums over their segmentations."""
        lattices = []
        for text, truth in examples:
            for a, b in stretches(text):
                line = Line(text, a, b)
                arcs = [(i, j, span_features(line.key(i, j), *line.facts(i, j)), np.array([(kind, *line.span(i, j)) in truth for kind in KINDS])) for j, firsts in line.by_end() for i in firsts]
                if arcs:
                    lattices.append((line.n, sorted(arcs, key=lambda arc: arc[1])))
        squares = np.full_like(self.weights, 1e-6)
        for _ in range(epochs):
            for n, arcs in lattices:
                scores = [self.weights[:, f].sum(1) for _, _, f, _ in arcs]
                total = [np.logaddexp.reduce(x) for x in scores]
                ahead, behind = forward(n, arcs, total), backward(n, arcs, total)
                gradient = np.zeros_like(self.weights)
                for (i, j, f, truth), x in zip(arcs, scores, strict=True):
                    np.add.at(gradient.T, f, truth - np.exp(ahead[i] + x + behind[j] - ahead[n]))
                at = np.nonzero(np.abs(gradient) > 1e-4)
                g = gradient[at] - decay * self.weights[at]
                squares[at] += g * g
                self.weights[at] += rate * g / np.sqrt(squares[at])
        return self


def forward(n: int, arcs: list[tuple], scores: list[float]) -> np.ndarray:
    """Log sums over the segmentations of the tokens before each place; arcs by end."""
    out = np.zeros(n + 1)
    k = 0
    for j in range(1, n + 1):
        out[j] = out[j - 1]
        while k < len(arcs) and arcs[k][1] == j:
            out[j] = np.logaddexp(out[j], out[arcs[k][0]] + scores[k])
            k += 1
    return out


def backward(n: int, arcs: list[tuple], scores: list[float]) -> np.ndarray:
    """Log sums over the segmentations of the tokens from each place on."""
    out = np.zeros(n + 1)
    by_start = sorted(range(len(arcs)), key=lambda k: -arcs[k][0])
    at = 0
    for i in range(n - 1, -1, -1):
        out[i] = out[i + 1]
        while at < len(by_start) and arcs[by_start[at]][0] == i:
            k = by_start[at]
            out[i] = np.logaddexp(out[i], scores[k] + out[arcs[k][1]])
            at += 1
    return out


def training_sentences(n: int = 800, seed: int = 11) -> list[tuple[str, set[Span]]]:
    """Generated sentences with marked entities and look-alikes without a mark."""
    rnd = random.Random(seed)
    number = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rnd.choice("abdeghilmnorstu") for _ in range(rnd.randrange(2, 9)))

    def card() -> str:
        digits = rnd.choice("3456") + number(rnd.choice((13, 14, 14, 14)))
        digits += next(str(c) for c in range(10) if luhn(digits + str(c)))
        return rnd.choice(("{}", " ", "-", ".", "/")).join(digits[k : k + 4] for k in range(0, len(digits), 4)).replace("{}", "")

    def email() -> str:
        at, dot = rnd.choice((("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" @ ", "."), (" @ ", " . ")))
        name = rnd.choice((word(), word(), f"{word()}.{word()}", f"{word()}_{word()}", f"{word()}{number(2)}"))
        host = rnd.choice((word(), word(), f"{word()}-{word()}", f"{word()}{dot}{word()}"))
        return f"{name}{at}{host}{dot}{rnd.choice(('com', 'org', 'net', 'de', 'fr'))}"

    def phone() -> str:
        a, b, c = rnd.randrange(200, 999), rnd.randrange(200, 999), number(4)
        land = rnd.randrange(30, 50)
        return rnd.choice((
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"00{land} {a} {b} {c}", f"00{land} {number(2)} {a} {number(2)} {number(2)}",
            f"0{number(2)} {number(4)} {c}", f"0{number(3)}/{number(3)} {number(3)}", f"+{land} (0){number(2)} {number(6)}",
        ))

    makers = {"email": email, "phone": phone, "card": card, "ip": lambda: rnd.choice((".", ".", " . ")).join(str(rnd.randrange(256)) for _ in range(4))}
    decoys = [
        lambda: number(rnd.randrange(2, 12)), lambda: f"{rnd.randrange(1900, 2030)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}", lambda: f"{number(2)}:{number(2)}:{number(2)}",
        lambda: f"{number(3)},{number(3)},{number(3)}", lambda: f"v{number(1)}.{number(2)}.{number(1)}", lambda: f"{number(1)}.{number(4)}", lambda: f"{number(4)} - {number(4)}",
        lambda: f"at {word()} the dot {word()}", lambda: f"{number(3)} {word()} {number(4)}", lambda: f"#{number(8)}", lambda: f"{number(3)}-{number(2)}", lambda: f"@{word()}", lambda: number(16),
        lambda: f"{word()} at the {word()}. {word()}", lambda: f"{number(3)} {number(3)} {number(3)}", lambda: f"{number(1)},{number(3)},{number(3)},{number(3)}", lambda: f"{number(1)}.{number(14)}",
        lambda: f"{word()}{number(4)}{word()}", lambda: f"{number(2)} {number(2)} {number(3)}", lambda: f"978-{number(1)}-{number(5)}-{number(3)}-{number(1)}",
    ]
    out = []
    for _ in range(n):
        text, truth = " ".join(word() for _ in range(rnd.randrange(1, 6))), set()
        for _ in range(rnd.randrange(1, 3)):
            text += rnd.choice((" ", " ", ", ", ": ", "\n"))
            if rnd.random() < 0.55:
                kind = rnd.choice(KINDS)
                made = makers[kind]()
                truth.add((kind, len(text), len(text) + len(made)))
            else:
                made = rnd.choice(decoys)()
            text += made + rnd.choice((" ", ". ", ", ")) + " ".join(word() for _ in range(rnd.randrange(1, 5)))
        out.append((text, truth))
    return out


def train(sentences: list[tuple[str, set[Span]]] | None = None) -> SemiCRF:
    return SemiCRF().fit(sentences or training_sentences())


def find_spans(text: str, model: SemiCRF) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and kind."""
    base = base_spans(text)
    starts = [s for _, s, _ in base]
    reach = [*accumulate((e for _, _, e in base), max)]  # furthest end of the base spans up to each
    extra = []
    for a, b in stretches(text):
        for kind, s, e in model.decode(Line(text, a, b)):
            k = bisect_left(starts, e)
            if not k or reach[k - 1] <= s:  # touches no base span
                extra.append((kind, s, e))
    return base, sorted({*base, *extra}, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, model: SemiCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: identifier, base_spans and spans (arrays of kind, start, end)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [find_spans(text.as_py() or "", shipped.value) for text in batch.column(1)]
        lists = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans[k]] for spans in both], kind) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column(0), *lists], [id_col, "base_spans", "spans"])

    spans = "array<struct<kind: string, start: long, end: long>>"
    return map_arrow(docs.select(id_col, text_col), over, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, base_spans {spans}, spans {spans}")


def mask(docs: DataFrame, model: SemiCRF, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in angle brackets; overlapping spans by that of the first."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        out, last = [], 0
        for kind, s, e in find_spans(text, shipped.value)[1]:
            if s >= last:
                out += [text[last:s], f"<{kind}>"]
            last = max(last, e)
        return "".join([*out, text[last:]])

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.set_column(place, batch.schema.field(place), pa.array([masked(t.as_py()) for t in batch.column(place)], pa.string()))

    return map_arrow(docs, over, docs.schema)


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """find_pii's rows as identifier, a count for each kind of base span, base_sha256 and spans as text."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [[[(s["kind"], s["start"], s["end"]) for s in spans] for spans in batch.column(k).to_pylist()] for k in (1, 2)]
        counts = [pa.array([sum(s[0] == kind for s in spans) for spans in lists[0]], pa.int64()) for kind in KINDS]
        digest = pa.array([hashlib.sha256(_written(spans).encode()).hexdigest() for spans in lists[0]])
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array([_written(s) for s in lists[1]], pa.string())], [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = found.schema[id_col].dataType.simpleString()
    return map_arrow(found.select(id_col, "base_spans", "spans"), over, f"`{id_col}` {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")
