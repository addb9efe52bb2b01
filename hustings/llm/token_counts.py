"""Token counts by finite-state transducers compiled from a tokenizer's file.

The tokenizer is one that cuts lower-cased words and encodes each by BPE with marked word ends. Two
deterministic transducers stand for it, and nothing is ever merged:

1. The cutter reads classes of characters and marks where pieces begin. Its few states allow whole
   state maps: a text is dealt into chunks, each chunk's map (state before -> state after) is built for all
   chunks at once, the maps are composed by a parallel prefix scan, and with the states so known each chunk's
   marks are read off.
2. The counter reads the bytes of a piece, the last one as a symbol of its own. A transition is annotated with
   the tokens that it emits: how many more tokens the piece has up to here than up to the byte before, which may be
   less than none. A state is what the rest can depend on: every place from which a token may still
   run on, the token that ends there and how many tokens lie behind it. Of the tokens that end at
   a byte exactly one stays beside its predecessor when both are encoded together (`apart`), and that is BPE's.
   All pieces of a batch step together, an array operation for each byte. A piece begins in the start state, so that its map is
   constant and maps compose by adding counts.

States of the counter are compiled when a text first reaches them and kept in a bounded table (`MAX_STATES`);
where it is full it starts afresh, and a piece that would fill one alone is stepped without one.

Defined cases: a null text is empty and has no tokens; a special token's string in a text is one token; repeated rows
are counted alike; an empty table gives no rows; other columns play no part, whatever their names. Texts are read in groups of GROUP_CHARS
characters; a longer one is cut at white space, where the cutter is back in its start state, so that only a piece of
text without any white space is held whole. Characters have the classes and compositions of the installed Unicode tables: texts with
letters newer than Unicode 15, or with marks newer than the library's own tables before other marks, can differ from the library by a token.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from hustings.llm.bpe import byte_symbols

#: Characters that are normalised and cut together.
GROUP_CHARS = 1 << 20
#: Characters of a chunk whose state map is built.
CHUNK = 64
#: States of the counter that a worker keeps, of 1.5 KB each.
MAX_STATES = 1 << 16
#: Pairs of a token and what may follow it that a worker keeps.
MAX_PAIRS = 1 << 19
#: Of a place from which at most so many tokens run on, a state holds which of them can follow, instead of the token before.
FEW_BELOW = 32
#: Pieces that step together at least; fewer step one by one.
FEW = 16

#: Code points with the property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, OTHER, NUMBER, LETTER, QUOTE = range(5)
#: What the cutter can compile: literal pieces that begin with a quote, then letters, a number, and anything else but white space.
GRAMMAR = ["[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"]
_STARTS, _STARTED_BEFORE = 1, 2


#: Marks a transition that isn't compiled yet; a byte adds or takes fewer tokens than a token has bytes.
UNKNOWN = -128


class TableFull(Exception):
    """The counter's table has no room for another state."""


class Cutter:
    """Where pieces begin, by classes of characters."""

    def __init__(self, pattern: str):
        alternatives = pattern.split("|")
        literals = alternatives[: -len(GRAMMAR)]
        if alternatives[-len(GRAMMAR) :] != GRAMMAR or not all(re.fullmatch("'[a-z]{1,2}", x) for x in literals):
            raise ValueError(f"can't compile {pattern}")
        one, two = {x[1:] for x in literals if len(x) == 2}, {x[1:] for x in literals if len(x) == 3}
        if len({x[0] for x in two} & one):
            raise ValueError(f"can't compile {pattern}")
        marks = sorted({c for x in one | two for c in x})  # letters that literals are made of have classes of their own
        kinds = {c: 5 + k for k, c in enumerate(marks)}
        self.classes = np.full(0x110000, OTHER, np.uint8)
        text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, found in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for run in regex.finditer(found, text):
                a, b = ord(text[run.start()]), ord(text[run.end() - 1])
                self.classes[a : b + 1] = kind
        self.classes[0xD800:0xE000] = OTHER
        self.classes[WHITE_SPACE] = SPACE
        self.classes[ord("'")] = QUOTE
        for c, kind in kinds.items():
            self.classes[ord(c)] = kind

        # states: between pieces, in letters, in others, behind a quote that begins a piece, and behind it and one letter
        between, letters, others, quote = range(4)
        pending = {c: 4 + k for k, c in enumerate(sorted({x[0] for x in two}))}
        n_states, n_kinds = 4 + len(pending), 5 + len(kinds)
        self.next, self.mark = np.zeros((n_states, n_kinds), np.uint8), np.zeros((n_states, n_kinds), np.uint8)
        fresh = {SPACE: (between, 0), OTHER: (others, _STARTS), NUMBER: (between, _STARTS), QUOTE: (quote, _STARTS)}
        letter = {LETTER: None} | {kind: c for c, kind in kinds.items()}
        for kind in range(n_kinds):
            begun = fresh.get(kind, (letters, _STARTS))
            self._set(between, kind, begun)
            self._set(letters, kind, (letters, 0) if kind in letter else begun)
            self._set(others, kind, (others, 0) if kind in (OTHER, QUOTE) else begun)
            c = letter.get(kind)
            self._set(quote, kind, (others, 0) if kind in (OTHER, QUOTE) else (between, 0) if c in one else (pending[c], 0) if c in pending else begun)
            for first, state in pending.items():
                if c and first + c in two:
                    self._set(state, kind, (between, 0))
                elif kind in letter:  # the letter before begins a piece of letters, which goes on
                    self._set(state, kind, (letters, _STARTED_BEFORE))
                else:
                    self._set(state, kind, (begun[0], begun[1] | _STARTED_BEFORE))

    def _set(self, state: int, kind: int, to: tuple[int, int]) -> None:
        self.next[state, kind], self.mark[state, kind] = to

    def chunk_maps(self, chunks: np.ndarray) -> np.ndarray:
        """The state after each chunk (a row of classes), for each state before it."""
        maps = np.broadcast_to(np.arange(len(self.next), dtype=np.uint8), (len(chunks), len(self.next)))
        for k in range(chunks.shape[1]):
            maps = self.next[maps, chunks[:, k, None]]
        return maps

    @staticmethod
    def scan(maps: np.ndarray) -> np.ndarray:
        """Maps of all chunks up to and with each one, composed in rounds of doubled reach."""
        reach = 1
        while reach < len(maps):
            maps = np.concatenate([maps[:reach], np.take_along_axis(maps[reach:], maps[:-reach], 1)])
            reach *= 2
        return maps

    def pieces(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces in code points; they must end in white space."""
        kinds = self.classes[points]
        n = len(kinds)
        padded = np.zeros(-(-n // CHUNK) * CHUNK, np.uint8)
        padded[:n] = kinds
        chunks = padded.reshape(-1, CHUNK)
        states = np.concatenate([np.zeros(1, np.uint8), self.scan(self.chunk_maps(chunks))[:-1, 0]])
        marks = np.empty_like(chunks)
        for k in range(CHUNK):
            marks[:, k] = self.mark[states, chunks[:, k]]
            states = self.next[states, chunks[:, k]]
        marks = marks.reshape(-1)[:n]
        starts = marks & _STARTS == _STARTS
        starts[:-1] |= marks[1:] & _STARTED_BEFORE == _STARTED_BEFORE
        at = np.flatnonzero(starts | (kinds == SPACE))
        begins = starts[at[:-1]]
        return at[:-1][begins], at[1:][begins]


class Counter:
    """How many BPE tokens a piece has, by its bytes."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        plain = {s: b for b, s in enumerate(byte_symbols())}
        self.tokens = {s: b for s, b in plain.items()} | {s + end: 256 + b for s, b in plain.items()}
        if any(s not in vocab for s in self.tokens):
            raise ValueError("every byte must be a token, within a piece and at its end")
        self.parts: list[tuple[int, int]] = []  # of token 512 + rank
        self.merged: dict[tuple[int, int], int] = {}
        spelled: list[tuple[int, ...]] = [(k,) for k in range(512)]
        for rank, (a, b) in enumerate(merges):
            if a + b in self.tokens or a not in self.tokens or b not in self.tokens:
                raise ValueError(f"merge {rank} must make a new token of earlier ones")
            i, j = self.tokens[a], self.tokens[b]
            self.parts.append((i, j))
            self.merged[i, j] = self.tokens[a + b] = 512 + rank
            spelled.append(spelled[i] + spelled[j])
        # a tree of the tokens that are their own encoding; a node is entered by node * 512 + symbol
        self.tree: dict[int, int] = {}
        self.token_at, self.inner = [-1], [True]
        own = [True] * 512
        for token, symbols in enumerate(spelled):
            if token >= 512:
                i, j = self.parts[token - 512]
                own.append(own[i] and own[j] and self._unjoined(i, j))
            if not own[token]:
                continue
            node = 0
            for symbol in symbols:
                self.inner[node] = True
                key = node << 9 | symbol
                if key not in self.tree:
                    self.tree[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = self.tree[key]
            self.token_at[node] = token
        self.below = self._tokens_below()
        self._empty()

    def _tokens_below(self) -> dict[int, list[int]]:
        """The tokens that go on from a node, where they are few."""
        many = [0] * len(self.token_at)
        found: dict[int, list[int]] = {}
        for key, child in reversed(self.tree.items()):  # nodes come after the ones that they are entered from
            node, whole = key >> 9, self.token_at[child]
            many[node] += many[child] + (whole >= 0)
            if many[node] > FEW_BELOW:
                found.pop(node, None)
            else:
                found.setdefault(node, []).extend([*([whole] if whole >= 0 else []), *found.get(child, [])])
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("states", "known", "next", "more", "last", "beside", "alike", "first")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._empty()

    def _empty(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.known: dict[tuple, int] = {self.states[0]: 0}
        rows = 1024
        self.next = np.full((rows, 256), -1, np.int32)  # state after a byte
        self.more = np.zeros((rows, 256), np.int8)  # tokens that the transition adds
        self.last = np.full((rows, 256), UNKNOWN, np.int8)  # tokens that a last byte adds
        self.beside: dict[tuple[int, int], bool] = {}
        self.alike: dict[tuple[int, int], int | None] = {}
        self.first: dict[tuple, int] = {}

    def _before(self, before: int, node: int) -> int | None:
        """A token that stands for `before` in front of a node: the first that lets the same tokens follow; None if it lets none."""
        below = self.below.get(node)
        if below is None or before < 0:
            return before
        found = self.alike.get((before, node), -2)
        if found == -2:
            if len(self.alike) >= MAX_PAIRS:
                self.alike.clear()
            allowed = tuple(t for t in below if (before, t) not in self.merged and self._unjoined(before, t))
            found = self.alike[before, node] = self.first.setdefault((node, allowed), before) if allowed else None
        return found

    def _unjoined(self, left: int, right: int) -> bool:
        """Whether nothing merges across the border before the two tokens are whole."""
        while left >= 512 or right >= 512:
            # the one of later rank came last; before, its inner part stood at the border, up to that merge
            if left > right:
                until, left = left, self.parts[left - 512][1]
                across = self.merged.get((left, right), until)
                if across < until:
                    return False
            else:
                until, right = right, self.parts[right - 512][0]
                across = self.merged.get((left, right))
                if across is not None and across <= until:  # of equal ranks the left pair merges first
                    return False
        return True

    def apart(self, left: int, right: int) -> bool:
        """Whether the text of two tokens side by side is encoded as just these two."""
        found = self.beside.get((left, right))
        if found is None:
            if len(self.beside) >= MAX_PAIRS:
                self.beside.clear()
            found = self.beside[left, right] = (left, right) not in self.merged and self._unjoined(left, right)
        return found

    def step(self, state: tuple, symbol: int) -> tuple[int, int, list]:
        """(token that ends here, tokens added, places from which one may run on) after a symbol."""
        token = gain = None
        running = []
        for node, before, behind in state:
            child = self.tree.get(node << 9 | symbol)
            if child is None:
                continue
            whole = self.token_at[child]
            if token is None and whole >= 0 and (before < 0 or self.apart(before, whole)):
                token, gain = whole, 1 - behind
            if self.inner[child] and (stands := self._before(before, child)) is not None:
                running.append((child, stands, behind))
        return token, gain, running

    def after(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """The state after a byte within a piece, and the tokens added."""
        token, gain, running = self.step(state, symbol)
        return (*((node, before, behind + gain) for node, before, behind in running), (0, token, 0)), gain

    def _learn(self, state: int, byte: int) -> None:
        to, gain = self.after(self.states[state], byte)
        found = self.known.get(to)
        if found is None:
            found = len(self.states)
            if found >= MAX_STATES:
                raise TableFull
            if found >= len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.more = np.concatenate([self.more, np.zeros_like(self.more)])
                self.last = np.concatenate([self.last, np.full_like(self.last, UNKNOWN)])
            self.known[to] = found
            self.states.append(to)
        self.next[state, byte], self.more[state, byte] = found, gain

    def _run(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each piece, all stepping together; sizes descend."""
        n = len(starts)
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        going = n
        for k in range(int(sizes[0])):
            going = int(np.searchsorted(-sizes[:going], -k, "left"))  # pieces of more than k bytes
            within = int(np.searchsorted(-sizes[:going], -(k + 1), "left"))
            if going < FEW and k > 32:
                for i in range(going):
                    total[i] += self._alone(int(state[i]), data[starts[i] + k : starts[i] + sizes[i]].tolist())
                break
            at, byte = state[:going], data[starts[:going] + k]
            ends = slice(within, going)
            added = self.last[at[ends], byte[ends]]
            if (unknown := added == UNKNOWN).any():
                for s, b in {*zip(at[ends][unknown].tolist(), byte[ends][unknown].tolist(), strict=True)}:
                    self.last[s, b] = self.step(self.states[s], 256 + b)[1]
                added = self.last[at[ends], byte[ends]]
            total[ends] += added
            if within:
                at, byte = at[:within], byte[:within]
                to = self.next[at, byte]
                if (unknown := to < 0).any():
                    for s, b in {*zip(at[unknown].tolist(), byte[unknown].tolist(), strict=True)}:
                        self._learn(s, b)
                    to = self.next[at, byte]
                total[:within] += self.more[at, byte]
                state[:within] = to
        return total

    def _alone(self, state: int, symbols: list[int]) -> int:
        """Tokens that the rest of a piece adds."""
        total = 0
        for byte in symbols[:-1]:
            to = self.next[state, byte]
            if to < 0:
                self._learn(state, byte)
                to = self.next[state, byte]
            total += int(self.more[state, byte])
            state = to
        return total + self.step(self.states[state], 256 + symbols[-1])[1]

    def _unkept(self, symbols: list[int]) -> int:
        """Tokens of a piece, without a table."""
        state, total = ((0, -1, 0),), 0
        for byte in symbols[:-1]:
            state, gain = self.after(state, byte)
            total += gain
        return total + self.step(state, 256 + symbols[-1])[1]

    def count(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of the pieces of data (bytes) at starts."""
        out = np.zeros(len(starts), np.int64)
        left = [(np.argsort(-sizes, kind="stable"), False)] if len(starts) else []
        while left:
            order, again = left.pop()
            try:
                out[order] = self._run(data, starts[order], sizes[order])
            except TableFull:
                self._empty()
                if not again:
                    left.append((order, True))
                elif len(order) > 1:
                    left += [(order[1::2], True), (order[::2], True)]
                else:
                    a = int(starts[order[0]])
                    out[order] = self._unkept(data[a : a + int(sizes[order[0]])].tolist())
        return out


class TokenCounter:
    """Counts of tokens as a tokenizer's file has them."""

    def __init__(self, file: dict):
        model, splits = file["model"], (file["pre_tokenizer"] or {}).get("pretokenizers", [])
        steps = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in (file["normalizer"] or {}).get("normalizers", [])]
        kinds = [s["type"] for s in splits]
        if (
            model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or not model.get("end_of_word_suffix") or kinds != ["Split", "ByteLevel"]
            or steps != [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)] or splits[0]["behavior"] != "Removed" or not splits[0]["invert"]
            or splits[1]["add_prefix_space"] or splits[1]["use_regex"] or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"])
        ):
            raise ValueError("not a tokenizer that this module compiles")
        self.cutter = Cutter(splits[0]["pattern"]["Regex"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.counter = Counter(model["vocab"], merges, model["end_of_word_suffix"])
        special = sorted((t["content"] for t in file["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    @staticmethod
    def _normal(text: str) -> str:
        """Composed and lower-cased, each character by itself: a sigma at a word's end stays one."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        counts, bounds, parts, size = np.zeros(len(texts), np.int64), [0], [], 0
        for k, text in enumerate(texts):
            sections = self.special.split(text) if self.special else [text]
            counts[k] += len(sections) - 1
            for section in sections:
                parts += [self._normal(section), " "]
                size += len(parts[-2]) + 1
            bounds.append(size)
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return counts
        starts, ends = self.cutter.pieces(points)
        owner = np.searchsorted(np.array(bounds), starts, "right") - 1
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) > len(points):
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            place = np.concatenate([[0], np.cumsum(width)])
            starts, ends = place[starts], place[ends]
        np.add.at(counts, owner, self.counter.count(data, starts, ends - starts))
        return counts

    def count_long(self, text: str, limit: int = GROUP_CHARS) -> int:
        """Tokens of one text, cut before white space about every `limit` characters."""
        if len(text) <= limit:
            return int(self.count([text])[0])
        total, begin = 0, 0
        while begin < len(text):
            cut = _SPACE.search(text, begin + limit)
            end = cut.start() if cut else len(text)
            total += int(self.count([text[begin:end]])[0])
            begin = end
        return total


#: White space of ASCII; composition never takes it in, and no special token holds any.
_SPACE = re.compile("[\t-\r ]")


def load(path: str) -> TokenCounter:
    with open(path, encoding="utf-8") as file:
        return TokenCounter(json.load(file))


def count_tokens(docs: DataFrame, tokenizer: TokenCounter, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """A row per document: identifier, n_bytes (UTF-8), n_tokens, and over_limit, whether they are more than limit."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary file: a fixed size

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // GROUP_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            counts = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = texts.slice(a, b - a).to_pylist()
                if sizes[a:b].sum() > 2 * GROUP_CHARS:
                    counts += [np.array([shipped.value.count_long(t)]) for t in part]
                elif part:
                    counts.append(shipped.value.count(part))
            n = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), n, pc.greater(n, limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(over, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
