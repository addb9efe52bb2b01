"""Byte-level BPE encoding and decoding with a pair occurrence index.

Texts are cut at special tokens and split by the tokenizer's pattern. The pieces
of a batch that are not in the worker's bounded memo are encoded together: their
symbols lie in one array, linked left and right, and an index maps each adjacent
pair that has a merge rank to all its positions. Active ranks are taken from a
heap in ascending order; all positions of the rank's pair merge at once, from
left to right, and only the lists of the pairs that arise beside them are
updated. Merging a rank can only make pairs of later rank in a vocabulary whose
merges list parts before wholes, so one ascending pass encodes every piece; a
rank that arises again goes back on the heap.

Decoding looks up the bytes of each id, joins them and reads UTF-8, with U+FFFD
for invalid bytes.

The vocabulary file is read on the driver and shipped to the workers; its path is
a parameter. Defined cases: a null text is empty and has no tokens; a special
token's string in a text is that token; repeated rows are encoded alike. Texts are handed
on in groups of GROUP_CHARS characters; a longer one is encoded alone, with about
a hundred times its bytes where its pieces are new.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from hustings.llm._spark import map_arrow

#: Bytes of pieces and ids that a worker remembers, with about 150 more for each; the memo starts afresh when it is full.
MEMO_BYTES = 48 << 20


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class ByteBPE:
    """A byte-level BPE vocabulary: encode texts to ids, decode ids to texts."""

    def __init__(self, vocabulary: dict, pattern: str):
        model = vocabulary["model"]
        symbol_byte = {s: b for b, s in enumerate(byte_symbols())}
        ids = model["vocab"]
        self.first = np.array([ids[s] for s in byte_symbols()], np.int32)
        self.bytes = {i: bytes(symbol_byte[c] for c in token) for token, i in ids.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in reversed([*enumerate(merges)])}
        self.merged = [ids[a + b] for a, b in merges]
        byte_of = {i: b for b, i in enumerate(self.first.tolist())}
        self.byte_ranks = np.full((256, 256), -1, np.int32)  # of pairs of single bytes
        for (a, b), rank in self.ranks.items():
            if a in byte_of and b in byte_of:
                self.byte_ranks[byte_of[a], byte_of[b]] = rank
        self.pairs = [(ids[a], ids[b]) for a, b in merges]
        self.special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.pattern = pattern
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0
        self._compiled = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "memo_bytes": 0, "_compiled": None}

    def _patterns(self):
        if self._compiled is None:
            special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
            self._compiled = regex.compile(self.pattern), special
        return self._compiled

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece."""
        raw = [p.encode() for p in pieces]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.first[data].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for e in ends.tolist():  # pieces don't touch
            if e < n:
                after[e - 1], before[e] = n, -1
        if n:
            after[n - 1] = n
        index: dict[int, list[int]] = defaultdict(list)
        ranks = self.ranks
        begun = np.full(n, -1, np.int32)
        begun[:-1] = self.byte_ranks[data[:-1], data[1:]]
        begun[ends[ends > 0] - 1] = -1
        order = np.argsort(begun, kind="stable")
        order = order[np.searchsorted(begun[order], 0) :]
        cuts = np.flatnonzero(np.diff(begun[order], prepend=-1))
        for rank, a, b in zip(begun[order[cuts]].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=False):
            index[rank] = order[a:b].tolist()
        active = [*index]
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            places = index.pop(rank, None)
            if places is None:
                continue
            (left, right), new = self.pairs[rank], self.merged[rank]
            places.sort()
            for i in places:
                j = after[i] if ids[i] == left else n
                if j >= n or ids[j] != right:
                    continue  # an earlier merge took one of the two
                k, h = after[j], before[i]
                ids[i], ids[j], after[i] = new, -1, k
                if k < n:
                    before[k] = i
                    if (r := ranks.get((new, ids[k]))) is not None:
                        if r not in index:
                            heapq.heappush(active, r)
                        index[r].append(i)
                if h >= 0 and (r := ranks.get((ids[h], new))) is not None:
                    if r not in index:
                        heapq.heappush(active, r)
                    index[r].append(h)
        flat = np.array(ids, np.int64)
        alive = flat >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] if n else np.zeros(len(raw) + 1, int)
        flat = flat[alive].astype("<u4")
        return [flat[a:b] for a, b in zip(counts[:-1], counts[1:], strict=True)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pattern, special = self._patterns()
        split = []
        for text in texts:
            parts = special.split(text) if special else [text]
            split.append([(part,) if k % 2 else pattern.findall(part) for k, part in enumerate(parts)])
        if self.memo_bytes > MEMO_BYTES:
            self.memo, self.memo_bytes = {}, 0
        memo = self.memo
        fresh = list({piece for parts in split for k, part in enumerate(parts) if not k % 2 for piece in part if piece not in memo})
        memo.update(zip(fresh, (x.tobytes() for x in self.encode_pieces(fresh)), strict=True))
        self.memo_bytes += sum(150 + len(piece) + len(memo[piece]) for piece in fresh)
        marks = {s: int(i).to_bytes(4, "little") for s, i in self.special.items()}
        return [b"".join(b"".join(map(memo.__getitem__ if not k % 2 else marks.__getitem__, part)) for k, part in enumerate(parts)) for parts in split]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def load(path: str, pattern: str) -> ByteBPE:
    with open(path, encoding="utf-8") as file:
        return ByteBPE(json.load(file), pattern)


#: Characters of the texts that are encoded, and handed on, together; a longer text is alone.
GROUP_CHARS = 1_000_000


def _shipped(docs: DataFrame, tokenizer: ByteBPE):
    return docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary file: a fixed size


def _encoded(column: pa.Array, bpe: ByteBPE):
    texts = [t or "" for t in column.to_pylist()]
    return zip(texts, bpe.encode_batch(texts), strict=True)


def _map_groups(df: DataFrame, place: int, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """function over runs of rows whose texts, in the column at place, have about GROUP_CHARS characters."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(chars // GROUP_CHARS)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    yield function(batch.slice(a, b - a))

    return df.mapInArrow(over, schema)


def encode(docs: DataFrame, tokenizer: ByteBPE, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """docs with the ids of each text as an array."""
    shipped = _shipped(docs, tokenizer)
    others = [c for c in docs.columns if c != out_col]
    place = others.index(text_col)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for _, x in _encoded(batch.column(place), shipped.value)]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], [*others, out_col])

    schema = StructType([*docs.select(*others).schema, StructField(out_col, ArrayType(IntegerType()))])
    return _map_groups(docs.select(*others), place, over, schema)


def encode_checked(docs: DataFrame, tokenizer: ByteBPE, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """docs with the ids of each text, their number n_tokens, and round_trip: whether the ids decode to the text."""
    shipped = _shipped(docs, tokenizer)
    added = [out_col, "n_tokens", "round_trip"]
    others = [c for c in docs.columns if c not in added]
    place = others.index(text_col)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = shipped.value
        ids, same = [], []
        for text, x in _encoded(batch.column(place), bpe):
            ids.append(np.frombuffer(x, "<u4").astype(np.int32))
            same.append(bpe.decode(x) == text)
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
        return pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(same)], [*others, *added])

    kinds = (ArrayType(IntegerType()), LongType(), BooleanType())
    schema = StructType([*docs.select(*others).schema, *(StructField(c, k) for c, k in zip(added, kinds, strict=True))])
    return _map_groups(docs.select(*others), place, over, schema)


def decode(encoded: DataFrame, tokenizer: ByteBPE, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """encoded with the text of each array of ids; null ids give an empty text."""
    shipped = _shipped(encoded, tokenizer)
    others = [c for c in encoded.columns if c != out_col]
    place = others.index(ids_col)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = shipped.value
        texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(place).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*others, out_col])

    schema = StructType([*encoded.select(*others).schema, StructField(out_col, StringType())])
    return map_arrow(encoded.select(*others), over, schema)


def round_trip_digests(docs: DataFrame, tokenizer: ByteBPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: identifier, n_tokens, ids_sha256 and decoded_sha256, in one pass and without storing the ids."""
    shipped = _shipped(docs, tokenizer)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = shipped.value
        counts, digests, decoded = [], [], []
        for _, ids in _encoded(batch.column(1), bpe):
            counts.append(len(ids) // 4)
            digests.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _map_groups(docs.select(id_col, text_col), 1, over, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
