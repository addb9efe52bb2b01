"""Removal of long repeated passages by suffix arrays over shards.

Every byte under a WINDOW-byte string that also starts anywhere else, in the same
document or another, goes. Windows are brought together by content, and suffix
arrays decide which of them are equal:

1. Routing. Each window's anchor is the GRAM-byte string in it with the smallest
   hash, the leftmost of equal ones. Equal windows have equal anchors at equal
   places, so a document falls into segments, runs of windows with one anchor
   place, and only segments of one anchor can hold equal windows. Segments are
   exchanged as an anchor and a digest (128-bit BLAKE2b), not as text; an anchor
   that occurs once ends here.
2. Shards. For each anchor and digest one piece of text is cut, or two copies
   from two places if the digest occurs twice or more. Pieces are dealt by anchor into
   shards of about SHARD_BYTES; an anchor with more is dealt over several shards
   by digest.
3. Suffix array of a shard: Larsson-Sadakane refinement. Suffixes are ranked by
   their first bytes, then ranks of twice the depth come from pairs of ranks, and
   only groups that are still tied are sorted again. Depth ends at WINDOW, and a
   depth ranks only the places that deeper ones ask for.
4. Common prefixes: Kasai's argument in text order. A place whose predecessor in
   the array follows the last place's predecessor has its prefix less one byte;
   all others are compared byte by byte. A window whose common prefix with its
   predecessor reaches WINDOW is repeated, and so is the predecessor.
5. Shards that share an anchor are merged by binary search. Each gives its distinct
   windows of such anchors as a run sorted by key (128-bit BLAKE2b of the window),
   cut at the borders of key ranges, whose number follows from that of the shards.
   In a range, runs meet two at a time, each key of one searched in the other. It
   is linear in the windows, whatever an anchor's number of pieces.
6. What holds for a piece holds for all places of its anchor and digest. Each
   document's covered stretches are merged, cut out, and the rest is hashed.

Texts are exchanged twice, for the cutting of steps 2 and 6, and once more for the
words in passages that another row has, which are counted beside (`shared_passages`),
whether their bytes go or not. Tables between the
steps lie in the shared folder and are deleted once later ones hold what they
gave; the one of stretches stays for the result to read.

Defined cases: a null text is empty; texts shorter than WINDOW bytes keep all;
repeated rows and copies of WINDOW bytes or more are removed whole; identifiers
of any type, null included, are documents like any other; matches never cross
documents; a text of any length is hashed CHUNK_BYTES at a time, but is held
whole by the tasks that cut it, with about ten times its bytes there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import _text, shared_passages
from hustings.llm._spark import drop_table, grouped, map_arrow, stage_table
from hustings.llm._text import U64

WINDOW, GRAM = 400, 128
#: Bytes whose suffixes are sorted together, about; pieces of one anchor go over several shards beyond half of it.
SHARD_BYTES = 1 << 19
#: Bytes of a text whose windows are hashed at once.
CHUNK_BYTES = 1 << 20
_PLACE = U64((1 << 26) - 1)


def _cut(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums, down = _text.prefix_sums(data)
    grams = _text.mix((sums[gram:] - sums[: len(data) - gram + 1]) * down[: len(data) - gram + 1])
    places = np.arange(len(grams), dtype=U64) & _PLACE
    place = _text.window_minimum(grams & ~_PLACE | places, window - gram + 1) & _PLACE
    start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.append(start, len(place)))
    # the anchor of window i is less than window places on
    at = start + ((place[start].astype(np.int64) - start) & int(_PLACE))
    return grams[at], start, count


def segments(data: np.ndarray, window: int, gram: int, chunk: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(anchor, start, windows) of each run of windows with one anchor place."""
    if len(data) < window:
        return None
    out, begin = [], 0
    while True:
        some = data[begin : begin + chunk + window]
        anchor, start, count = _cut(some, window, gram)
        last = begin + len(some) == len(data)
        if not last and len(start) > 1:  # the last run may go on behind the chunk, and begins the next one
            anchor, start, count = anchor[:-1], start[:-1], count[:-1]
        out.append((anchor, start + begin, count))
        if last:
            return tuple(np.concatenate(x) for x in zip(*out, strict=True))
        begin += int(start[-1] + count[-1])


def sort_suffixes(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The marked places in the order of their first depth bytes, equal ones by place; depth bytes follow each."""
    n = len(data)
    bits = U64(n.bit_length())
    if 3 * int(bits) > 64:
        raise ValueError("a shard has up to 2**21 bytes")
    low = U64((1 << int(bits)) - 1)
    steps, known = [], min(5, depth)
    while known < depth:
        steps.append(min(known, depth - known))
        known += steps[-1]
    asked = [wanted]  # places whose ranks a depth needs, from the deepest
    for step in steps[::-1]:
        more = asked[-1].copy()
        more[step:] |= asked[-1][:-step]
        asked.append(more)
    asked.reverse()
    places = np.flatnonzero(asked[0]).astype(U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    key = np.zeros(len(places), U64)
    for k in range(min(5, depth)):
        key = key << U64(8) | padded[k : k + n][places]
    key = key << bits | places
    key.sort()
    rank = np.zeros(n, U64)

    def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, whether each begins a group) of sorted keys."""
        head = np.ones(len(key), bool)
        np.not_equal(key[1:] >> bits, key[:-1] >> bits, out=head[1:])
        return (key & low).astype(np.int64), head

    def begun(head: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(head, np.arange(len(head), dtype=np.int64), 0))

    places, head = ranked(key)
    rank[places] = begun(head).astype(U64)
    known = min(5, depth)
    for step, need in zip(steps, asked[1:], strict=True):
        tied = ~head
        tied[:-1] |= ~head[1:]
        tied &= need[places]
        places = places[tied]
        if not len(places):
            break
        first = rank[places]
        key = (first << bits | rank[places + step]) << bits | places.astype(U64)
        key.sort()
        places, head = ranked(key)
        first = key >> (bits + bits)
        group = np.ones(len(key), bool)
        np.not_equal(first[1:], first[:-1], out=group[1:])
        rank[places] = first + (begun(head) - begun(group)).astype(U64)
        known += step
    places = np.flatnonzero(wanted).astype(U64)
    key = rank[places.astype(np.int64)] << bits | places
    key.sort()
    return (key & low).astype(np.int64)


def common_prefixes(data: np.ndarray, place: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at place, ascending, and before; lengths over most may be cut to it."""
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    follows = np.zeros(len(place), bool)
    follows[1:] = (np.diff(place) == 1) & (np.diff(before) == 1)
    start = np.flatnonzero(~follows)
    a, b = place[start], before[start]
    length = np.zeros(len(start), np.int64)
    left = np.arange(len(start))
    while len(left):
        at = length[left]
        same = words[a[left] + at] == words[b[left] + at]
        run = np.where(same.all(1), 8, same.argmin(1))
        length[left] += run
        left = left[(run == 8) & (length[left] < most)]
    run = np.cumsum(~follows) - 1
    return length[run] - (place - place[start][run])


def repeated_windows(pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, order, head, again): the pieces end to end, their windows' places in suffix order, whether each differs
    from the one before, and for each byte of data whether a window starts there that starts anywhere else too."""
    data = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)  # 0xff is in no UTF-8 text
    ends = np.cumsum([len(p) + 1 for p in pieces])
    wanted = np.zeros(len(data) + 1, np.int8)
    wanted[np.concatenate([[0], ends[:-1]])] += 1
    wanted[ends - window] -= 1
    order = sort_suffixes(data, np.cumsum(wanted[:-1]) > 0, window)
    # predecessors in text order
    before = np.full(len(data), -1)
    before[order[1:]] = order[:-1]
    place = np.sort(order)
    place = place[before[place] >= 0]
    length = np.zeros(len(data), np.int64)
    length[place] = common_prefixes(data, place, before[place], max(map(len, pieces)))
    tied = length[order] >= window
    again = np.zeros(len(data), bool)
    again[order[tied]] = True
    again[before[order[tied]]] = True
    return data, order, ~tied, again


def stretches(again: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the marked windows."""
    at = np.flatnonzero(again)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > window)
    return [*zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + window).tolist(), strict=True)]


def _digest(data: memoryview) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


_KEYS = ["k1", "k2"]
_PIECE = ["anchor", "f1", "f2"]
_SEGMENTS = "anchor long, f1 long, f2 long, k1 long, k2 long, start int, count int"
_STRETCH = "anchor long, f1 long, f2 long, begin int, end int"
#: A covered stretch of a piece (run is null), or a key range of a shard's run.
_FOUND = f"{_STRETCH}, range int, run binary"
#: A window of a run: its key, its piece, its place there, and whether its shard has it once.
_ENTRY = np.dtype([("key", "S16"), ("anchor", "<i8"), ("f1", "<i8"), ("f2", "<i8"), ("begin", "<i4"), ("alone", "?")])


def _doc_keys(id_col: str) -> list[Column]:
    return [F.xxhash64("text").alias("k1"), F.xxhash64(id_col, F.col(id_col).isNull()).alias("k2")]


def _find_segments(window: int, gram: int):
    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = _text.text_buffers(batch.column(2))
            owner, found, digests = [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                cut = segments(data[a:b], window, gram)
                if cut:
                    found.append(cut)
                    owner.append(np.full(len(cut[0]), i))
                    view = memoryview(data[a:b])
                    digests += [_digest(view[s:e]) for s, e in zip(cut[1].tolist(), (cut[1] + cut[2] + window - 1).tolist(), strict=True)]
            if found:
                rows = pa.array(np.concatenate(owner))
                anchor, start, count = (np.concatenate(x) for x in zip(*found, strict=True))
                fingerprint = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                longs = (anchor.view(np.int64), *np.ascontiguousarray(fingerprint.T))
                columns = [*map(pa.array, longs), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [*_PIECE, *_KEYS, "start", "count"])

    return over


def _cut_pieces(window: int):
    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        wanted = batch.column(0)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        fields = wanted.flatten().flatten()  # anchor, f1, f2, shards, start, count
        offsets, data = _text.text_buffers(batch.column(1))
        view = memoryview(data)
        start = offsets[owner] + fields[4].to_numpy()
        end = start + fields[5].to_numpy() + (window - 1)
        pieces = [bytes(view[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([*fields[:4], pa.array(pieces, pa.binary())], [*_PIECE, "shards", "piece"])

    return over


def _sort_shards(window: int, ranges: int):
    """Pieces sorted by anchor and shard to covered stretches, and to the runs of anchors that other shards have too."""
    borders = np.array([(k * 2**32 // ranges).to_bytes(4, "big") for k in range(1, ranges)], "S16")

    def decided(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        pieces = [r[5] for r in held]
        data, order, head, again = repeated_windows(pieces, window)
        starts = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        names = np.array([r[:3] for r in held], np.int64)
        # no stretch reaches over two pieces, whose windows are more than window places apart
        spans = np.array(stretches(again, window), np.int64).reshape(-1, 2)
        owner = np.searchsorted(starts, spans[:, 0], "right") - 1
        places = (spans - starts[owner][:, None]).astype(np.int32)
        none = pa.nulls(len(spans), pa.int32()), pa.nulls(len(spans), pa.binary())
        columns = [*map(pa.array, np.ascontiguousarray(names[owner].T)), *map(pa.array, np.ascontiguousarray(places.T)), *none]
        yield pa.RecordBatch.from_arrays(columns, [*_PIECE, "begin", "end", "range", "run"])

        wide = np.array([r[3] > 1 for r in held])
        if wide.any():
            reps = order[head]
            owner = np.searchsorted(starts, reps, "right") - 1
            reps, owner = reps[wide[owner]], owner[wide[owner]]
            view = memoryview(data)
            run = np.zeros(len(reps), _ENTRY)
            run["key"] = [_digest(view[p : p + window]) for p in reps.tolist()]
            run["anchor"], run["f1"], run["f2"] = names[owner].T
            run["begin"], run["alone"] = reps - starts[owner], ~again[reps]
            run = run[np.argsort(run["key"])]
            parts = [(k, part.tobytes()) for k, part in enumerate(np.split(run, np.searchsorted(run["key"], borders))) if len(part)]
            none = [pa.nulls(len(parts), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([k for k, _ in parts], pa.int32()), pa.array([r for _, r in parts], pa.binary())], [*_PIECE, "begin", "end", "range", "run"])

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_bytes, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                here = row[0], row[4]  # anchor and shard
                if here != last and held_bytes >= SHARD_BYTES // 2:
                    yield from decided(held)
                    held, held_bytes = [], 0
                last = here
                held.append(row)
                held_bytes += len(row[5])
        if held:
            yield from decided(held)

    return over


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows that stand in two runs or more; runs: (ascending distinct keys, rows). Two at a time, by binary search."""
    twice = []
    while len(runs) > 1:
        merged = []
        for (a, x), (b, y) in zip(runs[::2], runs[1::2], strict=False):
            at = np.searchsorted(a, b)
            hit = np.zeros(len(b), bool)
            inside = at < len(a)
            hit[inside] = a[at[inside]] == b[inside]
            twice += [x[at[hit]], y[hit]]
            merged.append((np.insert(a, at[~hit], b[~hit]), np.insert(x, at[~hit], y[~hit])))
        runs = merged + runs[len(merged) * 2 :]
    return np.unique(np.concatenate(twice)) if twice else np.zeros(0, np.int64)


def _merge_shards(window: int):
    """Runs sorted by key range to the windows that two shards have and that are alone in theirs."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in grouped(batches, ["range"]):
            runs = [np.frombuffer(r, _ENTRY) for r in table["run"].to_pylist()]
            rows = np.concatenate(runs)
            ends = np.cumsum([0, *map(len, runs)])
            found = rows[merge_runs([(r["key"], np.arange(a, b)) for r, a, b in zip(runs, ends[:-1], ends[1:], strict=True)])]
            found = found[found["alone"]]
            columns = [np.ascontiguousarray(found[c]) for c in (*_PIECE, "begin")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(columns[3] + np.int32(window))], [*_PIECE, "begin", "end"])

    return over


def _remove(id_col: str, with_text: bool):  # columns: identifier, text, spans, n_shared_words
    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, runs, digests, kept_text = [], [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = text.encode()
            kept, last, gone, n = [], 0, 0, 0
            end = -1
            for span in sorted((s["begin"], s["end"]) for s in spans or ()):
                if span[0] > end:  # touching stretches are one run
                    n += 1
                begin = max(span[0], last)
                kept.append(raw[last:begin])
                gone += max(0, span[1] - begin)
                last, end = max(last, span[1]), max(end, span[1])
            kept.append(raw[last:])
            rest = b"".join(kept)
            counts.append(len(raw))
            removed.append(gone)
            runs.append(n)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept_text.append(rest if with_text else None)
        columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (counts, removed, runs)), pa.array(digests), pa.array(kept_text, pa.binary()), batch.column(3)]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_shared_words"])

    return over


def find_repeats(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """k1, k2, begin, end: stretches of bytes to remove, which may overlap. texts: k1, k2, text."""
    found = stage_table(texts.where(F.octet_length("text") >= window).select(*_KEYS, "text").mapInArrow(_find_segments(window, gram), _SEGMENTS))
    # read from a table, a join with it can be split where an anchor is frequent
    shared = stage_table(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    meeting = stage_table(found.join(shared, "anchor", "left_semi"))  # a fraction of all
    drop_table(found)
    drop_table(shared)

    place = F.struct(*_KEYS, "start", "count")
    distinct = stage_table(meeting.groupBy(*_PIECE).agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high")))
    laid = F.sum((F.col("low.count") + (window - 1)) * F.least("n", F.lit(2)))
    wide = stage_table(distinct.groupBy("anchor").agg(F.ceil(laid / (SHARD_BYTES // 2)).cast("int").alias("shards")).where("shards > 1"))
    ranges = 4 * (wide.agg(F.sum("shards")).first()[0] or 0) + 1
    copies = F.explode(F.when(F.col("n") > 1, F.array("low", "high")).otherwise(F.array("low"))).alias("at")
    wanted = distinct.join(wide, "anchor", "left").select(*_PIECE, F.coalesce("shards", F.lit(1)).alias("shards"), copies)
    per_text = wanted.groupBy("at.k1", "at.k2").agg(F.collect_list(F.struct(*_PIECE, "shards", "at.start", "at.count")).alias("pieces"))  # segments of one text
    pieces = map_arrow(per_text.join(texts, _KEYS).select("pieces", "text"), _cut_pieces(window), "anchor long, f1 long, f2 long, shards int, piece binary")
    pieces = pieces.select(*_PIECE, "shards", F.pmod("f1", "shards").cast("int").alias("shard"), "piece")
    sharded = stage_table(pieces.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(_sort_shards(window, ranges), _FOUND))

    runs = sharded.where("run is not null").select("range", "run").repartition("range").sortWithinPartitions("range")
    merged = runs.mapInArrow(_merge_shards(window), _STRETCH)
    covered = stage_table(sharded.where("run is null").select(*_PIECE, "begin", "end").unionByName(merged).distinct())
    spans = stage_table(meeting.join(covered, _PIECE).select(*_KEYS, (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end")))
    for done in (meeting, distinct, wide, sharded, covered):
        drop_table(done)
    return spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = True, words: int = shared_passages.WIDTH) -> DataFrame:
    """A row per document: identifier, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null if not with_text)
    and n_shared_words (words in runs of that many words that another row has too, removed or not)."""
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select("__id", "text", *_doc_keys("__id"))
    shared = shared_passages.shared_words(texts, words, min(shared_passages.GRAM, words))
    spans = find_repeats(texts, window, gram)
    per_text = spans.groupBy(*_KEYS).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))  # a set: rows may repeat
    joined = texts.join(per_text, _KEYS, "left").join(shared, _KEYS, "left").select("__id", "text", "spans", F.coalesce("n_shared_words", F.lit(0).cast("long")))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(joined, _remove(id_col, with_text), f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, n_shared_words long")
