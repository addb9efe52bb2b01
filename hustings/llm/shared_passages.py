"""Words of each document that stand in a passage which another document has too.

A word is shared if it lies in a run of WIDTH consecutive words (maximal runs of
anything but ASCII white space) that another row also holds, whatever its bytes
and the white space between its words. Repeats within one row don't count.

1. A window of WIDTH words is known by the GRAM words in it with the smallest hash,
   the leftmost of equal ones: its anchor. A document falls into runs of windows
   with one anchor place, its pieces, and only pieces of one anchor can share windows.
2. Pieces are exchanged as an anchor and a hash. Anchors of a single row end here;
   a piece that two rows have is shared whole.
3. Other pieces of shared anchors are decided window by window: one copy of each
   piece of such an anchor gives its windows' hashes, and those of two rows are shared.
   All windows of a piece contain its anchor, so that what they cover is one stretch.

Nothing is capped, and every step is linear in the windows. Windows are equal when
their anchors' hashes and their own, of 64 bits each, are equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import _text
from hustings.llm._spark import drop_table, map_arrow, stage_table
from hustings.llm._text import U64

#: More than 50 words.
WIDTH, GRAM = 51, 12
_PLACE = U64((1 << 26) - 1)
_KEYS = ["k1", "k2"]
_PIECE = ["anchor", "hash", "count"]
_PIECES = "anchor long, hash long, count int, row long, k1 long, k2 long, start int"
_WINDOWS = "anchor long, hash long, count int, low long, many boolean, at int, window long"


def _sums(hashes: np.ndarray) -> np.ndarray:
    up, _ = _text.powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return sums


def _runs(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of words."""
    _, down = _text.powers(len(sums))
    return _text.mix((sums[end] - sums[start]) * down[start])


def pieces(words: _text.Words, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, start in it, windows, anchor, hash) of each run of windows with one anchor place."""
    n = len(words.hashes)
    begin, end = words.offsets[:-1], words.offsets[1:]
    inside = np.zeros(n + 1, np.int32)
    long = end - begin >= width
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, end[long] - width + 1, -1)
    window = np.flatnonzero(np.cumsum(inside) > 0)  # no window reaches into the next document
    if not len(window):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    sums = _sums(words.hashes)
    at = np.arange(n - gram + 1)
    grams = _runs(sums, at, at + gram)
    place = _text.window_minimum(grams & ~_PLACE | at.astype(U64) & _PLACE, width - gram + 1)[window] & _PLACE
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (np.diff(window) > 1)]))
    start, count = window[head], np.diff(np.append(head, len(window)))
    # the anchor of a window is less than width places on
    anchor = grams[start + ((place[head].astype(np.int64) - start) & int(_PLACE))]
    doc = np.searchsorted(words.offsets, start, "right") - 1
    return doc + words.first, start - words.offsets[doc], count, anchor.view(np.int64), _runs(sums, start, start + count + width - 1).view(np.int64)


def _find_pieces(width: int, gram: int):
    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for words in _text.words(batch.column(2), _text.NOT_SPACE, False):
                doc, start, count, anchor, hashes = pieces(words, width, gram)
                if len(doc):
                    rows = pa.array(doc)
                    columns = [pa.array(anchor), pa.array(hashes), pa.array(count.astype(np.int32)), pa.array(doc + row), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, [*_PIECE, "row", *_KEYS, "start"])
            row += batch.num_rows

    return over


def _cut_windows(width: int):
    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0)
            lists = wanted.offsets.to_numpy()
            anchor, hashes, count, low, many, start = wanted.values.flatten()
            for words in _text.words(batch.column(1), _text.NOT_SPACE, False):
                texts = np.arange(words.first, words.first + len(words.offsets) - 1)
                some = np.arange(lists[texts[0]], lists[texts[-1] + 1])
                if not len(some):
                    continue
                owner = np.repeat(texts, lists[texts + 1] - lists[texts]) - words.first
                n = count.to_numpy()[some]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = np.repeat(words.offsets[owner] + start.to_numpy()[some], n) + at
                found = _runs(_sums(words.hashes), window, window + width).view(np.int64)
                piece = pa.array(np.repeat(some, n))
                yield pa.RecordBatch.from_arrays([*(c.take(piece) for c in (anchor, hashes, count, low, many)), pa.array(at.astype(np.int32)), pa.array(found)], [*_PIECE, "low", "many", "at", "window"])

    return over


def shared_words(texts: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """k1, k2, n_shared_words of the texts that share any. texts: k1, k2 (a document's keys), text. The result is staged."""
    found = stage_table(texts.select(*_KEYS, "text").mapInArrow(_find_pieces(width, gram), _PIECES))
    # read from a table, a join with it can be split where an anchor is frequent
    shared = stage_table(found.groupBy("anchor").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("anchor"))
    meeting = stage_table(found.join(shared, "anchor", "left_semi"))
    drop_table(found)
    drop_table(shared)

    place = F.min(F.struct("row", *_KEYS, "start")).alias("place")
    distinct = stage_table(meeting.groupBy(*_PIECE).agg(place, F.max("row").alias("high")).select(*_PIECE, "place.*", (F.col("row") < F.col("high")).alias("many")))
    open_ = stage_table(distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.min("many").alias("whole")).where("n > 1 and not whole").select("anchor"))
    wanted = F.collect_list(F.struct(*_PIECE, F.col("row").alias("low"), "many", "start")).alias("pieces")
    per_text = distinct.join(open_, "anchor", "left_semi").groupBy(*_KEYS).agg(wanted)
    windows = stage_table(per_text.join(texts.select(*_KEYS, "text"), _KEYS).select("pieces", "text").mapInArrow(_cut_windows(width), _WINDOWS))

    met = windows.groupBy("anchor", "window").agg(F.min("low").alias("low"), F.max("low").alias("high"), F.max("many").alias("many")).where("many or low < high")
    parts = windows.where("not many").join(met.select("anchor", "window"), ["anchor", "window"]).groupBy(*_PIECE).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    whole = distinct.where("many").select(*_PIECE, F.lit(0).alias("first"), (F.col("count") - 1).alias("last"))
    covered = stage_table(whole.unionByName(parts))
    stretch = F.struct((F.col("start") + F.col("first")).alias("begin"), (F.col("start") + F.col("last") + width).alias("end"))
    per_text = meeting.join(covered, _PIECE).groupBy(*_KEYS).agg(F.sort_array(F.collect_set(stretch)).alias("found"))  # a set: rows may repeat
    count = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda done, x: F.struct(F.greatest(done["at"], x["end"]).alias("at"), (done["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(done["at"], x["begin"]))).alias("n")),
        lambda done: done["n"],
    )
    result = stage_table(per_text.select(*_KEYS, count.alias("n_shared_words")))
    for done in (meeting, distinct, open_, windows, covered):
        drop_table(done)
    return result
