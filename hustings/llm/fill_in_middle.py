"""Fill-in-the-middle rows: a text's middle moved to its end, marked by sentinels.

A text is cut into units by the zero-width boundary between two neighbouring classes of characters: each
grammar of units (`UNITS`) is translated to a pattern of lookarounds, and Spark's split at that pattern keeps every piece, so that
the pieces joined are the text. An empty text, which split gives as one empty piece, has no units and is handled by itself.
Two borders, and whether and how the row is rewritten, come from a hash of its identifier, so that reruns
and other partitions agree. Everything is an expression of a row; nothing is shuffled.

Defined cases: a null text is empty, and an empty text stays plain; so does one that holds a sentinel, since it couldn't be told apart from the
added ones. A null identifier is hashed as an empty string. Repeated rows are cut alike. Other columns stay as they are in `transform`, but for those
it adds, and play no part in `digests`. A text is held whole, with its units, by the task that has its row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE)))

#: name -> (grammar, classes): units as a regular expression finds them, and the neighbouring classes between which one ends.
UNITS = {
    "word": (rf"{SPACE}*{NOT_SPACE}+|{SPACE}+", [(NOT_SPACE, SPACE)]),
    "run": (rf"{SPACE}+|{NOT_SPACE}+", [(NOT_SPACE, SPACE), (SPACE, NOT_SPACE)]),
    "line": (r"[^\n]*\n|[^\n]+", [(r"\n", r"[\s\S]")]),
    "character": (r"[\s\S]", [(r"[\s\S]", r"[\s\S]")]),
}


def boundary(unit: str) -> str:
    """The zero-width pattern between two units."""
    return "|".join(f"(?<={left})(?={right})" for left, right in UNITS[unit][1])


def units(text: Column, unit: str = "word") -> Column:
    """The units of a text, an array; null and empty texts have none."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(unit), -1))


def _hashes(identifier: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, _SENTINELS, -1)  # what stands before the first sentinel is empty
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "output", seed: int = 42, rate: int = 50, spm: int = 80, unit: str = "word",
) -> DataFrame:
    """docs with n units, form (plain, psm or spm), prefix_chars, middle_chars (null where plain) and the output text.

    rate: per cent of texts that are rewritten; spm: per cent of those that begin with the suffix.
    """
    added = ["n", "form", "prefix_chars", "middle_chars", out_col]
    # the inputs under names of their own: columns of docs may be called as those added
    own = docs.select(F.struct("*").alias("__row"), F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    h = _hashes(F.col("__id"), seed)
    cut = own.withColumns({"__u": units(F.col("__text"), unit), "__h": F.array(*h)}).withColumn("__n", F.size("__u").cast("long"))
    at = lambda k: F.get("__h", F.lit(k))
    places = [at(k) % (F.col("__n") + 1) for k in (0, 1)]
    cut = cut.withColumns({"__a": F.least(*places).cast("int"), "__b": F.greatest(*places).cast("int")})
    piece = lambda a, n: F.array_join(F.slice("__u", a + 1, n), "")
    none = F.lit(0)
    held = F.col("__text").rlike(_SENTINELS)
    form = F.when((F.col("__text") == "") | held | (at(2) % 100 >= rate), "plain").when(at(3) % 100 < spm, "spm").otherwise("psm")
    parts = cut.select(
        "__row", "__text", "__n", form.alias("__form"), piece(none, F.col("__a")).alias("__p"), piece(F.col("__a"), F.col("__b") - F.col("__a")).alias("__m"),
        piece(F.col("__b"), F.col("__n").cast("int") - F.col("__b")).alias("__s"),
    )
    plain = F.col("__form") == "plain"
    p, s, m = (F.col(f"__{x}") for x in "psm")
    output = F.when(plain, F.col("__text")).when(F.col("__form") == "psm", F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m)).otherwise(F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m))
    chars = lambda c: F.when(~plain, F.length(c).cast("long"))
    values = [F.col("__n"), F.col("__form"), chars(p), chars(m), output]
    return parts.select(*(F.col("__row")[c].alias(c) for c in docs.columns if c not in added), *(v.alias(c) for c, v in zip(added, values, strict=True)))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """A row per document: identifier, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256."""
    made = transform(docs.select(F.col(f"`{id_col}`").alias("__doc"), F.col(f"`{text_col}`").alias("__words")), "__doc", "__words", **settings)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    restored = restore(F.col("output"), F.col("form"))
    return made.select(F.col("__doc").alias(id_col), "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored).alias("restored_sha256"))
