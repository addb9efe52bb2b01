"""House-number specifications: free text to nested rules, an Arrow batch of entries at a time.

A parsed entry is a struct: street, street_norm, parity, cls (WHOLE, RANGE, ENUM or
INSTITUTION), number_kind (orientacne or supisne), spec (ranges of lo, hi, parity;
singles; raw) and parse_warning, which is set where an entry with digits fell back to
a whole street. The grammar is in hustings.functions.entries; entries are rows, so that
documents of any number parse side by side, and plans that read the result stay small.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from hustings.functions import entries
from hustings.functions.text import let, norm

RANGE_TYPE = "struct<lo:int,hi:int,parity:string>"
SPEC_TYPE = f"struct<ranges:array<{RANGE_TYPE}>,singles:array<string>,raw:string>"
_ENTRY_TYPE = f"struct<street:string,key:string,parity:string,cls:string,number_kind:string,spec:{SPEC_TYPE},parse_warning:boolean>"

_RANGE = pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("parity", pa.string())])
_SPEC = pa.struct([("ranges", pa.list_(_RANGE)), ("singles", pa.list_(pa.string())), ("raw", pa.string())])
_ENTRY = pa.struct([("street", pa.string()), ("key", pa.string()), ("parity", pa.string()), ("cls", pa.string()), ("number_kind", pa.string()), ("spec", _SPEC), ("parse_warning", pa.bool_())])


def _apply(function: Callable[[str], Any], ddl: str, kind: pa.DataType) -> Callable[[Column], Column]:
    """function over the strings of a column; null stays null."""

    def over(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else function(t) for t in texts.to_pylist()], kind)

    return F.arrow_udf(over, ddl)


def _spec(spec: tuple | None) -> dict | None:
    return spec and {"ranges": [dict(zip(("lo", "hi", "parity"), r, strict=True)) for r in spec[0]], "singles": spec[1], "raw": spec[2]}


def _struct(parse: Callable[[str], entries.Entry]) -> Callable[[str], dict]:
    def made(text: str) -> dict:
        found = parse(text)
        return found._asdict() | {"spec": _spec(found.spec)}

    return made


def _normed(parsed: Column) -> Column:
    names = ("parity", "cls", "number_kind", "spec", "parse_warning")
    return let(parsed, lambda p: F.struct(p["street"].alias("street"), norm(p["key"]).alias("street_norm"), *(p[n].alias(n) for n in names)))


def parse_street_spec(entry: Column) -> Column:
    """One entry in the plain form ("Building 1-7, 9-31 (nepárne)") as a parsed struct."""
    return _normed(_apply(_struct(entries.parse), _ENTRY_TYPE, _ENTRY)(entry))


def parse_entry(entry: Column) -> Column:
    """An entry of a municipal document as a parsed struct: prose, parity words and streets named after dates included."""
    return _normed(_apply(_struct(entries.parse_prose), _ENTRY_TYPE, _ENTRY)(entry))


def prose_range(entry: Column) -> Column:
    """Ranges told in prose ("párne čísla od 2 do 20") in the plain form, "2-20 (párne)"."""
    return _apply(entries.plain, "string", pa.string())(entry)


def number_cell(cell: Column) -> Column:
    """A cell of house numbers in the plain form; one that names both parities stays."""
    return _apply(entries.number_cell, "string", pa.string())(cell)


def split_glued(entry: Column) -> Column:
    """Two entries where numbers are followed by a capitalised name without digits, else one."""
    return _apply(entries.unglue, "array<string>", pa.list_(pa.string()))(entry)


def expand_multi(entry: Column) -> Column:
    """One entry per number list where a street has several; a parity named once holds for all of them."""
    return _apply(entries.lists_of, "array<string>", pa.list_(pa.string()))(entry)


def normalize_entry(entry: Column) -> Column:
    """Glued streets apart, then several number lists apart."""
    return _apply(entries.normalized, "array<string>", pa.list_(pa.string()))(entry)


def split_entries(text: Column) -> Column:
    """A comma list of entries; fragments of numbers or a lone parity word stay with the entry before them."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(F.trim(text), r"\.\s*$", ""), ","), lambda p: F.trim(p)), lambda p: p != "")
    goes_on = lambda f: f.rlike(r"(?iu)^(\d|\(?(ne)?párne\)?$)")
    # an entry opens at a part that stands alone; the parts up to the next one are joined
    marked = F.transform(parts, lambda p, i: F.concat(F.when((i > 0) & goes_on(p), ", ").otherwise("\n"), p))
    return F.filter(F.split(F.array_join(marked, ""), "\n"), lambda e: e != "")
