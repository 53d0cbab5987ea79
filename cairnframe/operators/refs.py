"""External references: appending without repeats, ordered extraction, candidate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import clean

KEY_FIELDS = ("system", "ref_type", "external_id", "url")


def reference_key(ref: Column, fields: tuple[str, ...] = KEY_FIELDS) -> Column:
    """What makes two references the same: the trimmed fields, null as empty."""
    return F.struct(*(clean(ref[f]).alias(f) for f in fields))


def append_unique(target: Column, more: Column, fields: tuple[str, ...] = KEY_FIELDS) -> Column:
    """`target` and those of `more` whose key neither it nor an earlier one of `more` has, in order."""
    base, add = F.coalesce(target, F.slice(more, 1, 0)), more
    known = F.transform(base, lambda r: reference_key(r, fields))
    keys = F.transform(add, lambda r: reference_key(r, fields))
    fresh = F.filter(add, lambda r, i: ~F.array_contains(known, reference_key(r, fields)) & (F.array_position(keys, reference_key(r, fields)) == i + 1))
    return F.concat(base, fresh)


def reference_ids(refs: Column, system: str, ref_type: str | None = None) -> Column:
    """External ids of one system in order, blanks dropped."""
    kept = F.filter(refs, lambda r: (r["system"] == system) & ((r["ref_type"] == ref_type) if ref_type else F.lit(True)))
    return F.filter(F.transform(kept, lambda r: clean(r["external_id"])), lambda v: v != "")


def first_reference_id(refs: Column, system: str) -> Column:
    return F.get(reference_ids(refs, system), 0)


def pig_urls(refs: Column) -> Column:
    """The url of each PIG reference that has one, else its external id if it is of type url."""
    own = F.filter(refs, lambda r: r["system"] == "PIG")
    values = F.transform(own, lambda r: F.when(clean(r["url"]) != "", clean(r["url"])).when(r["ref_type"] == "url", clean(r["external_id"])))
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def tpn_globalids(refs: Column, measurements: Column) -> Column:
    """TPN global ids of the references, then those in the source references TPN:{...} of all measurements."""
    named = F.transform(measurements, lambda m: F.regexp_extract(F.coalesce(m["source_ref"], F.lit("")), r"^TPN:(\{.*\})$", 1))
    return F.concat(reference_ids(refs, "TPN", "source_globalid"), F.filter(named, lambda v: v != ""))
