"""Columns over BIO tags."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import kernels
from .passes import arrow


def _refuse(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(value, F.lit("null"))))


def position(tag: Column) -> Column:
    """B, I, O or what else stands before the first hyphen."""
    return F.substring_index(tag, "-", 1)


def entity_type(tag: Column) -> Column:
    """What follows the first hyphen; null for O and for a tag without a type."""
    return F.when(F.instr(tag, "-") > 0, F.regexp_extract(tag, r"^[^-]*-(.*)$", 1))


def checked(tag: Column) -> Column:
    """The tag if it is O or has two parts that aren't empty; anything else stops the job."""
    return F.when((tag == "O") | tag.rlike("^[^-]+-(?s:.+)$"), tag).otherwise(_refuse("not a BIO tag: ", tag))


def bioes_to_bio(tag: Column) -> Column:
    """E becomes I and S becomes B; other positions than B, I, O, E and S stop the job."""
    p = position(tag)
    new = F.when(p == "E", "I").when(p == "S", "B").when(p.isin("B", "I", "O"), p).otherwise(_refuse("unknown position: ", tag))
    return F.when(entity_type(tag).isNull(), new).otherwise(F.concat_ws("-", new, entity_type(tag)))


def type_only(value: Column) -> Column:
    """Tags that are types alone stand inside; O stays."""
    return F.when(value == "O", value).otherwise(F.concat(F.lit("I-"), value))


def inverted(tag: Column) -> Column:
    """PERS-B as B-PERS, and 0 as O."""
    return F.when(tag == "0", "O").otherwise(F.concat_ws("-", F.reverse(F.split(tag, "-"))))


def from_index(index: Column, labels: dict[int, str]) -> Column:
    """Tags from numbers; an unknown number stops the job."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.element_at(table, index), _refuse("no label for ", index.cast("string")))


def strict(value: Column, table: dict[str, str]) -> Column:
    """A value by a table; one that isn't in it stops the job."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair]) if table else F.lit(None).cast("map<string,string>")
    return F.coalesce(F.element_at(known, value), _refuse("not in the label map: ", value))


def tag_table(labels: dict[str, str]) -> dict[str, str]:
    """The table of labels for whole tags."""
    return {f"{p}-{a}": f"{p}-{b}" for a, b in labels.items() for p in "BI"} | {"O": "O"}


# --- whole arrays of tags: each different tag of a batch goes through its rule once -----------------------------------


def of_each(values: Column, rule: Callable[[str | None], str | None]) -> Column:
    """An array of strings, each put through a rule; the rule may stop the job."""

    def run(lists: pa.Array) -> pa.Array:
        return kernels.by_value(lists, rule)

    return arrow(run, "array<string>")(values)


def checked_one(tag: str | None) -> str | None:
    """checked() for one tag; null stays."""
    head, _, tail = (tag or "").partition("-")
    if tag is None or tag == "O" or (head and tail):
        return tag
    raise ValueError(f"not a BIO tag: {tag}")


def _from_bioes(tag: str | None) -> str | None:
    if tag is None:
        return None
    head, hyphen, tail = tag.partition("-")
    if head not in ("B", "I", "O", "E", "S"):
        raise ValueError(f"unknown position: {tag}")
    return {"E": "I", "S": "B"}.get(head, head) + hyphen + tail


def each_checked(tags: Column) -> Column:
    """checked() for an array of tags."""
    return of_each(tags, checked_one)


def each_bioes_to_bio(tags: Column) -> Column:
    """bioes_to_bio() for an array of tags."""
    return of_each(tags, _from_bioes)


def inverted_one(tag: str | None) -> str | None:
    """inverted() for one tag; null stays."""
    return tag and ("O" if tag == "0" else "-".join(reversed(tag.split("-"))))


def each_type_only(values: Column) -> Column:
    """type_only() for an array of values."""
    return of_each(values, lambda v: v if v in (None, "O") else f"I-{v}")


def each_inverted(tags: Column) -> Column:
    """inverted() for an array of tags."""
    return of_each(tags, inverted_one)


def each_strict(values: Column, table: dict[str, str]) -> Column:
    """strict() for an array of values."""

    def rule(value: str | None) -> str | None:
        if value not in table:
            raise ValueError(f"not in the label map: {value}")
        return table[value]

    return of_each(values, rule)
