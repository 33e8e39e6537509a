"""Deterministic ids: UUIDs of version 5, from SHA-1, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of sequence ids.
NAMESPACE = "c9d3a311-7c27-4a86-b6fb-a52aa9f53b63"


def little_endian(number: Column, width: int = 64) -> Column:
    """A non-negative integer as `width` bytes in hexadecimal, least first."""
    big = F.lpad(F.hex(number.cast("long")), 16, "0")
    pairs = [F.substring(big, 15 - 2 * i, 2) for i in range(8)]
    return F.rpad(F.concat(*pairs), 2 * width, "0")


def uuid5(name_hex: Column, namespace: str = NAMESPACE) -> Column:
    """16 bytes. name_hex: the name's bytes in hexadecimal."""
    digest = F.sha1(F.unhex(F.concat(F.lit(namespace.replace("-", "")), name_hex)))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)) + 8
    text = F.concat(F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), F.lower(F.hex(variant.cast("long"))), F.substring(digest, 18, 15))
    return F.unhex(text)


def _prefix(dataset: Column, subset: Column, split: Column) -> Column:
    return F.hex(F.encode(F.concat_ws(" ", dataset, subset, split), "UTF-8"))


def sequence_id(dataset: Column, subset: Column, split: Column, document: Column, position: Column, namespace: str = NAMESPACE) -> Column:
    """The id of a row by its split, document and position."""
    return uuid5(F.concat(_prefix(dataset, subset, split), little_endian(document), little_endian(position)), namespace)


def segment_id(file_name: Column, index: Column, namespace: str = NAMESPACE) -> Column:
    """The id of a row of sentence offsets by its file and running number."""
    return uuid5(F.concat(F.hex(F.encode(file_name, "UTF-8")), little_endian(index)), namespace)


def uuid_text(id_: Column) -> Column:
    """8-4-4-4-12 in lower case."""
    h = F.lower(F.hex(id_))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def uuid_bytes(text: Column) -> Column:
    return F.unhex(F.regexp_replace(text, "-", ""))
