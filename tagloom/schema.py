"""Schemas of the tables that all operators share."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("stop", T.LongType(), False)])
ANNOTATION = T.StructType(
    [T.StructField("label", T.StringType(), False), T.StructField("spans", T.ArrayType(SPAN, False), False)]
)
ANNOTATIONS = T.ArrayType(ANNOTATION, False)
TAGS = T.ArrayType(T.StringType(), False)
DEFAULT_TAGSET = "ner"
#: Codes on disk.
SEQUENCE_TYPES = {"sentence": 0, "passage": 1}

SENTENCE_OFFSETS = T.StructType(
    [T.StructField("sequence_id", T.BinaryType(), False), T.StructField("sentence_offsets", T.ArrayType(SPAN), False)]
)


def sequence_schema(tagsets: list[str] | tuple[str, ...] = (DEFAULT_TAGSET,), tokenized: bool = False) -> T.StructType:
    """Columns in their fixed order: six of each row, tokens if there are any, annotations, then tags."""
    note = {"sequence_types": json.dumps(SEQUENCE_TYPES), "tagsets": json.dumps(list(tagsets))}
    fields = [
        T.StructField("sequence_id", T.BinaryType(), False, note),
        T.StructField("document_index", T.LongType(), False),
        T.StructField("document_position", T.LongType(), False),
        T.StructField("sequence_type", T.ShortType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("space_after", T.StringType(), False),
    ]
    if tokenized:
        fields.append(T.StructField("tokens", TAGS, False))
    fields += [T.StructField(name, ANNOTATIONS) for name in tagsets]
    if tokenized:
        fields += [T.StructField(f"{name}_iob", TAGS) for name in tagsets]
    return T.StructType(fields)


def tagsets_of(schema: T.StructType) -> list[str]:
    """The tagsets that a table was written with, from its metadata or else from its columns' types."""
    for field in schema.fields:
        if "tagsets" in field.metadata:
            return json.loads(field.metadata["tagsets"])
    shape = ANNOTATIONS.simpleString()
    return [f.name for f in schema.fields if f.dataType.simpleString() == shape]


def signed(df: DataFrame) -> DataFrame:
    """Unsigned integers, which Spark reads as wide decimals or small integers, as the types of the schema."""
    casts = {"document_index": "bigint", "document_position": "bigint", "sequence_type": "smallint"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})
