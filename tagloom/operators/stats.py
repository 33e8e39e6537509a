"""Counts of splits, words and languages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.passes import arrow, bounded
from ..functions.text import IGNORED_LANGUAGES, is_number, is_punctuation, primary_language, words

WORD_STATS = T.StructType(
    [
        T.StructField("dataset_name", T.StringType()),
        T.StructField("subset_hierarchy", T.ArrayType(T.StringType())),
        T.StructField("split_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("sequence_id", T.BinaryType()),
        *(T.StructField(c, T.LongType()) for c in ("document_index", "document_position")),
        *(T.StructField(c, T.LongType()) for c in ("total_token_count", "number_count", "punctuation_count", "word_count")),
    ]
)


def token_counts(tokens: Column) -> list[Column]:
    """total_token_count, number_count, punctuation_count, word_count of an array of tokens."""
    count = lambda x: F.size(x).cast("long")
    total, numbers, marks = count(tokens), count(F.filter(tokens, is_number)), count(F.filter(tokens, is_punctuation))
    return [
        total.alias("total_token_count"),
        numbers.alias("number_count"),
        marks.alias("punctuation_count"),
        (total - numbers - marks).alias("word_count"),
    ]


def word_stats(rows: DataFrame, keys: list[str], tokens: Column | None = None) -> DataFrame:
    """Counts of each row: of its tokens, or else of its words between blanks. Other languages need a tokenizer: tokenized()."""
    return rows.select(*keys, *token_counts(words(F.col("text")) if tokens is None else tokens))


def tokenized(rows: DataFrame, tokenizers: dict[str, Callable[[str], list[str]]], language: str = "language", text: str = "text") -> DataFrame:
    """Adds tokens by a word tokenizer per language, in Arrow batches; a language without one stops the job unless rows have
    tokens already."""
    had = "tokens" in rows.columns
    schema = rows.schema if had else T.StructType([*rows.schema.fields, T.StructField("tokens", T.ArrayType(T.StringType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, (code, line) in enumerate(zip(frame[language], frame[text], strict=True)):
                if code in tokenizers:
                    out.append(list(tokenizers[code](line)))
                elif had and frame["tokens"].iloc[i] is not None:
                    out.append(list(frame["tokens"].iloc[i]))
                else:
                    raise ValueError(f"no tokenizer for {code}")
            yield frame.assign(tokens=out)

    bounded(rows.sparkSession)
    return rows.mapInPandas(run, schema)


def number_of_tokens(text: Column, tokenizer: Callable[[str], list[str]]) -> Column:
    """How many tokens a tokenizer gives, in Arrow batches; a null text has none."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([len(tokenizer(t or "")) for t in texts.to_pylist()], pa.int64())

    return arrow(run, "bigint")(text)


def append_stats(done: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Former rows, and the rows of datasets that they don't have."""
    if done is None:
        return fresh
    return done.unionByName(fresh.join(done.select("dataset_name").distinct(), "dataset_name", "left_anti"))


def split_counts(rows: DataFrame, by: tuple[str, ...], document: tuple[str, ...] = ("document_index",)) -> DataFrame:
    """document_count and sequence_count of each group, in one pass over documents."""
    documents = rows.groupBy(*by, *document).agg(F.count("*").alias("n"))
    return documents.groupBy(*by).agg(F.count("*").alias("document_count"), F.sum("n").alias("sequence_count"))


def languages(rows: DataFrame, language: str = "language") -> DataFrame:
    """One row: the sorted primary languages that aren't ignored."""
    codes = rows.select(primary_language(F.col(language)).alias("code")).distinct().where(~F.col("code").isin(*IGNORED_LANGUAGES))
    return codes.agg(F.sort_array(F.collect_list("code")).alias("languages"))
