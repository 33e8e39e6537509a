"""CoNLL files of many dialects, as one DataFrame program: lines, segments, documents, columns, tags."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import spans as sp
from ..functions import tags as tag
from ..functions.passes import arrow, bounded
from ..functions.text import SPACE, strip
from ..operators.documents import detokenize
from ..registry import Registry
from ..schema import DEFAULT_TAGSET
from . import conll_lines


def _checked(value: str | None) -> str | None:
    """A tag; none at all stops the job as well as one that is no BIO tag."""
    return tag.checked_one("null" if value is None else value)


@dataclass(frozen=True)
class Dialect:
    """fields: names of the columns; docstart: how a line begins that opens a document, if any; ignore_docstart: such lines
    are left out, and each sentence is a document; comments: lines of # before a sentence are metadata, and
    document_comment, a pattern, marks a document's first sentence (None: every sentence is a document). tag, form: rules for single values."""

    fields: tuple[str, ...]
    docstart: str | None = None
    ignore_docstart: bool = True
    comments: bool = False
    document_comment: str | None = None
    tag: Callable[[str | None], str | None] = _checked
    form: Callable[[str | None], str | None] | None = None


# Keys of dialects, their columns and marks.
DIALECTS: Registry[Dialect] = Registry("dialect")
_TWO, _START = ("form", "ner"), "-DOCSTART-"
for _name, _dialect in {
    "conll": Dialect(_TWO),
    "conll_bio_first": Dialect(("ner", "form")),
    "conll_with_pos": Dialect(("form", "pos", "ner")),
    "conll_weibo_ner": Dialect(_TWO, form=conll_lines.one_character),
    "conll_herodotos": Dialect(("ner", "form"), tag=lambda t: tag.inverted_one(t or "")),
    "conllu": Dialect(("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc"), comments=True, document_comment="newdoc"),
    "conllu_plus": Dialect(("form", "lemma", "upos", "xpos", "feats", "ner", "emmorph_lemma"), comments=True),
    "conllu_uner": Dialect(("id", "form", "ner", "original_ner", "annotator"), comments=True, document_comment=r"^#\s*newdoc id\s*="),
    "conllu_uner_newpar": Dialect(("id", "form", "ner", "original_ner", "annotator"), comments=True, document_comment=r"^#\s*newpar\s*$"),
    "ner_suite": Dialect(("ner", "start", "end", "form", "lemma", "pos", "chunk")),
    "conll2003": Dialect(("form", "pos", "chunk", "ner"), _START, False),
    "conll2003_ignore_docstart": Dialect(("form", "pos", "chunk", "ner"), _START, True),
    "conll2003_two_column": Dialect(_TWO, _START, False),
    "conll2003_pioner": Dialect(("form", "pos", "chunk", "ner"), _START, False),
    "conll_jnlpba": Dialect(_TWO, "###MEDLINE:", False),
    "conll_stackoverflow_ner": Dialect(("form", "ner", "form_2", "markdown"), _START, False),
}.items():
    DIALECTS.register(_name)(_dialect)


@F.arrow_udf(returnType=T.LongType())
def _places(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Numbers of lines from where the part of a file begins that a task reads, and what tells apart the parts."""
    part, done = None, 0
    for start, mark in parts:
        a, b = (np.asarray(x, np.int64) for x in (start, mark))
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if len(a):
            fresh[0] = part != (a[0], b[0])
            nth, first = np.arange(len(a)), np.maximum.accumulate(np.where(fresh, np.arange(len(a)), -1))
            nth = np.where(first < 0, nth + done, nth - first)
            part, done = (a[-1], b[-1]), int(nth[-1]) + 1
            a = a + (a > 0) + nth
        yield pa.array(a)


def parts(spark: SparkSession, paths: str | list[str], end: str = "\n") -> DataFrame:
    """source, line_no, line of text files, read in parts, of lines that end as told. line_no is the number of the line in its file
    as long as one task reads it; in the later parts of a file numbers rise with the lines but leave gaps: they begin at the
    number of bytes before. A byte order mark that begins a file is no part of its first line."""
    bounded(spark)
    m = "_metadata."
    rows = spark.read.text(paths, lineSep=end).select(F.col(f"{m}file_path").alias("source"), F.col(f"{m}file_block_start").alias("_start"), F.col("value").alias("line"))
    number = _places.asNondeterministic()("_start", F.xxhash64("source"))
    return rows.withColumn("line_no", number).select("source", "line_no", "line")


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """source, line_no, line of text files, without what ends a line; see parts()."""
    return parts(spark, paths).withColumn("line", F.regexp_replace("line", "\r+$", ""))


# --- preprocessors -----------------------------------------------------------------------------------------------

PREPROCESSORS: Registry[Callable[[DataFrame], DataFrame]] = Registry("preprocessor")


@PREPROCESSORS.register("stackoverflow_ner")
def _stackoverflow(rows: DataFrame) -> DataFrame:
    """Segments of metadata or of left-out code go; those that begin a question, an answer or a repository open a document."""
    seg = segments(rows, strict_blank=False, keep_blank=True)
    w = W.partitionBy("source", "segment")
    first = F.first("line").over(w.orderBy("line_no"))
    code = F.max(F.col("line").rlike(r"^(CODE_BLOCK|names\.CODE_BLOCK)")).over(w)
    text = F.col("segment").isNotNull()
    gone = text & (first.rlike("^(Question_URL|OP_BLOCK|Issue_Event_Link)") | code)
    opens = text & ~gone & first.rlike("^(Answer_to_Question_ID|Question_ID|Repository_Name)")
    marked = seg.withColumns({"_gone": gone, "_opens": opens, "_first": F.row_number().over(w.orderBy("line_no")) == 1})
    kept = marked.where(~F.col("_gone") & (~F.col("_opens") | F.col("_first")))
    return kept.select("source", "line_no", F.when(F.col("_opens"), F.lit(_START)).otherwise(F.col("line")).alias("line"))


@PREPROCESSORS.register("e-ner")
def _e_ner(rows: DataFrame) -> DataFrame:
    """CSV of form and tag: P is O, LOC is LOCATION, a line without a form that is O is blank."""
    cells = F.from_csv(F.when(F.col("line") == "", None).otherwise(F.col("line")), "form string, tag string", {"quote": '"', "escape": '"'})
    form, t = F.coalesce(cells["form"], F.lit("")), cells["tag"]
    new = F.when(t == "P", "O").when(t.endswith("LOC"), F.concat(F.substring_index(t, "-", 1), F.lit("-LOCATION"))).otherwise(t)
    blank = cells.isNull() | t.isNull() | ((form == "") & (t == "O"))
    return rows.withColumn("line", F.when(blank, "").otherwise(F.concat_ws("\t", form, new)))


#: Marks that stand for no token.
_MARKUP = ["<li>", "</li>", "<center>", "</poem>", "<ref>", "</ref>", "<![CDATA[", "//", "﻿"]


@PREPROCESSORS.register("pioner")
def _pioner(rows: DataFrame) -> DataFrame:
    """Lines of markup go, and <nowiki/> and a leading <ref> within lines."""
    kept = rows.where(~F.substring_index("line", " ", 1).isin(_MARKUP))
    return kept.withColumn("line", F.regexp_replace("line", "<nowiki/>|^<ref>", ""))


@PREPROCESSORS.register("nytk_nerkor")
def _nerkor(rows: DataFrame) -> DataFrame:
    """A tag that begins neither with B nor I nor O is O; it stands last but one."""
    cells = F.split("line", "\t")
    n = F.size(cells)
    wrong = (strip(F.col("line")) != "") & ~F.col("line").startswith("#") & (n >= 3) & ~F.get(cells, n - 2).rlike("^[BIO]")
    fixed = F.concat_ws("\t", F.slice(cells, F.lit(1), F.greatest(n - 2, F.lit(0))), F.lit("O"), F.element_at(cells, -1))
    return rows.withColumn("line", F.when(wrong, fixed).otherwise(F.col("line")))


# --- segments, documents, rows -----------------------------------------------------------------------------------


def segments(rows: DataFrame, strict_blank: bool = True, keep_blank: bool = False) -> DataFrame:
    """Adds segment, the number of a run of lines between blank ones. Blank lines go, or stay with a null segment. Lines of
    white space alone are blank too unless strict_blank."""
    blank = (F.col("line") == "") if strict_blank else F.col("line").rlike(f"^{SPACE}*$")
    marked = rows.withColumn("_blank", blank)
    order = W.partitionBy("source").orderBy("line_no")
    before = F.lag("_blank", 1, True).over(order)
    marked = marked.withColumn("_new", (~F.col("_blank") & before).cast("int"))
    out = marked.withColumn("segment", F.when(~F.col("_blank"), F.sum("_new").over(order).cast("long") - 1)).drop("_new", "_blank")
    return out if keep_blank else out.where(F.col("segment").isNotNull())


def key_value(comment: Column) -> Column:
    """struct(key, value) of a comment `# key = value`; key null for another comment."""
    pattern = r"^#\s*([^=]+?)\s*=\s*(.+?)\s*$"
    key = F.regexp_extract(comment, pattern, 1)
    return F.struct(F.when(key != "", key).alias("key"), F.when(key != "", F.regexp_extract(comment, pattern, 2)).otherwise(F.regexp_replace(comment, r"^#\s*", "")).alias("value"))


def null_token(value: Column, token: str) -> Column:
    """Null for the token that stands for nothing; an empty value stops the job."""
    return F.when(value == "", F.raise_error(F.lit("an empty value"))).otherwise(F.nullif(value, F.lit(token)))


def key_value_map(value: Column) -> Column:
    """a=b|c=d as a map."""
    return F.str_to_map(value, F.lit(r"\|"), F.lit("="))


def token_id(value: Column) -> Column:
    """struct(first, last, part): 7 is (7, 7, null); 3-5 is (3, 4, null), as the end isn't included; 8.1 is (8, 8, 0.1)."""
    first = F.regexp_extract(value, r"^(\d+)", 1).cast("long")
    dash, dot = F.regexp_extract(value, r"^\d+-(\d+)$", 1), F.regexp_extract(value, r"^\d+\.(\d+)$", 1)
    ok = value.rlike(r"^\d+([-.]\d+)?$")
    return F.when(
        ok,
        F.struct(
            first.alias("first"),
            F.when(dash != "", dash.cast("long") - 1).otherwise(first).alias("last"),
            F.when(dot != "", F.concat(F.lit("0."), dot).cast("decimal(20,10)")).alias("part"),
        ),
    ).otherwise(F.raise_error(F.concat(F.lit("no token id: "), value)))


def rules(
    dialect: str,
    delimiter: str = "\t",
    strict_blank: bool = True,
    comment_boundaries: bool = True,
    whole_source: bool = False,
    columns: tuple[str, ...] | None = None,
) -> conll_lines.Rules:
    """What the pass over lines must know; columns: those that are asked for."""
    d = DIALECTS.get(dialect)
    fields = {name: (i, {"ner": d.tag, "form": d.form}.get(name)) for i, name in enumerate(d.fields) if columns is None or name in columns}
    mark = d.document_comment if comment_boundaries else None
    return conll_lines.Rules(fields, delimiter, strict_blank, d.docstart, d.ignore_docstart, d.comments, mark, whole_source)


def _laid(rows: DataFrame, key: str, order: str, in_order: bool, *columns: str) -> DataFrame:
    """Rows of a key one after another: they are shuffled and sorted once, unless tasks hold them so already."""
    bounded(rows.sparkSession)
    return (rows if in_order else rows.repartition(key).sortWithinPartitions(key, order)).select(key, *columns)


def parse(
    rows: DataFrame,
    dialect: str = "conll",
    delimiter: str = "\t",
    strict_blank: bool = True,
    comment_boundaries: bool = True,
    whole_source: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """source, document, sentence, position and the dialect's columns, one row per token; sentence_text where comments have it.

    rows: source, line_no, line. Extra columns of a line are left out; missing ones are null. With whole_source all sentences
    of a source make one document. in_order: lines of a source stand one after another in one task already, such as those that
    were cut out of one row; nothing is shuffled then.

    Everything comes from one order of a source's lines, in one pass that keeps what the lines so far have opened.
    """
    r = rules(dialect, delimiter, strict_blank, comment_boundaries, whole_source)
    schema = T.StructType([T.StructField("source", T.StringType()), *_NUMBERS, T.StructField("sentence_text", T.StringType()), *_fields(r)])
    return _laid(rows, "source", "line_no", in_order, "line").mapInArrow(conll_lines.tokens(r), schema)


_NUMBERS = [T.StructField(c, T.LongType()) for c in ("document", "sentence", "position")]


def _fields(r: conll_lines.Rules) -> list[T.StructField]:
    return [T.StructField(c, T.StringType()) for c in r.fields]


def parse_in_rows(lines: Column, r: conll_lines.Rules) -> Column:
    """The same for arrays of lines, each a whole source: arrays of struct(document, sentence, position, and the columns)."""
    kind = T.StructType([*_NUMBERS, *_fields(r)])
    return arrow(conll_lines.in_rows(r), f"array<{kind.simpleString()}>")(lines)


def parse_columns(rows: DataFrame, order: str = "row", in_order: bool = False) -> DataFrame:
    """The same from columns form, ner, doc_idx, sent_idx: a sentence is a run of rows of one sent_idx within a document, so a
    number that comes again later begins another."""
    strings = [T.StructField("sentence_text", T.StringType()), rows.schema["form"], rows.schema["ner"]]
    schema = T.StructType([T.StructField("source", T.StringType()), *_NUMBERS, *strings])
    return _laid(rows, "doc_idx", order, in_order, "sent_idx", "form", "ner").mapInArrow(conll_lines.runs, schema)


def sentences(tokens: DataFrame, language: str, bioes: bool = False, kind: str = "join", tag_of_index: dict[int, str] | None = None) -> DataFrame:
    """One row per sentence: source, document, document_position, tokens, ner_iob, text, ner, space_after."""
    parts = ["position", "form", "ner", *(c for c in ("start", "end") if "start" in tokens.columns)]
    grouped = tokens.groupBy("source", "document", "sentence").agg(
        F.sort_array(F.collect_list(F.struct(*parts))).alias("x"), F.max("sentence_text").alias("sentence_text")
    )
    return _sentences(grouped, language, "start" in tokens.columns, bioes, kind, tag_of_index)


def _sentences(grouped: DataFrame, language: str, offsets: bool, bioes: bool, kind: str, tag_of_index: dict[int, str] | None) -> DataFrame:
    """sentences() from rows with the list x of their tokens in order."""

    def made(t: Column) -> Column:
        t = tag.from_index(t.cast("int"), tag_of_index) if tag_of_index else t
        return tag.bioes_to_bio(t) if bioes else t

    placed = F.transform("x", lambda x: F.struct(x["form"].alias("f"), x["start"].cast("long").alias("a"), x["end"].cast("long").alias("z"))) if offsets else None
    rows = grouped.select(
        "source",
        "document",
        F.col("sentence").alias("document_position"),
        F.transform("x", lambda x: x["form"]).alias("tokens"),
        F.transform("x", lambda x: made(x["ner"])).alias(f"{DEFAULT_TAGSET}_iob"),
        "sentence_text",
        *([placed.alias("x")] if offsets else []),
    )
    if not offsets:
        out = detokenize(rows, F.lit(language), original="sentence_text", kind=kind)
        return out.withColumn("space_after", F.lit("")).drop("sentence_text")
    first = F.col("x")[0]["a"]
    spans = F.transform("x", lambda x: sp.span(x["a"] - first, x["z"] - first))
    gap = lambda x, i: F.repeat(F.lit(" "), F.when(i == 0, 0).otherwise(x["a"] - F.get("x", i - 1)["z"]).cast("int"))
    text = F.array_join(F.transform("x", lambda x, i: F.concat(gap(x, i), x["f"])), "")
    following = F.lead(first).over(W.partitionBy("source", "document").orderBy("document_position"))
    after = F.coalesce(F.repeat(F.lit(" "), (following - F.element_at("x", -1)["z"]).cast("int")), F.lit(""))
    out = rows.withColumns({"text": text, DEFAULT_TAGSET: sp.bio_to_spans(F.col(f"{DEFAULT_TAGSET}_iob"), spans), "space_after": after})
    return out.drop("x", "sentence_text")


def read(
    spark: SparkSession,
    paths: str | list[str],
    dialect: str = "conll",
    language: str = "eng",
    delimiter: str = "\t",
    strict_blank: bool = True,
    preprocessor: str | None = None,
    whole_source: bool = False,
    bioes: bool = False,
    kind: str = "join",
    tag_of_index: dict[int, str] | None = None,
) -> DataFrame:
    """Sentences of CoNLL files."""
    rows = lines(spark, paths)
    if preprocessor:
        rows = PREPROCESSORS.get(preprocessor)(rows)
    return of_lines(rows, dialect, language, delimiter, strict_blank, whole_source, bioes, kind, tag_of_index)


def of_lines(
    rows: DataFrame,
    dialect: str = "conll",
    language: str = "eng",
    delimiter: str = "\t",
    strict_blank: bool = True,
    whole_source: bool = False,
    bioes: bool = False,
    kind: str = "join",
    tag_of_index: dict[int, str] | None = None,
    in_order: bool = False,
) -> DataFrame:
    """sentences() of parse() of lines, where the pass over lines gathers the sentences as well."""
    r = rules(dialect, delimiter, strict_blank, whole_source=whole_source)
    token = T.ArrayType(T.StructType([_NUMBERS[-1], *_fields(r)]))
    schema = T.StructType([T.StructField("source", T.StringType()), *_NUMBERS[:-1], T.StructField("sentence_text", T.StringType()), T.StructField("x", token)])
    grouped = _laid(rows, "source", "line_no", in_order, "line").mapInArrow(conll_lines.sentences(r), schema)
    return _sentences(grouped, language, "start" in r.fields, bioes, kind, tag_of_index)
