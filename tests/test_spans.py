import random
import uuid

import pytest
from pyspark.sql import functions as F

from tagloom.functions import ids, spans, tags, text

SPANS = "array<struct<start: long, stop: long>>"


def one(spark, column, **values):
    """The value of a column over one row; values: (value, type)."""
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items())
    return spark.createDataFrame([tuple(v for v, _ in values.values())], schema).select(column.alias("x")).first().x


def plain(found):
    return [(a.label, [(s.start, s.stop) for s in a.spans]) for a in found]


def sequential(tag_list, span_list):
    done, current, last = [], None, None
    for t, (a, z) in zip(tag_list, span_list):
        p, _, y = t.partition("-")
        y = y or None
        if current and (p in ("O", "B") or y != last):
            done.append(current)
            current = None
        if p in ("B", "I"):
            if current:
                current = (current[0], (current[1][0], z))
            else:
                current = (y, (a, z))
        last = y
    return [(y, [s]) for y, s in done + ([current] if current else [])]


def bio(spark, tag_list, span_list, function=spans.bio_to_spans):
    return plain(one(spark, function(F.col("t"), F.col("s")), t=(tag_list, "array<string>"), s=(span_list, SPANS)))


@pytest.mark.parametrize(
    ("tag_list", "span_list"),
    [
        (["O", "B-person", "I-person", "I-person", "O"], [(0, 5), (5, 10), (10, 15), (15, 20), (20, 21)]),
        (["B-person", "I-person", "O", "B-organization", "I-organization"], [(0, 5), (5, 10), (10, 11), (11, 15), (15, 20)]),
        (["O", "B-person", "B-organization", "O", "B-organization"], [(0, 1), (1, 4), (4, 8), (8, 12), (12, 15), (15, 16)]),
        (["O", "O", "O"], [(0, 1), (1, 2), (2, 3)]),
        ([], []),
        (["B-person", "B-organization", "B-location"], [(0, 1), (1, 2), (2, 3)]),
        (["O", "I-person", "O"], [(0, 1), (1, 6), (6, 9)]),
        (["B-a-b", "I-a-b", "I-a"], [(0, 1), (1, 2), (2, 3)]),
        (["B-product", *["I-product"] * 5, "O"], [(i, i + 4) for i in range(0, 28, 4)]),
    ],
)
def test_bio_to_spans(spark, tag_list, span_list):
    assert bio(spark, tag_list, span_list) == sequential(tag_list, span_list)
    assert bio(spark, tag_list, span_list, spans.any_tags_to_spans) == sequential(tag_list, span_list)


def test_bio_to_spans_on_random_tags(spark):
    r = random.Random(0)
    rows = []
    for _ in range(300):
        n = r.randint(0, 12)
        rows.append(([r.choice(["O", "B-x", "I-x", "B-y", "I-y"]) for _ in range(n)], [(2 * i, 2 * i + 1) for i in range(n)]))
    mixed = [([r.choice(["O", "B-x", "I-x", "E-x", "S-y", "I-y"]) for _ in t], s) for t, s in rows]
    df = spark.createDataFrame(rows, f"t array<string>, s {SPANS}").select("t", "s", spans.bio_to_spans(F.col("t"), F.col("s")).alias("x"))
    for row in df.collect():
        assert plain(row.x) == sequential(row.t, row.s)
    df = spark.createDataFrame(mixed, f"t array<string>, s {SPANS}").select("t", "s", spans.any_tags_to_spans(F.col("t"), F.col("s")).alias("x"))
    for row in df.collect():
        assert plain(row.x) == sequential(row.t, row.s)


@pytest.mark.parametrize("function", [spans.bio_to_spans, spans.any_tags_to_spans])
def test_a_tag_without_type_is_refused(spark, function):
    with pytest.raises(Exception, match="no type"):
        bio(spark, ["B", "O"], [(0, 1), (1, 2)], function)


def test_rules_of_whole_arrays(spark):
    tag_list = ["O", "B-a", "I-a", "E-a-b", "S-b", "I-a"]
    for each, rule in ((tags.each_bioes_to_bio, tags.bioes_to_bio), (tags.each_inverted, tags.inverted), (tags.each_type_only, tags.type_only), (tags.each_checked, tags.checked)):
        for values in (tag_list, [], ["0", "O"]):
            if values == ["0", "O"] and rule not in (tags.inverted, tags.type_only):
                continue
            df = spark.createDataFrame([(values,), (None,), (values[:2],)], "t array<string>")
            got = df.select(each(F.col("t")).alias("x"), F.transform("t", rule).alias("y")).collect()
            assert [r.x for r in got] == [r.y for r in got]
    with pytest.raises(Exception, match="not a BIO tag"):
        one(spark, tags.each_checked(F.col("t")), t=(["O", "B-"], "array<string>"))
    with pytest.raises(Exception, match="unknown position"):
        one(spark, tags.each_bioes_to_bio(F.col("t")), t=(["Q-a"], "array<string>"))


def test_null_rows_stay_null(spark):
    df = spark.createDataFrame([(None, "a b"), (["a"], None), (["a", "b"], "a b"), ([], "")], "t array<string>, x string")
    got = df.select(
        spans.joined_spans(F.col("t"), F.lit(" ")).alias("j"), spans.align_tokens(F.col("t"), F.col("x")).alias("a"), spans.find_tokens(F.col("t"), F.col("x")).alias("f")
    ).collect()
    assert [r.j and [tuple(s) for s in r.j] for r in got] == [None, [(0, 1)], [(0, 1), (2, 3)], []]
    for name in "af":
        assert [r[name] and [tuple(s) for s in r[name]] for r in got] == [None, None, [(0, 1), (2, 3)], []]


def test_tags(spark):
    assert one(spark, F.transform("t", tags.bioes_to_bio), t=(["O", "B-a", "I-a", "E-a", "S-b-c"], "array<string>")) == ["O", "B-a", "I-a", "I-a", "B-b-c"]
    assert one(spark, F.transform("t", tags.inverted), t=(["PERS-B", "0"], "array<string>")) == ["B-PERS", "O"]
    assert one(spark, F.transform("t", tags.type_only), t=(["PER", "O"], "array<string>")) == ["I-PER", "O"]
    assert one(spark, F.transform("t", tags.checked), t=(["B-a-b", "O"], "array<string>")) == ["B-a-b", "O"]
    for bad in ("B-", "-a", "B", "X"):
        with pytest.raises(Exception, match="not a BIO tag"):
            one(spark, tags.checked(F.col("t")), t=(bad, "string"))
    with pytest.raises(Exception, match="unknown position"):
        one(spark, tags.bioes_to_bio(F.col("t")), t=("Q-a", "string"))
    assert one(spark, tags.from_index(F.col("i"), {0: "O", 3: "B-x"}), i=(3, "int")) == "B-x"
    with pytest.raises(Exception, match="no label for"):
        one(spark, tags.from_index(F.col("i"), {0: "O"}), i=(7, "int"))


@pytest.mark.parametrize(
    ("tokens", "whole", "want"),
    [
        (["a", "b"], "a  b", [(0, 1), (3, 4)]),
        (["日本", "語"], " 日本語", [(1, 3), (3, 4)]),
        (["😀", "é"], "😀 é", [(0, 1), (2, 3)]),
        (["a", "c"], "a b", None),
        (["a", "b"], "a", None),
        ([], "x", []),
        (["a b", "c"], "a b c", [(0, 3), (4, 5)]),
    ],
)
def test_align_tokens(spark, tokens, whole, want):
    got = one(spark, spans.align_tokens(F.col("t"), F.col("x")), t=(tokens, "array<string>"), x=(whole, "string"))
    assert (None if got is None else [tuple(s) for s in got]) == want


def test_find_tokens_advances(spark):
    got = one(spark, spans.find_tokens(F.col("t"), F.col("x")), t=(["a", "a", "ba"], "array<string>"), x=("xa a aba", "string"))
    assert [tuple(s) for s in got] == [(1, 2), (3, 4), (6, 8)]
    with pytest.raises(Exception, match="not in the text"):
        one(spark, spans.find_tokens(F.col("t"), F.col("x")), t=(["a", "z"], "array<string>"), x=("a", "string"))


def test_joined_spans_and_running(spark):
    r = random.Random(1)
    for n in (0, 1, 63, 64, 65, 300):
        tokens = ["x" * r.randint(0, 9) for _ in range(n)]
        got = one(spark, spans.joined_spans(F.col("t"), F.lit(" ")), t=(tokens, "array<string>"))
        want, at = [], 0
        for t in tokens:
            want.append((at, at + len(t)))
            at += len(t) + 1
        assert [tuple(s) for s in got] == want


def test_repairs(spark):
    def fix(start, stop, expected, function=spans.repaired):
        got = one(spark, function(F.col("x"), F.col("a"), F.col("z"), F.col("e")), x=("one two three", "string"), a=(start, "long"), z=(stop, "long"), e=(expected, "string"))
        return got and tuple(got)

    assert fix(4, 7, "two") == (4, 7)
    assert fix(3, 6, "two") == (4, 7)
    assert fix(6, 9, "two") == (4, 7)
    assert fix(0, 3, "two") == (4, 7)
    assert fix(3, 8, "two") == (4, 7)
    assert fix(2, 9, "two") == (4, 7)
    assert fix(0, 3, "xyz", spans.find_near) is None
    with pytest.raises(Exception, match="no such text"):
        fix(0, 3, "xyz")
    assert fix(10, 15, "three") == fix(7, 12, "three") == (8, 13)  # moved past the end
    assert fix(9, 14, "three") == (8, 13)
    assert fix(1, 4, "one") == fix(0, 3, "one") == (0, 3)
    assert fix(10, 13, "three") == (8, 13)
    assert fix(7, 14, "thirteen") == (8, 13)  # of another length, and nowhere near
    assert fix(0, 3, "xyz", spans.check_span) == (0, 3)
    with pytest.raises(Exception, match="no such text"):
        fix(0, 3, "four", spans.check_span)
    with pytest.raises(Exception, match="no such text"):
        fix(0, 3, "xyz", spans.check_exact)


ANN = "array<struct<label: string, spans: array<struct<start: long, stop: long>>>>"


def test_annotations(spark):
    items = [("b", [(5, 9)]), ("a", [(0, 2), (4, 6)]), ("c", [(0, 2)]), ("d", [(0, 2)])]
    assert plain(one(spark, spans.ordered(F.col("a")), a=(items, ANN))) == [("c", [(0, 2)]), ("d", [(0, 2)]), ("a", [(0, 2), (4, 6)]), ("b", [(5, 9)])]
    got = one(spark, spans.continuous(F.col("a")), a=(items, ANN))
    assert [(a.label, tuple(a.spans)) for a in got] == [("b", (5, 9)), ("c", (0, 2)), ("d", (0, 2))]
    assert plain(one(spark, spans.shifted(F.col("a"), F.lit(-1)), a=(items[:1], ANN))) == [("b", [(4, 8)])]


def sequential_merge(bounds, items):
    out, start = [], bounds[0][0]
    for i, (_, stop) in enumerate(bounds):
        if i < len(bounds) - 1 and any(s[0][0] < stop < s[-1][1] for _, s in items):
            continue
        out.append((start, stop))
        start = bounds[i + 1][0] if i < len(bounds) - 1 else None
    return out


def test_merged_bounds(spark):
    r = random.Random(5)
    rows = []
    for _ in range(200):
        bounds, at = [], 0
        for _ in range(r.randint(1, 6)):
            size = r.randint(1, 9)
            bounds.append((at, at + size))
            at += size + r.randint(0, 2)
        end = bounds[-1][1]
        items = []
        for _ in range(r.randint(0, 4)):
            a = r.randrange(end)
            items.append(("x", [(a, r.randint(a + 1, end))]))
        rows.append((bounds, items))
    df = spark.createDataFrame(rows, f"b {SPANS}, a {ANN}")
    for row in df.select("b", "a", spans.merged_bounds(F.col("b"), [F.col("a")]).alias("x")).collect():
        assert [tuple(s) for s in row.x] == sequential_merge([tuple(b) for b in row.b], [(a.label, [tuple(s) for s in a.spans]) for a in row.a])
    with pytest.raises(Exception, match="after the last sentence"):
        one(spark, spans.merged_bounds(F.col("b"), [F.col("a")]), b=([(0, 3)], SPANS), a=([("x", [(1, 5)])], ANN))


def test_ids(spark):
    ns = uuid.UUID(ids.NAMESPACE)
    df = spark.createDataFrame([("D é", "s", "train", d, p) for d in (0, 5, 300, 2**40) for p in (0, 77)], "a string, b string, c string, d long, p long")
    for r in df.select("*", ids.sequence_id(*map(F.col, "abcdp")).alias("x"), ids.uuid_text(ids.sequence_id(*map(F.col, "abcdp"))).alias("t")).collect():
        want = uuid.uuid5(ns, f"{r.a} {r.b} {r.c}".encode() + r.d.to_bytes(64, "little") + r.p.to_bytes(64, "little"))
        assert bytes(r.x) == want.bytes and r.t == str(want)
    assert bytes(one(spark, ids.uuid_bytes(F.col("t")), t=(str(ns), "string"))) == ns.bytes


def test_text(spark):
    s = "aé😀 b"
    for i in range(len(s) + 1):
        assert one(spark, text.char_of_byte(F.col("x"), F.col("b")), x=(s, "string"), b=(len(s[:i].encode()), "long")) == i
    assert one(spark, text.piece(F.col("x"), F.lit(1), F.lit(3)), x=(s, "string")) == s[1:3]
    assert one(spark, text.strip(F.col("x")), x=("　 a\t ", "string")) == "a"
    assert one(spark, text.words(F.col("x")), x=(" a\tb\n", "string")) == ["a", "b"]
    for token, kind in (("...", "p"), ("1,5", "n"), ("½", "n"), ("a1", ""), ("$", ""), ("(3)", "n")):
        got = one(spark, F.concat(F.when(text.is_punctuation(F.col("x")), "p").otherwise(""), F.when(text.is_number(F.col("x")), "n").otherwise("")), x=(token, "string"))
        assert got == kind
    assert one(spark, text.iso_language(F.col("x")), x=("zh-Hans", "string")) == "zho-Hans"
    assert one(spark, text.tokenizer_language(F.col("x")), x=("zho", "string")) == "cmn_Hani"
    assert one(spark, text.config_name(F.lit("d"), F.col("x")), x=(["a", "b"], "array<string>")) == "d--a--b"
    for n, want in ((1000, "n<1K"), (1001, "1K<n<10K"), (10**12, "100B<n<1T"), (10**12 + 1, "n>1T")):
        assert one(spark, text.size_category(F.col("x")), x=(n, "long")) == want
