import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tagloom import registry
from tagloom.functions import ids
from tagloom.operators import boundaries, documents, labels, merging, sampling, selecting, stats
from tagloom.plans import export, metadata, steps
from tagloom.schema import ANNOTATIONS, sequence_schema, tagsets_of
from tagloom.sources import archives, columnar, conll, readers, store

ANN = ANNOTATIONS.simpleString()


def plain(items):
    return [(a.label, [(s.start, s.stop) for s in a.spans]) for a in items]


def ann(*items):
    return [(y, [tuple(s) for s in spans]) for y, *spans in items]


@pytest.fixture
def rows(spark):
    data = [
        (0, 0, "Anna came", " ", ann(("PER", (0, 4)))),
        (0, 1, "to Rome.", "", ann(("LOC", (3, 7)), ("X", (0, 2), (3, 7)))),
        (1, 0, "😀 no", "", []),
        (2, 0, "Bo", "\n", None),
        (2, 1, "Bo", "", ann(("PER", (0, 2)))),
    ]
    df = spark.createDataFrame(data, f"document_index long, document_position long, text string, space_after string, ner {ANN}")
    return df.withColumn("sequence_id", F.encode(F.concat("document_index", "document_position"), "UTF-8"))


def test_merge_documents_moves_spans(rows):
    got = {r.document_index: r for r in documents.merge_documents(rows).collect()}
    assert got[0].text == "Anna came to Rome."
    assert plain(got[0].ner) == [("PER", [(0, 4)]), ("LOC", [(13, 17)]), ("X", [(10, 12), (13, 17)])]
    assert plain(got[1].ner) == [] and plain(got[2].ner) == [("PER", [(3, 5)])]
    assert bytes(got[2].sequence_id) == b"20"
    numbered = documents.with_chunk_index(documents.merge_documents(rows)).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.document_index) for r in numbered] == [(0, 0), (1, 1), (2, 2)]
    assert documents.merge_documents(rows, tagset=None).columns == ["document_index", "sequence_id", "text"]


def test_budget_segments(spark):
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([3, 3, 5, 1])], "document_index long, document_position long, n long")
    got = documents.budget_segments(df, F.col("n"), 6).orderBy("document_position").collect()
    assert [r.segment_id for r in got] == [0, 1, 1, 2]


def test_split_sentences(spark):
    text = "One two.  Three four\nfive six. End"
    bounds = [(0, 8), (10, 20), (21, 30), (31, 34)]
    items = ann(("A", (4, 7)), ("B", (16, 25)), ("C", (31, 34)))
    df = spark.createDataFrame([(7, 0, text, "!", bounds, items)], f"document_index long, document_position long, text string, space_after string, sentence_offsets array<struct<start: long, stop: long>>, ner {ANN}")
    got = documents.split_sentences(df).orderBy("document_position").collect()
    assert [(r.text, r.space_after) for r in got] == [("One two.", "  "), ("Three four\nfive six.", " "), ("End", "")]
    assert [plain(r.ner) for r in got] == [[("A", [(4, 7)])], [("B", [(6, 15)])], [("C", [(0, 3)])]]
    kept = documents.split_sentences(df, keep_type=True).orderBy("document_position").collect()
    assert kept[-1].space_after == "!"


def test_assign_tokens_and_rule_sentences(spark):
    df = spark.createDataFrame([("A b. C d", ["A", "b.", "C", "d"])], "text string, tokens array<string>")
    df = df.withColumn("b", documents.rule_sentences(F.col("text")))
    got = df.select("b", documents.assign_tokens(F.col("tokens"), F.col("text"), F.col("b")).alias("x")).first()
    assert [tuple(s) for s in got.b] == [(0, 4), (5, 8)]
    assert got.x == [[0, 1], [2, 3]]


def test_detokenize(spark):
    df = spark.createDataFrame([(["日", "#", "本"], ["B-x", "O", "B-y"], "日 # 本 語"), (["a", "b"], ["B-x", "I-x"], "zz")], "tokens array<string>, ner_iob array<string>, o string")
    got = documents.detokenize(df, F.lit("zho-Hans")).collect()
    assert got[0].text == "日#本" and plain(got[0].ner) == [("x", [(0, 1)]), ("y", [(2, 3)])]
    got = documents.detokenize(df, F.lit("jpn"), kind="hashes").collect()
    assert got[0].text == "日 本"
    got = documents.detokenize(df, F.lit("eng"), original="o").collect()
    assert got[0].text == "日 # 本 語" and plain(got[0].ner) == [("x", [(0, 1)]), ("y", [(4, 5)])]
    assert got[1].text == "a b" and plain(got[1].ner) == [("x", [(0, 3)])]


def test_empty_documents(spark, rows):
    bad = rows.withColumn("text", F.when(F.col("document_index") == 2, "").otherwise(F.col("text")))
    assert {r.document_index for r in documents.drop_documents_with_empty_text(bad).collect()} == {0, 1}
    with pytest.raises(Exception, match="empty text"):
        documents.drop_documents_with_empty_text(bad, strict=True).collect()


def test_selecting(spark, rows):
    assert selecting.with_entities(rows).count() == 3
    one = selecting.drop_discontinuous(rows).where("document_position = 1 and document_index = 0").first()
    assert [(a.label, tuple(a.spans)) for a in one.ner] == [("LOC", (3, 7))]
    assert "ner" in selecting.project(rows).columns
    splits = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "dataset string, ok int")
    assert {r.dataset for r in selecting.datasets_where_all(splits, F.col("ok") == 1).collect()} == {"b"}
    langs = spark.createDataFrame([("eng",), ("MULTI",)], "language string")
    assert selecting.known_languages(langs).count() == 1


def test_quotas(spark):
    assert sampling.shares(10, 3) == [3, 3, 4]
    data = [("d", p, i) for p, n in (("a", 9), ("b", 2), ("c", 9)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, p string, i long")
    got = sampling.quota_sample(df, "g", "p", 10, ("i",)).groupBy("p").count().collect()
    assert {r.p: r["count"] for r in got} == {"a": 3, "b": 2, "c": 4}


def entry(dataset, subset, tagsets, language="eng", split="train", **more):
    return {"dataset": dataset, "subset": subset, "split": split, "language": language, "tagsets": tagsets, **more}


def test_sample_and_merge(spark, rows):
    two = rows.withColumnRenamed("ner", "fine").withColumn("coarse", F.col("fine"))
    splits = [(entry("a", ["x"], ["ner"]), rows), (entry("b", [], ["coarse", "fine"]), two), (entry("c", [], ["ner"], "deu"), rows)]
    with pytest.raises(KeyError, match="several tagsets"):
        sampling.monolingual_sample(splits, "eng", 2)
    with pytest.raises(ValueError, match="no data"):
        sampling.monolingual_sample(splits, "fra", 2)
    got = sampling.monolingual_sample(splits, "eng", 2, tagset_of={"b": "fine"}, merge=True, keep_without_entities=False)
    assert sorted((r.dataset, r.text) for r in got.collect()) == [(d, t) for d in "ab" for t in ("Anna came to Rome.", "Bo\nBo")]
    got = sampling.monolingual_sample(splits[:1], "eng", 9, merge=True, target_tokens=2)
    assert sorted(r.text for r in got.collect()) == ["Anna came to Rome.", "Bo\n", "Bo", "😀 no"] or got.count() >= 3
    tokens = rows.withColumns({"tokens": F.array(F.lit("t")), "ner_iob": F.array(F.lit("O"))})
    merged = merging.merge_splits([(entry("a", ["x", "y"], ["ner"]), tokens), splits[1]], {"b": "coarse"})
    assert merged.count() == 10 and merged.where("tokens is null").count() == 5
    assert {r.subset for r in merged.select("subset").distinct().collect()} == {"x/y", ""}
    assert "ner" not in merging.merge_splits(splits).columns
    with pytest.raises(KeyError):
        merging.merge_splits(splits, {})
    whole = merging.merge_splits(splits[:1], {}, merge=True)
    assert whole.count() == 3 and "chunk_index" in whole.columns


def test_labels(spark, rows):
    got = labels.label_inventory(rows.withColumn("subset", F.lit("s"))).first()
    assert got.labels == ["LOC", "PER", "X"]
    tagged = spark.createDataFrame([("s", ["B-x", "O"]), ("t", [])], "subset string, ner_iob array<string>")
    assert {r.subset: r.bio_labels for r in labels.tag_inventory(tagged).collect()} == {"s": ["B-x", "O"], "t": None}
    table = {"PER": "person", "LOC": "place", "X": "x"}
    assert [a.label for a in labels.map_labels(rows, {"ner": table}).where("document_index = 0 and document_position = 1").first().ner] == ["place", "x"]
    with pytest.raises(Exception, match="label map"):
        labels.map_labels(rows, {"ner": {"PER": "person"}}).collect()
    got = tagged.select(labels.mapped_tags(F.col("ner_iob"), {"x": "y"}).alias("t")).collect()
    assert got[0].t == ["B-y", "O"]
    compact = {"d": [{"subsets": [["a"], ["b", "c"]], "tagset": "ner", "label_map": {"x": "y"}}]}
    maps = labels.expand_label_map(compact)
    assert maps["d"][("b", "c")]["ner"] == {"x": "y"}
    assert labels.label_table(spark, maps).count() == 2
    with pytest.raises(ValueError):
        labels.expand_label_map({"d": [{"subsets": [], "tagset": "n", "label_map": {}, "more": 1}]})


def test_stats(spark):
    df = spark.createDataFrame([("d", "eng", "One, 2 ... 3rd ½")], "dataset_name string, language string, text string")
    got = stats.word_stats(df, ["dataset_name"]).first()
    assert tuple(got)[1:] == (5, 2, 1, 2) or tuple(got)[1:] == (5, 2, 1, 2)
    own = stats.tokenized(df, {"eng": lambda t: t.split(" ")[:2]})
    assert stats.word_stats(own, ["dataset_name"], F.col("tokens")).first().total_token_count == 2
    with pytest.raises(Exception, match="no tokenizer"):
        stats.tokenized(df, {}).collect()
    done = stats.word_stats(df, ["dataset_name"])
    fresh = stats.word_stats(df.union(df.withColumn("dataset_name", F.lit("e"))), ["dataset_name"])
    assert stats.append_stats(done, fresh).count() == 2 and stats.append_stats(None, fresh).count() == 2
    langs = spark.createDataFrame([("zho-Hans",), ("deu",), ("MULTI",), ("zho",)], "language string")
    assert stats.languages(langs).first().languages == ["deu", "zho"]


# --- sources --------------------------------------------------------------------------------------------------------


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_conll(spark, tmp_path):
    path = write(tmp_path / "a.txt", "-DOCSTART- -X- O O\n\nAnna N I B-PER\nLee N I I-PER extra\n\nsat V O O\n\n-DOCSTART- -X- O O\n\nRome N I B-LOC")
    got = conll.read(spark, path, "conll2003", delimiter=" ").orderBy("document", "document_position").collect()
    assert [(r.document, r.document_position, r.text) for r in got] == [(0, 0, "Anna Lee"), (0, 1, "sat"), (1, 0, "Rome")]
    assert plain(got[0].ner) == [("PER", [(0, 8)])]
    each = conll.read(spark, path, "conll2003_ignore_docstart", delimiter=" ")
    assert each.select("document").distinct().count() == 3
    path = write(tmp_path / "b.txt", "a\tB-x\n \nb\tO\n")
    assert conll.read(spark, path, strict_blank=False).count() == 2
    with pytest.raises(Exception, match="not a BIO tag"):
        conll.read(spark, path).collect()
    with pytest.raises(KeyError):
        conll.read(spark, path, "nothing")


def test_conll_dialects(spark, tmp_path):
    path = write(tmp_path / "w.txt", "王0\tB-PER\n小1\tI-PER\n��2\tO\n")
    got = conll.read(spark, path, "conll_weibo_ner", "cmn").first()
    assert got.tokens == ["王", "小", "��"] and got.text == "王小��"
    path = write(tmp_path / "h.txt", "PERS-B\tCaesar\n0\test\n")
    assert conll.read(spark, path, "conll_herodotos").first().ner_iob == ["B-PERS", "O"]
    text = "# newdoc id = d1\n# text = Anna saß\n1\tAnna\tB-PER\t-\tx\n2\tsaß\tO\tO#B-X\tx\n\n# text = Nein.\n1\tNein\tO\t-\tx\n2\t.\tO\t-\tx\n\n# newdoc id = d2\n1\tX\tO\t-\tx\n\n# alone\n"
    path = write(tmp_path / "u.txt", text)
    got = conll.read(spark, path, "conllu_uner").orderBy("document", "document_position").collect()
    assert [(r.document, r.text) for r in got] == [(0, "Anna saß"), (0, "Nein."), (1, "X")]
    path = write(tmp_path / "n.txt", "B-g\t10\t12\tab\tab\tN\tO\nO\t13\t14\tc\tc\tN\tO\n\nO\t17\t18\td\td\tN\tO\n")
    got = conll.read(spark, path, "ner_suite", whole_source=True).orderBy("document_position").collect()
    assert [(r.text, r.space_after) for r in got] == [("ab c", "   "), ("d", "")]
    flat = spark.createDataFrame([(0, "a", 0, 0, 0), (1, "b", 1, 0, 0), (2, "c", 0, 0, 1), (3, "d", 1, 1, 0)], "row int, form string, ner int, doc_idx int, sent_idx int")
    got = conll.sentences(conll.parse_columns(flat), "eng", tag_of_index={0: "O", 1: "B-x"}).orderBy("document", "document_position").collect()
    assert [(r.document, r.text) for r in got] == [(0, "a b"), (0, "c"), (1, "d")]


def test_preprocessors(spark, tmp_path):
    path = write(tmp_path / "s.txt", "Question_ID O\n5 O\n\nuse O\nnumpy B-Lib\n\nQuestion_URL O\nx O\n\nCODE_BLOCK O\n\nbye O\n")
    lines = conll.PREPROCESSORS.get("stackoverflow_ner")(conll.lines(spark, path))
    got = conll.parse(lines, "conll_stackoverflow_ner", " ").orderBy("sentence", "position").collect()
    assert [(r.document, r.sentence, r.form) for r in got] == [(0, 0, "use"), (0, 0, "numpy"), (0, 1, "bye")]
    path = write(tmp_path / "e.csv", '-DOCSTART-,O\n,O\n"a,b",I-LOC\nx,P\n,O\ny,B-ORG\n')
    got = conll.read(spark, path, "conll2003_two_column", preprocessor="e-ner").orderBy("document_position").collect()
    assert [(r.tokens, r.ner_iob) for r in got] == [(["a,b", "x"], ["I-LOCATION", "O"]), (["y"], ["B-ORG"])]
    path = write(tmp_path / "p.txt", "<ref>A x x B-PER\n</ref> x x O\nb<nowiki/> x x O\n")
    assert conll.read(spark, path, "conll2003_pioner", delimiter=" ", preprocessor="pioner").first().tokens == ["A", "b"]
    path = write(tmp_path / "k.txt", "# c = d\nf\tl\tX\t_\ta=b|c=d\tB-PER\te\ng\tl\tX\t_\t_\t?\te\n")
    assert conll.read(spark, path, "conllu_plus", preprocessor="nytk_nerkor").first().ner_iob == ["B-PER", "O"]


def test_offset_formats(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'text,offsets\n"2 eggs","[{""start"": 2, ""end"": 6, ""type"": ""FOOD"", ""entity"": ""eggs""}]"\n')
    got = readers.read("offset_csv", spark, path).first()
    assert (got.text, plain(got.ner), got.sequence_type) == ("2 eggs", [("FOOD", [(2, 6)])], 1)
    line = {"text": "é Anna", "spans": [{"start_byte": 3, "limit_byte": 7, "label": "PER"}], "target": "PER: Anna"}
    path = write(tmp_path / "b.jsonl", json.dumps(line) + "\n")
    assert plain(readers.read("byte_offset_jsonl", spark, path, target_key="target").first().ner) == [("PER", [(2, 6)])]
    path = write(tmp_path / "c.jsonl", json.dumps(line | {"target": "PER: Bert"}) + "\n")
    with pytest.raises(Exception, match="no such text"):
        readers.read("byte_offset_jsonl", spark, path, target_key="target").collect()
    path = write(tmp_path / "p.txt", '#tid:1\none two\nmore\n[[0, 3, "N", "one"]]\n\nthree\n[]\n')
    got = readers.read("plain_spans", spark, path).orderBy("document").collect()
    assert [(r.text, plain(r.ner)) for r in got] == [("one two\nmore", [("N", [(0, 3)])]), ("three", [])]
    path = write(tmp_path / "q.txt", "one\n[(0, 3, 'N', 'one')]\n")
    assert plain(readers.read("plain_spans", spark, path, "python").first().ner) == [("N", [(0, 3)])]
    rows = spark.createDataFrame([("ab c", [("c", [3, 4], "X")])], "text string, entities array<struct<name: string, span: array<int>, type: string>>")
    assert plain(readers.read("dataset_spans", rows).first().ner) == [("X", [(3, 4)])]


def test_token_formats(spark, tmp_path):
    path = write(tmp_path / "s.jsonl", json.dumps({"sentences": [["a", "b"], ["c", "dd"]], "ner": [[[1, 1, "X"]], [[2, 3, "Y"]]]}) + "\n")
    got = readers.read("scier_jsonl", spark, path).orderBy("document_position").collect()
    assert [(r.text, r.space_after, plain(r.ner)) for r in got] == [("a b", " ", [("X", [(2, 3)])]), ("c dd", "", [("Y", [(0, 4)])])]
    path = write(tmp_path / "a.json", json.dumps([{"tokens": ["x", "yy"], "ner": [[0, 1, ["L"]], [1, 1, "M"]]}]))
    assert plain(readers.read("arabic_cross_dialectal_json", spark, path).first().ner) == [("L", [(0, 4)]), ("M", [(2, 4)])]
    line = {"words": ["a", "b", "c", "d", "e"], "sentences": [[0, 2], [2, 4], [4, 5]], "ner": [[4, 5, "Z"], [1, 3, "X"]]}
    path = write(tmp_path / "x.jsonl", json.dumps(line) + "\n")
    got = readers.read("scirex_jsonl", spark, path).orderBy("document_position").collect()
    assert [(r.text, r.space_after, plain(r.ner)) for r in got] == [("a b c d", " ", [("X", [(2, 5)])]), ("e", "", [("Z", [(0, 1)])])]
    rows = spark.createDataFrame([(["a", "b"], [0, 1], ["PER", "O"])], "tokens array<string>, tags array<int>, types array<string>")
    got = readers.read("columns", rows, label_maps={"ner": {"O": 0, "B-x": 1}}).first()
    assert got.ner_iob == ["O", "B-x"] and plain(got.ner) == [("x", [(2, 3)])]
    got = readers.read("columns", rows, tag_columns={"ner": "types"}, type_only=True).first()
    assert got.ner_iob == ["I-PER", "O"]


BIOC = """<?xml version="1.0"?><collection><document><id>7</id>
<passage><offset>0</offset><text>Aspirin helps </text><annotation><infon key="type">Drug</infon><location offset="1" length="7"/><text>Aspirin</text></annotation></passage>
<passage><offset>15</offset><text>left and right arm</text><annotation><infon key="type">Part</infon><location offset="15" length="4"/><location offset="30" length="3"/><text>left arm</text></annotation></passage>
</document><document><id>7</id><passage><offset>0</offset><text>again</text></passage></document></collection>"""


def test_document_formats(spark, tmp_path):
    got = readers.read("bioc_xml", spark, write(tmp_path / "b.xml", BIOC)).orderBy("document_position").collect()
    assert [(r.text, r.space_after) for r in got] == [("Aspirin helps", "\n"), ("left and right arm", "")]
    assert plain(got[0].ner) == [("Drug", [(0, 7)])] and plain(got[1].ner) == [("Part", [(0, 4), (15, 18)])]
    path = write(tmp_path / "p.txt", "1|t|A b\n1|a|C|d\n1\t0\t1\tA\tX\tm\n1\t4\t5\tC\tY\tm\n\n1|t|again\n1|a|x\n\n2|t|E\n2|a|F\n")
    got = readers.read("pubtator", spark, path).orderBy("document", "document_position").collect()
    assert [(r.text, r.space_after, plain(r.ner)) for r in got] == [("A b", "\n", [("X", [(0, 1)])]), ("C|d", "", [("Y", [(0, 1)])]), ("E", "\n", []), ("F", "", [])]
    for name, text, a in (("d1", "Anna saw Rome", "T1\tPER 1 5\tAnna\nR1\tx y\nT2\tLOC 9 13;0 4\tRome Anna\n"), ("d2", " \n", "")):
        write(tmp_path / "brat" / f"{name}.txt", text)
        write(tmp_path / "brat" / f"{name}.ann", a)
    got = readers.read("standoff", spark, str(tmp_path / "brat" / "*.txt"), str(tmp_path / "brat" / "*.ann")).collect()
    assert [(r.text, plain(r.ner)) for r in got] == [("Anna saw Rome", [("PER", [(0, 4)]), ("LOC", [(9, 13), (0, 4)])])]
    write(tmp_path / "nl" / "a.txt", "x\ny Rome")
    write(tmp_path / "nl" / "a.ann", "T1\tLOC 5 9\tRome\n")
    got = readers.read("standoff", spark, str(tmp_path / "nl" / "*.txt"), str(tmp_path / "nl" / "*.ann"), offsets_without_newlines=True).first()
    assert plain(got.ner) == [("LOC", [(4, 8)])]


def test_experiment_frames(spark, tmp_path):
    write(tmp_path / "t" / "d.txt", "We ran it. Ni was hot.")
    write(tmp_path / "s" / "d.tsv", "1\tx\t0\t10\n2\tx\t11\t22\n")
    write(tmp_path / "e" / "d.tsv", "1\t1\t0\t2\tO\tO\n1\t2\t3\t6\tB-EXP\tB-interconnect_material\n2\t1\t0\t2\tB-MAT\tB-anode\n")
    p = lambda k: str(tmp_path / k / "*")
    got = readers.read("sofc_standoff", spark, p("t"), p("s"), p("e")).orderBy("document_position").collect()
    assert [(r.text, r.space_after, r.tokens) for r in got] == [("We ran it.", " ", ["We", "ran"]), ("Ni was hot.", "", ["Ni"])]
    assert plain(got[0].entities) == [("EXP", [(3, 6)])] and plain(got[0].slots) == [] and plain(got[1].slots) == [("anode", [(0, 2)])]
    write(tmp_path / "f" / "d.tsv", "SPAN\t1\tEXPERIMENT:x\t1\t3\t6\nSPAN\t2\tMATERIAL\t2\t0\t2\nEXPERIMENT\t1\t1\nSLOT\tanode\t2\nLINK\tcoreference\t1\t2\nLINK\tmaterial\t1\t2\n")
    got = readers.read("sofc_standoff", spark, p("t"), p("s"), p("f"), "frames").orderBy("document_position").collect()
    assert plain(got[0].entities) == [("EXPERIMENT", [(3, 6)])] and plain(got[0].slots) == [("experiment_evoking_word", [(3, 6)])]
    assert plain(got[1].slots) == [("anode", [(0, 2)]), ("material", [(0, 2)])]


def test_sparse_layers(spark, tmp_path):
    write(tmp_path / "t" / "1.txt", "Rats ate.\n")
    write(tmp_path / "k" / "1.tokens", "Rats\nate\n.\n")
    broad = write(tmp_path / "b" / "participants" / "train" / "x" / "1.AGGREGATED.ann", "1\n0\n0\n")
    fine = write(tmp_path / "g" / "outcomes" / "test" / "gold" / "1.AGGREGATED.ann", "0\n2\n0\n")
    maps = ({"participants": {"O": 0, "I-P": 1}, "train": {"O": 0, "I-P": 1}}, {"outcomes": {"O": 0, "I-Z": 2}})
    got = readers.read("ebm_nlp_standoff", spark, str(tmp_path / "t" / "*"), str(tmp_path / "k" / "*"), broad, fine, *maps).first()
    assert got.text == "Rats ate." and plain(got.broad) == [("P", [(0, 4)])] and plain(got.granular) == [("Z", [(5, 8)])]


def test_split_readers():
    r = readers.SPLIT_READERS
    got = r.get("legalnero_standoff_split_columns")("x/a.txt\ttrain\nb\ttest\n", {"text": "T", "annotations": "A"})
    assert got == {"train": [{"text": "T/x/a.txt", "annotations": "A/x/a.ann"}], "test": [{"text": "T/b.txt", "annotations": "A/b.ann"}]}
    with pytest.raises(ValueError):
        r.get("legalnero_standoff_split_columns")("", {"text": "T"})
    assert r.get("agriner_standoff_split_json")({"dev": '[{"file": "a.txt"}]'}, "D") == {"dev": [{"text": "D/a.txt", "annotations": "D/a.ann"}]}
    got = r.get("somesci_standoff_split_json")('{"train": ["a", "b"]}', "D", lambda p: "a" in p)
    assert got == {"train": [{"text": "D/a.txt", "annotations": "D/a.ann"}]}
    with pytest.raises(TypeError):
        r.get("somesci_standoff_split_json")({}, "D")


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.txt", "1")
        z.writestr("x/two.md", "2")
    assert [p.name for p in archives.extract(tmp_path / "a.zip", tmp_path / "out", ["*.txt"])] == ["one.txt"]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("../evil.txt", "1")
    with pytest.raises(ValueError, match="out of the folder"):
        archives.extract(tmp_path / "b.zip", tmp_path / "out")
    with pytest.raises(ValueError, match="unknown kind"):
        archives.extract(tmp_path / "c.rar", tmp_path / "out")
    archives.verify(spark, str(tmp_path / "out/x/one.txt"), "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b")
    with pytest.raises(archives.ChecksumError):
        archives.verify(spark, str(tmp_path / "out/x/one.txt"), "00")


# --- plans ----------------------------------------------------------------------------------------------------------


def kinds(*names):
    return [steps.Step(n) for n in names]


def test_plan_rules():
    assert [len(s) for s in steps.Plan(kinds("download", "extract", "splits", "convert")).stages] == [1, 1, 1, 1]
    assert [len(s) for s in steps.Plan(kinds("download", "download", "extract", "extract", "splits", "convert")).stages] == [2, 2, 1, 1]
    for bad in (("splits", "convert"), ("download", "splits", "convert", "metadata", "convert"), ("extract",), ("columns",), ("nothing",)):
        with pytest.raises(steps.PlanError):
            steps.Plan(kinds(*bad))
    assert steps.Plan(kinds("columns", "metadata"), "huggingface").stages
    assert steps.Plan(kinds("convert", "metadata"), "git").stages
    assert steps.split_order(["x", "test", "train"]) == ["train", "test", "x"]


def test_nested_plans(spark, tmp_path):
    write(tmp_path / "a.txt", "Anna\tB-PER\n")
    one = lambda split: steps.Step("data_pipe", {"steps": [steps.Step("splits", {"splits": {split: "a.txt"}}), steps.Step("convert", {"reader": "conll"})]})
    before = steps.State(tmp_path)
    after = steps.Plan([one("train"), one("test")]).run(spark, before)
    assert sorted(after.rows) == ["test", "train"] and after.done == {"data_pipe"} and not before.rows
    with pytest.raises(steps.PlanError, match="there already"):
        steps.Plan([one("train"), one("train")]).run(spark, before)
    with pytest.raises(steps.PlanError, match="a second 'convert' step, at position 1"):
        steps.Plan(kinds("git", "convert", "convert", "metadata")[:3])


def test_normalised_splits(spark, tmp_path):
    def parts(splits, **naming):
        found = list(columnar.normalised({k: spark.createDataFrame(v, "x int, lang string") for k, v in splits.items()}, columnar.Naming(**naming)))
        return [(p.split, p.language, p.subset, sorted(r.x for r in p.rows.collect())) for p in found]

    one = {"tr": [(1, "a"), (2, "a")], "dev": [(3, "b"), (4, "c"), (5, "b")]}
    assert parts(one, train="tr", validation="dev", language="eng") == [("train", "eng", (), [1, 2]), ("validation", "eng", (), [3, 4, 5])]
    got = parts(one, train="tr", validation="dev", language_column="lang", subset="s", only_subset=False)
    s = ("s", None)
    assert got == [("train", "a", (s,), [1, 2]), ("validation", "b", (s, ("b", "language")), [3, 5]), ("validation", "c", (s, ("c", "language")), [4])]
    named = {"train_2019_deu": [(1, "a")], "dev_2020": [(2, "b")]}
    pattern = r"(?P<split>[a-z]+)_(?P<year>\d+)(_(?P<language>[a-z]+))?"
    got = parts(named, validation="dev", train=None, pattern=pattern, language="eng")
    assert got == [("train", "deu", (("deu", "language"), ("2019", "year")), [1]), ("validation", "eng", (("2020", "year"),), [2])]
    got = parts({"train": [(1, "a")]}, subset="en-x", subset_pattern="(?P<language>[a-z]+)-x")
    assert got == [("train", "en", (("en-x", "language"),), [1])]
    for bad in ({"language": None}, {"pattern": "(?P<split>x)", "language": "e"}, {"pattern": "(?P<split>.*)"}, {"pattern": "(?P<split>.*?)(?P<town>.*)", "language": "e"}, {"subset_pattern": "(?P<language>z)"}):
        with pytest.raises(ValueError):
            parts({"train": [(1, "a")]}, **bad)
    spark.createDataFrame([(["a"], ["B-x"], "p"), (["b"], ["O"], "q")], "tokens array<string>, tags array<string>, lang string").write.parquet(f"{tmp_path}/t")
    plan = [steps.Step("columns", {"splits": {"train": "tr", "language_column": "lang"}})]
    after = steps.Plan(plan, "huggingface").run(spark, steps.State(tmp_path, files={"tr": [f"{tmp_path}/t"]}))
    assert {k: v.count() for k, v in after.rows.items()} == {"p/train": 1, "q/train": 1}


def test_local_tables(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'word,tag\nNA,O\n,B-x\n"nu""ll",O\n')
    rows = columnar.load(spark, path, "csv", ["text", "tag"], {"word": "text"})
    assert [tuple(r) for r in rows.collect()] == [("NA", "O"), ("", "B-x"), ('nu"ll', "O")]
    assert columnar.load(spark, write(tmp_path / "b.json", '{"a": 1}\n'), "json").first().a == 1
    with pytest.raises(ValueError, match="unknown kind"):
        columnar.load(spark, path, "xls")


def test_imported_rows_and_own_splitters(spark, rows):
    texts = rows.withColumn("sequence_id", F.lit("c9d3a311-7c27-4a86-b6fb-a52aa9f53b63"))
    got = store.imported(texts).first()
    assert bytes(got.sequence_id).hex() == "c9d3a3117c274a86b6fba52aa9f53b63"
    df = spark.createDataFrame([("a; b ;c",), ("",), (None,)], "t string")
    got = df.select(documents.split_by(F.col("t"), lambda t: t.split(";")).alias("x")).collect()
    assert [r.x and [tuple(s) for s in r.x] for r in got] == [[(0, 1), (3, 4), (6, 7)], [], None]


def test_boundary_tables(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(boundaries, "RANGE", 2)
    more = rows.withColumn("sentence_offsets", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("stop"))))
    want = [(r.document_index, r.document_position, i) for i, r in enumerate(rows.orderBy("document_index", "document_position").collect())]
    got = boundaries.numbered(rows).select("document_index", "document_position", "sequence_index").orderBy("sequence_index").collect()
    assert [tuple(r) for r in got] == want
    boundaries.write_boundaries(more, str(tmp_path / "b"), "demo.parquet")
    table = boundaries.read_boundaries(spark, str(tmp_path / "b"))
    ids_ = {r.sequence_index: bytes(r.sequence_id) for r in table.collect()}
    assert ids_[3] == bytes(spark.range(1).select(ids.segment_id(F.lit("demo.parquet"), F.lit(3)).alias("x")).first().x)
    found = boundaries.with_boundaries(rows, table).collect()
    assert len(found) == 5 and all(tuple(r.sentence_offsets[0]) == (0, len(r.text)) for r in found)
    split = documents.split_sentences(boundaries.with_boundaries(rows.fillna("").withColumn("ner", F.coalesce("ner", F.array().cast(ANN))), table))
    assert split.count() == 5
    with pytest.raises(Exception, match="no sentence boundaries"):
        boundaries.with_boundaries(rows, table.where("sequence_index <> 2")).collect()


def test_build_export_and_list(spark, tmp_path, capsys):
    source = tmp_path / "src"
    write(source / "train.txt", "Anna\tB-PER\nsat\tO\n\nRome\tB-LOC\n")
    write(source / "test.txt", "Bo\tB-PER\n")
    out = tmp_path / "corpus"
    options = {"dataset": "demo", "subset": "en", "language": "eng", "output": str(out), "metadata": [{"license": "MIT"}, {"split": ["en.test"], "license": "X"}]}
    plan = [
        steps.Step("splits", {"splits": {"train": "train.txt", "test": "test.txt"}}),
        steps.Step("convert", {"reader": "conll"}),
        steps.Step("metadata", options),
    ]
    steps.Plan(plan, completed=["git"]).run(spark, steps.State(source))
    [dataset] = store.datasets(out)
    [subset] = list(dataset)
    assert (dataset.name, dataset.main_splits, subset.labels, subset.bio_labels) == ("demo", ["train", "test"], {"ner": ["LOC", "PER"]}, {"ner": ["B-LOC", "B-PER", "O"]})
    assert (subset.splits["train"].document_count, subset.splits["train"].sequence_count) == (2, 2)
    assert subset.splits["test"].creation_metadata == {"license": "X"} and "dev" not in subset
    rows = store.scan_split(spark, dataset, subset, "train").orderBy("document_index").collect()
    assert [(r.document_index, r.text, len(r.sequence_id)) for r in rows] == [(0, "Anna sat", 16), (1, "Rome", 16)]
    assert store.scan_split(spark, dataset, subset, "train", ["text"]).columns == ["text"]
    assert store.catalog(spark, out).count() == 2
    assert store.dataset_names(tmp_path / "none") == []
    maps = {"demo": {("en",): {"ner": {"PER": "person", "LOC": "place"}}}}
    card = export.export(spark, out, tmp_path / "hub", label_maps=maps)
    assert card["configs"][0]["config_name"] == "demo--en" and card["size_categories"] == "n<1K" and card["language"] == ["eng"]
    got = spark.read.parquet(str(tmp_path / "hub/demo--en/train")).orderBy("document_index").first()
    assert got.sequence_id.count("-") == 4 and [a.label for a in got.ner] == ["person"] and got.ner_iob == ["B-person", "O"]
    assert "demo--en" in (tmp_path / "hub/README.md").read_text()
    assert export.export(spark, out, tmp_path / "none", keep=lambda s: s["split"] == "train")["configs"] == []
    from tagloom import cli

    assert cli.main(["list", str(out)]) == 0 and capsys.readouterr().out.strip() == "demo"
    assert cli.word_counts(spark, str(out)).agg(F.sum("total_token_count")).first()[0] == 4
    merged = merging.merge_splits(store.all_splits(spark, out), {})
    assert merged.count() == 3


def test_command_line(spark, tmp_path, capsys):
    from tagloom import cli

    for name, words_ in (("AnatEM", "Anna\tB-PER\nsat\tO\n"), ("other", "Rome\tB-LOC\n\na\tO\nb\tO\n")):
        write(tmp_path / name / "train.txt", words_)
        options = {"dataset": name, "language": "eng", "output": str(tmp_path / "corpus")}
        plan = {"steps": [{"step": "splits", "splits": {"train": "train.txt"}}, {"step": "convert", "reader": "conll"}, {"step": "metadata", **options}], "completed": ["git"]}
        assert cli.main(["build", json.dumps(plan), str(tmp_path / name)]) == 0
    corpus, out = str(tmp_path / "corpus"), str(tmp_path / "counts")
    total = lambda: {r.dataset_name: (r.n, r.t) for r in spark.read.parquet(out).groupBy("dataset_name").agg(F.count("*").alias("n"), F.sum("total_token_count").alias("t")).collect()}
    assert cli.main(["count-words", corpus, out, "-d", "open"]) == 0 and total() == {"AnatEM": (1, 2)}
    assert cli.main(["count-words", corpus, out, "--append", "-w", "2"]) == 0 and total() == {"AnatEM": (1, 2), "other": (2, 3)}
    assert cli.main(["count-words", corpus, out, "--append"]) == 0 and total() == {"AnatEM": (1, 2), "other": (2, 3)}
    assert cli.main(["count-words", corpus, out, "--tokenizers", '{"eng": "builtins:list"}']) == 0 and total() == {"AnatEM": (1, 8), "other": (2, 7)}
    assert cli.main(["sample", corpus, "eng", str(tmp_path / "s"), "-n", "5", "-m", "--target-tokens", "4", "--tokenizer", "builtins:list", "--without-entities"]) == 0
    assert spark.read.parquet(str(tmp_path / "s")).count() >= 3
    extra = write(tmp_path / "note.txt", "x")
    assert cli.main(["export", corpus, str(tmp_path / "hub"), "-d", "other", "--extra-files", json.dumps({"other": [extra]})]) == 0
    assert sorted(p.name for p in (tmp_path / "hub").iterdir()) == ["README.md", "other"] and (tmp_path / "hub/other/note.txt").exists()
    bib = write(tmp_path / "b.bib", "".join(f"@misc{{{k},\n title={{{k}}}\n}}\n" for k in ("own", "AnatEM", "z")))
    capsys.readouterr()
    assert cli.main(["cite", bib, "--own", "own", "-d", "AnatEM"]) == 0 and capsys.readouterr().out.split("{")[1].startswith("AnatEM")
    assert cli.main(["cite", bib, "--own", "own", "--always", "z", "-d"]) == 0 and capsys.readouterr().out.count("@misc") == 2
    with pytest.raises(ValueError, match="unknown"):
        cli.main(["count-words", corpus, out, "-d", "nothing"])


def test_languages(spark):
    from tagloom.functions import text

    df = spark.createDataFrame([("kat",), ("mya",), ("khm",), ("amh",), ("deu",), ("zho",), ("kor",), ("srp",), ("qqq",)], "c string")
    got = [r[0] for r in df.select(text.tokenizer_language(F.col("c"))).collect()]
    assert got == ["kat_Geor", "mya_Mymr", "khm_Khmr", "amh_Ethi", "deu_Latn", "cmn_Hani", "kor_Hang", "srp_Cyrl", "qqq"]
    assert len(text.LANGUAGE_CODES) == 183 and len(set(text.LANGUAGE_CODES.values())) == 183


def test_numbers_of_rows_of_files(spark, tmp_path):
    """Rows of a file have its name and their place there, whatever tasks read them."""
    spark.range(100).selectExpr("array(string(id)) as tokens", "array('O') as tags").coalesce(1).write.parquet(f"{tmp_path}/t")
    got = readers.read("columns", spark.read.parquet(f"{tmp_path}/t")).select("source", "document", "text").collect()
    assert {(int(r.text), r.document) for r in got} == {(i, i) for i in range(100)} and all(".parquet" in r.source for r in got)


def test_spans_of_several_places(spark, tmp_path):
    said = lambda text, at: f'<annotation><infon key="type">X</infon>{"".join(f"""<location offset="{a}" length="{n}"/>""" for a, n in at)}<text>{text}</text></annotation>'
    body = said("left lung", [(0, 4), (15, 4)]) + said("left lung", [(1, 4), (14, 4)])
    path = write(tmp_path / "b.xml", f"<collection><document><id>1</id><passage><offset>0</offset><text>left and right lung</text>{body}</passage></document></collection>")
    assert plain(readers.read("bioc_xml", spark, path).first().ner) == [("X", [(0, 4), (15, 19)])] * 2


def test_selectors():
    fits = metadata.selects
    assert fits("a.*.train", ["a", "x"], "train") and not fits("a.*.train", ["a"], "train") and not fits("a.*.train", ["a", "x"], "test")
    assert fits("train", ["train"], "test") and fits("a", ["a"], "dev") and not fits("a", ["ab"], "dev") and not fits("a", ["a", "b"], "dev")
    assert fits("x.dev", ["x", "dev"], "test") and fits("a+b.test", ["a+b"], "test") and not fits("a+b", ["aab"], "test")
    assert metadata.compiled("a.test")[1:] == (1, 1) and metadata.compiled("*.a")[1:] == (0, 1) and metadata.compiled("train")[1:] == (0, 1)


def folded(entries, path, split):
    """From the least to the most specific entry, each laid over what was there."""
    found = []
    for entry in entries:
        ranks = [metadata.compiled(s)[1:] for s in entry.get("split") or [] if metadata.selects(s, path, split)]
        if not entry.get("split") or ranks:
            found.append((max(ranks, default=(0, 0)), entry))
    out = {}
    for _, entry in sorted(found, key=lambda x: x[0]):
        for k, v in entry.items():
            if k == "annotation":
                out[k] = out.get(k, {}) | {a: b for a, b in v.items() if b is not None}
            elif k != "split" and v is not None:
                out[k] = v
    return out


def test_cascade(spark):
    entries = [
        {"split": ["*"], "annotation": {"type": "gold", "annotator_count": 2}},
        {"license": "A", "annotation": {"type": "silver", "agreement": 0.5}, "primary_domain": "news"},
        {"split": ["x.train", "x"], "license": "B"},
        {"split": ["*.test"], "primary_domain": "web", "data_sources": ["p", "q"]},
        {"split": ["x"], "license": {"text": "T", "annotations": "U"}},
    ]
    places = [([p], s) for p in ("x", "y.z", "y") for s in ("train", "test")] + [([], "train"), (["x", "y"], "test")]
    for path, split in places:
        assert metadata.cascade(entries, path, split) == folded(entries, path, split)
    df = spark.createDataFrame(places, "subset array<string>, split string")
    for r in metadata.cascades(df, entries).collect():
        said = {k: json.loads(v) for k, v in (r.said or {}).items()}
        assert metadata._nested(said) == folded(entries, r.subset, r.split)
    assert metadata.cascades(df.limit(0), entries).count() == 0
    with pytest.raises(ValueError):
        metadata.cascade([{"nothing": 1}], ["x"], "train")


def test_licenses_profiles_and_references():
    assert metadata.licenses({"license": {"annotations": "B", "text": {"a": "A", "b": "B"}}}) == ["A", "B"]
    assert metadata.licenses({}) == []
    assert metadata.resolve(["p", "c"], {"a", "b", "c"}, {"p": ["a"]}) == {"a", "c"}
    with pytest.raises(ValueError, match="unknown"):
        metadata.resolve(["z"], {"a"})
    assert {k: len(v) for k, v in metadata.PROFILES.items()} == {"open": 43, "non-proprietary-eval": 58, "non-proprietary": 59, "full": 60}
    assert metadata.resolve(["open", "WikiANN"], set(metadata.PROFILES["full"])) == {*metadata.PROFILES["open"], "WikiANN"}
    assert metadata.resolve(None, {"a"}) == {"a"}
    entries = {"own": "O", "k": "K", "always": "W"}
    assert metadata.references({"d": ["k"]}, entries, "own") == ["O", "K", "W"]
    assert metadata.references({"d": ["k"]}, entries, "own", [], "always") == ["O", "W"]
    assert metadata.references({"d": ["k"]}, entries, "own", ["d"]) == ["K"]


def test_registry():
    r = registry.Registry("thing")
    r.register("a")(1)
    assert r.get("a") == 1 and r.keys() == ["a"]
    with pytest.raises(ValueError):
        r.register("a")(2)
    with pytest.raises(KeyError):
        r.get("b")


def test_schema():
    s = sequence_schema(["fine", "coarse"], True)
    assert [f.name for f in s.fields][6:] == ["tokens", "fine", "coarse", "fine_iob", "coarse_iob"]
    assert tagsets_of(s) == ["fine", "coarse"]


def test_stream(spark, tmp_path):
    from tagloom.streaming import stream_word_stats

    df = spark.createDataFrame([(1, "a 2")], "i long, text string")
    df.write.parquet(str(tmp_path / "in"))
    q = stream_word_stats(spark, str(tmp_path / "in"), df.schema, ["i"]).writeStream.format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select total_token_count from counts").first()[0] == 2
