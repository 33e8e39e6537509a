"""Small tables with the cases that every operator must handle."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, low string, id string, norm string, part int, shard int"
SEP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SEP.split(text or "") if w]


def odd_texts():
    """Nulls, empties, blanks, very long texts, ties, accents, marks, special strings."""
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)] + ["Émile", "naïve,", "x" * 300, "日本語", "áb", "<|endoftext|>", "don't", " gap", "İ", "ΣΑΣ", "🙂"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    long = prose(9000)
    base = prose(300)
    near = base.split()
    near[17] = "changed"
    return [
        None,
        "",
        " \t\n ",
        "one",
        "two words",
        "a b c",
        "Hello　world\x1fx\u0085y",
        long,
        long,
        base,
        base.replace(" ", "\n\t "),
        " ".join(near),
        "Released under the MIT License.\nsome words",
        "mit license MIT LICENSE apache  license, general\npublic license",
        "Licensed under CC BY-NC 4.0.",
        *(prose(r.randint(1, 120)) for _ in range(40)),
    ]


def odd_rows(texts=None):
    texts = odd_texts() if texts is None else texts
    rows = [(i * 3, t, "en", "src0", 1, "k", "l", "i", "n", 0, 0) for i, t in enumerate(texts)]
    return rows + [rows[-1], rows[9], (None, "no id", None, None, None, None, None, None, None, None, None), (None, None, *[None] * 9)]


def odd_docs(spark, texts=None):
    return spark.createDataFrame(odd_rows(texts), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
