import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import ann, mixing, recurrent_lm, toxicity

from .fixtures import SCHEMA, empty_docs, odd_docs, odd_rows, words

# --- nearest neighbours ---------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, id long, vec int, label int"


def vectors(n=900, d=12, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, d))
    x = centres[r.integers(20, size=n)] + 0.5 * r.normal(size=(n, d))
    x[5:40] = x[3]  # copies
    x[41] = 2 * x[3]
    rows = [(i, v.tolist(), 1, 2, 3) for i, v in enumerate(x)]
    rows += [(2000, None, 1, 1, 1), (2001, [0.0] * d, 1, 1, 1), (2002, [None] + [1.0] * (d - 1), 1, 1, 1), (2003, [float("nan")] * d, 1, 1, 1)]
    rows += [(2004, [float("inf")] * d, 1, 1, 1), (2005, [1.0], 1, 1, 1), (None, x[0].tolist(), 1, 1, 1), (2006, [], 1, 1, 1)]
    return rows, x


def brute_neighbours(x, queries, k=5):
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    for q in queries:
        s = np.einsum("ij,j->i", x, x[q]) / (norms * norms[q])
        s[q] = -np.inf
        order = np.lexsort((np.arange(len(x)), -s))[:k]
        yield q, [(int(i), s[i]) for i in order if np.isfinite(s[i])]


def test_search_reaches_its_recall(spark, monkeypatch):
    for name, value in (("LEAF", 10), ("BLOCK_ROWS", 200), ("BLOCK_QUERIES", 7)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(ann.fit, "__defaults__", (10, 8, 0))
    rows, x = vectors()
    table = spark.createDataFrame(rows, VECTORS)
    got = ann.search(table, table.where("vec_id % 10 = 0 or vec_id > 1000")).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = dict(brute_neighbours(x, range(0, len(x), 10)))
    assert by.keys() == want.keys()
    met = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        for _, i, score in found:
            assert score == pytest.approx(x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i]), abs=1e-14)
        met += len({f[1] for f in found} & {i for i, _ in want[q]})
    assert met >= 0.9 * 5 * len(want)
    assert [f[1] for f in by[10]][:5] == [i for i, _ in want[10]][:5]  # among copies, the smallest ids


def test_few_and_no_vectors(spark):
    rows = [(i, [1.0, float(i)], 0, 0, 0) for i in range(3)]
    table = spark.createDataFrame(rows, VECTORS)
    got = ann.search(table, table)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == [(0, 1, 1), (0, 2, 2), (1, 1, 2), (1, 2, 0), (2, 1, 1), (2, 2, 0)]
    none = spark.createDataFrame([], VECTORS)
    assert ann.search(none, none).count() == 0
    assert ann.search(table, none).count() == 0


def test_walk_meets_every_leaf_nearest_first():
    x = ann._unit(np.random.default_rng(1).normal(size=(500, 6)))
    tree = ann.fit(x, 20, 4)
    order = ann.visits(tree, x[7], tree.n_leaves)
    assert sorted(order) == list(range(tree.n_leaves))
    assert ann.assign(tree, x[7:8])[0] in order[:3]
    assert (ann.assign(tree, np.repeat(x[9:10], 50, axis=0)) == ann.assign(tree, x[9:10])).all()


# --- toxicity -------------------------------------------------------------------------------------------------------


def toxic_rows(n=400, seed=2):
    r = random.Random(seed)
    pool, bad = [f"w{i}" for i in range(300)], ["awful", "nasty", "vile"]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(pool) for _ in range(r.choice([5, 40, 200, 1500]))]
        y = int(r.random() < 0.3)
        for _ in range(3 * y):
            text.insert(r.randrange(len(text)), r.choice(bad) + r.choice(["", ",", "!!"]))
        rows.append((i, " ".join(text), "en", "s", 1, "k", "l", "i", "n", 0, 0))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows + [(900, None, *[None] * 9), (901, "", *[None] * 9), (None, "w1 vile", *[None] * 9)], SCHEMA)
    got = {r.doc_id: r for r in toxicity.score(docs, table).collect()}
    assert len(got) == len(rows) + 3
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i if i is not None else "").encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert got[900].score == got[901].score
    left = toxicity.drop_toxic(docs, table)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, r in got.items() if not r.predicted)


def test_bounded_sample_keeps_the_class_rates(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, " ".join(f"w{r.randrange(40)}" for _ in range(30)), int(i % 10 == 0)) for i in range(2000)]
    docs = spark.createDataFrame([x[:2] for x in rows], "id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "id long, y int")
    plain, asked = toxicity.logistic, []
    monkeypatch.setattr(toxicity, "logistic", lambda x, y, *a, **k: asked.append((x, y, k)) or plain(x, y, *a, **k))
    _, w = toxicity.train(docs, labels, 100)  # texts tell nothing, a tenth of the labels is toxic
    x, y, _ = asked[0]
    assert 0.4 < y.mean() < 0.6
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert p[y == 0].mean() < 0.2
    even = plain(x, y)
    assert (1 / (1 + np.exp(-(x @ even[:-1] + even[-1])))).mean() > 0.4


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(odd_docs(spark), none).collect()} == {0.5}
    assert toxicity.score(empty_docs(spark), none).count() == 0
    assert toxicity.drop_toxic(empty_docs(spark), none).count() == 0


class PlainKneserNey:
    """The formulas of the module, by dictionaries; None is the start as a context, and the unknown word as a word."""

    def __init__(self, texts, marks, d=toxicity.DISCOUNT):
        self.d, self.n = d, (Counter(), Counter())
        for t, y in zip(texts, marks, strict=True):
            ws = [toxicity.clean(w) for w in words(t)]
            self.n[y].update(zip([None, *ws], ws, strict=False))
        both = set(self.n[0]) | set(self.n[1])
        self.vocabulary = {w for _, w in both}
        left = Counter(w for _, w in both)
        whole = left.total() + 0.5 * (len(self.vocabulary) + 1)
        self.shared = {w: (left[w] + 0.5) / whole for w in [*self.vocabulary, None]}

    def alone(self, c, w):
        kinds = Counter(x for _, x in self.n[c])
        if not kinds:
            return self.shared[w]
        return (max(kinds[w] - self.d, 0) + self.d * len(kinds) * self.shared[w]) / kinds.total()

    def after(self, c, v, w):
        follow = {x: k for (y, x), k in self.n[c].items() if y == v}
        if not follow:
            return self.alone(c, w)
        return (max(follow.get(w, 0) - self.d, 0) + self.d * len(follow) * self.alone(c, w)) / sum(follow.values())


def test_kneser_ney_against_plain_formulas():
    r = random.Random(11)
    pool = [f"v{k}" for k in range(12)]
    texts = [" ".join(r.choice(pool[: 8 + 4 * (i % 2)]) for _ in range(r.randint(0, 12))) for i in range(30)] + [None, "", "Same, same SAME!"]
    marks = [i % 2 for i in range(len(texts))]
    model, plain = toxicity.fit(pa.array(texts, pa.string()), np.array(marks)), PlainKneserNey(texts, marks)
    for c in (0, 1):
        for v in [None, *plain.vocabulary]:
            assert sum(plain.after(c, v, w) for w in [*plain.vocabulary, None]) == pytest.approx(1)
        assert sum(plain.alone(c, w) for w in [*plain.vocabulary, None]) == pytest.approx(1)
    asked = [" ".join(r.choice([*pool, "new", "other"]) for _ in range(20)) for _ in range(20)] + [None, "", "new", "v1"]
    pairs, alone, offsets = toxicity.ratios(model, pa.array(asked, pa.string()))
    x = toxicity.features(model, pa.array(asked, pa.string()))
    for i, t in enumerate(asked):
        ws = [w if w in plain.vocabulary else None for w in map(toxicity.clean, words(t))]
        unseen = object()
        before = [None, *[unseen if w is None else w for w in ws]][: len(ws)]
        by_word = [math.log(plain.alone(1, w) / plain.alone(0, w)) for w in ws]
        by_pair = [math.log(plain.after(1, v, w) / plain.after(0, v, w)) for v, w in zip(before, ws, strict=True)]
        assert alone[offsets[i] : offsets[i + 1]] == pytest.approx(by_word, abs=1e-5)
        assert pairs[offsets[i] : offsets[i + 1]] == pytest.approx(by_pair, abs=1e-5)
        if not ws:
            assert (x[i] == 0).all()
            continue
        best = [max(sum(by_word[a : a + k]) / k for a in range(0, len(ws), max(1, k // 2))) for k in toxicity.SEGMENTS]
        assert x[i] == pytest.approx([np.mean(by_pair), np.mean(by_word), *best], abs=1e-5)


def test_scores_are_the_fit_over_plain_formulas(spark):
    """The whole operator against brute force: folds, counts, features, fit and score."""
    rows, labels = toxic_rows(120, 4)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, table).collect()}
    text = {r[0]: r[1] for r in rows}
    marks = spark.createDataFrame([(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5], "id long, y int")
    sample = toxicity._labelled(docs.withColumnRenamed("doc_id", "id"), marks, toxicity.PER_CLASS, 5).orderBy("id").collect()
    x, y, seen = [], [], None
    for k in range(toxicity.FOLDS):
        seen = toxicity.fit(pa.array([s.text for s in sample if s.fold != k]), np.array([s.y for s in sample if s.fold != k]))
        held = [s for s in sample if s.fold == k]
        x += [toxicity.features(seen, pa.array([s.text]))[0] for s in held]
        y += [s.y for s in held]
    stands = Counter(s.y for s in sample)
    w = toxicity.logistic(np.array(x), np.array(y, float), stands_for=np.array([1.0 if stands[v] else 0.0 for v in y]))
    for i, t in text.items():
        odds = float(toxicity.features(seen, pa.array([t], pa.string()))[0] @ w[:-1] + w[-1])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6)


def test_every_word_and_bigram_of_the_sample_is_kept(spark):
    rows = [(i, f"a{i} b{i} c{i % 3} both sides" + " once more" * (i % 2), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "id long, y int")
    m = toxicity.unpacked(toxicity.train(docs, labels)[0])
    seen = {r.id for r in toxicity._labelled(docs, labels, toxicity.PER_CLASS, 5).where(f"fold <> {toxicity.FOLDS - 1}").collect()}
    texts = [t.split() for i, t, _ in rows if i in seen]
    assert set(m.words.tolist()) == set(toxicity.hashed(sorted({w for t in texts for w in t})).tolist())
    assert len(m.keys) == len({p for t in texts for p in zip([None, *t], t)})  # noqa: B905


def test_toxic_rows_go_with_any_columns(spark):
    rows, labels = toxic_rows(150)
    table = spark.createDataFrame([(i, y, 9) for i, _, y in labels], "doc_id long, toxic int, id long")
    docs = spark.createDataFrame([(r[0], r[1], 1, "q", 0.5) for r in rows], "doc_id long, text string, y int, fold string, score double")
    left = toxicity.drop_toxic(docs, table)
    assert left.columns == docs.columns
    kept = {r.doc_id for r in left.collect()}
    assert kept == {r.doc_id for r in toxicity.score(docs, table).where("predicted = 0").collect()}
    assert toxicity.drop_toxic(docs, table.where("toxic = 1")).count() == toxicity.drop_toxic(docs, table.limit(0)).count() == docs.count()


# --- language model -------------------------------------------------------------------------------------------------


def lower(text):
    return words("".join(c.lower() if c.isascii() else c for c in text or ""))


def test_language_model_against_plain_counts(spark):
    got = recurrent_lm.score(odd_docs(spark)).collect()
    rows = odd_rows()
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2 for r in rows]
    counts = Counter()
    for r, out in zip(rows, held, strict=True):
        if not out:
            counts.update([*lower(r[1]), None])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r, out in zip(rows, held, strict=True):
        tokens = [*lower(r[1]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want[r[0], out, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_language_model_learns_context(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        kind = i % 2
        rows.append((i, " ".join(f"{'ab'[kind]}{r.randrange(300)} {'xy'[kind]}{r.randrange(40)}" for _ in range(60)), *["k"] * 2, 1, *["k"] * 4, 0, 0))
    got = recurrent_lm.score(spark.createDataFrame(rows, SCHEMA)).where("held_out").collect()
    assert sum(x.score for x in got) > 0.9 * sum(x.base_score for x in got)
    assert recurrent_lm.score(empty_docs(spark)).count() == 0


def test_kinds_are_fitted_on_all_training_documents(spark, monkeypatch):
    r, seen = random.Random(6), []
    letters = ["etaoin", "shrdlu", "жзийкл", "αβγδεζ", "mnopqr", "uvwxyz"]
    texts = ["".join(r.choices(letters[i % 6], k=r.randint(20, 60))) for i in range(3000)]
    rows = [(None if i % 11 == 0 else i // 2, t) for i, t in enumerate(texts)]  # null ids, and ids that come twice
    monkeypatch.setattr(recurrent_lm, "count_words", lambda docs, centres: seen.append(centres) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        recurrent_lm.score(spark.createDataFrame(rows, "doc_id int, text string").repartition(7))
    x = recurrent_lm.letters(pa.array([t for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]))
    own = recurrent_lm.kind_of(seen[0], x)
    assert len(x) > 2400 and len(set(own)) == recurrent_lm.KINDS
    for k, centre in enumerate(seen[0]):  # at rest, a centre is the mean of all that are nearest to it
        assert centre == pytest.approx(x[own == k].mean(0), abs=1e-4)


def small_weights(dtype=np.float32):
    """Three classes of four slots, of which one doesn't exist, and two classes of one: targets 0 to 13, and 14 starts a text."""
    slots = np.arange(1, 13.0).reshape(3, 4)
    slots[1, 2] = 0
    return {k: v.astype(dtype) for k, v in recurrent_lm.initial(np.arange(1, 6.0), slots, 5).items()}


def plain_probabilities(w, h):
    """P(slot | state) of all slots, in plain steps."""
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    classes = soft(h @ w["leave"] + w["bias"])
    full = len(w["inner"])
    return np.concatenate([*(classes[c] * soft(h @ w["inner"][c] + w["tilt"][c]) for c in range(full)), classes[full:]])


def plain_step(w, x, h):
    k = len(h)
    a, u = w["embed"][x] @ w["enter"] + w["shift"], h @ w["turn"]
    z, r = (1 / (1 + np.exp(-(a + u)[i * k : (i + 1) * k])) for i in (0, 1))
    n = np.tanh(a[2 * k :] + r * u[2 * k :])
    return z * h + (1 - z) * n


def test_state_is_carried_through_whole_texts(monkeypatch):
    w = small_weights()
    r = np.random.default_rng(0)
    real = np.delete(np.arange(14), 6)
    codes = [r.choice(real, k) for k in (1, 7, 200, 3, 200)]
    bounds = np.r_[0, np.cumsum([len(c) for c in codes])]
    want = []
    for c in codes:
        h, x, total = np.zeros(5), 14, 0.0
        for y in c:
            h = plain_step(w, x, h)
            p = plain_probabilities(w, h)
            assert p.sum() == pytest.approx(1) and p[6] == 0
            total += np.log(p[y])
            x = y
        want.append(total)
    for rows in (1, 50, 10**6):
        monkeypatch.setattr(recurrent_lm, "OUTPUT_ROWS", rows)
        assert recurrent_lm.log_likelihoods(w, np.concatenate(codes), bounds) == pytest.approx(want, rel=1e-4)


def test_large_logits_stay_finite():
    w = small_weights()
    w["leave"], w["inner"] = w["leave"] * 1e5, w["inner"] * 1e5
    r = np.random.default_rng(0)
    codes = r.choice(np.delete(np.arange(14), 6), 50)
    assert np.isfinite(recurrent_lm.log_likelihoods(w, codes, np.array([0, 50]))).all()


def odd_model(spark):
    docs = odd_docs(spark).selectExpr("doc_id as id", "coalesce(text, '') as text", "false as held_out")
    counts = recurrent_lm.count_words(docs.select("text"), recurrent_lm.fit_kinds(np.random.default_rng(1).random((50, 90)), recurrent_lm.KINDS))
    return docs, counts, recurrent_lm.build(counts, 40)


def known_words(m):
    """The place of a head word, or None."""
    place = {int(h): i for i, h in enumerate(m.known)}
    return lambda word: place.get(int(recurrent_lm.hash_words(pa.array([word], pa.string()))[0]))


def test_shapes_of_words():
    words_ = ["a", "a.", "", "été", "日本", "x日", "ß,", "½", "3", "İ"]
    want = [(0 if w.isascii() else 1 + ord(next(c for c in w if not c.isascii())) % 6) * 2 + w[-1:].isalnum() for w in words_]
    assert recurrent_lm.shapes(pa.array(words_)).tolist() == want and max(want) < recurrent_lm.TAIL


def test_probabilities_of_all_words_sum_to_one(spark):
    _, counts, m = odd_model(spark)
    rows, known = counts.collect(), known_words(m)
    w = {k: v + np.random.default_rng(2).normal(0, 0.1, v.shape).astype(np.float32) for k, v in m.weights.items()}
    for h in np.random.default_rng(3).uniform(-1, 1, (3, recurrent_lm.HIDDEN)):
        p = plain_probabilities(w, h)
        total = sum(p[s] * 10**i for s, i in zip(*m.of_code[:2], strict=True))
        rare = [(r.word, r.n) for r in rows if known(r.word) is None]
        assert rare and len(m.known) <= 40 and len(rare) + len(m.known) == len(rows)
        for shape, (_, n) in zip(recurrent_lm.shapes(pa.array([x for x, _ in rare])), rare, strict=True):
            total += p[recurrent_lm.FIRST_TAIL + shape] * (n + 1) / 10 ** m.tail[shape]
        for shape in range(recurrent_lm.TAIL):  # the unknown word of each shape
            total += p[recurrent_lm.FIRST_TAIL + shape] / 10 ** m.tail[shape]
        assert total == pytest.approx(1, abs=1e-5)


def test_score_against_plain_steps(spark):
    """Texts of known, rare and unknown words: log10 of the three factors, step by step."""
    _, counts, m = odd_model(spark)
    n, known = {r.word: r.n for r in counts.collect()}, known_words(m)
    texts = [None, "", "w1 w2 Émile", "never Seen w3 日本語 zzz", odd_rows()[8][1]]
    docs = spark.createDataFrame([(i, t or "", False) for i, t in enumerate(texts)], "id long, text string, held_out boolean")
    for r in recurrent_lm.coded_documents(docs, m).collect():
        h, x, total, inside = np.zeros(recurrent_lm.HIDDEN), recurrent_lm.START, 0.0, 0.0
        words_ = [*lower(texts[r.id]), recurrent_lm.END]
        for word in words_:
            h = plain_step(m.weights, x, h)
            if known(word) is not None:
                x = m.of_code[0][known(word)]
                inside += m.of_code[1][known(word)]
            else:
                shape = recurrent_lm.shapes(pa.array([word]))[0]
                x = recurrent_lm.FIRST_TAIL + shape
                inside += np.log10(n.get(word, 0) + 1) - m.tail[shape]
            total += np.log10(plain_probabilities(m.weights, h)[x])
        found = recurrent_lm.log_likelihoods(m.weights, recurrent_lm.unpacked(r.codes), np.array([0, len(r.codes) // 2]))[0] / np.log(10)
        hashed = {int(x): w for w, x in zip(words_, recurrent_lm.hash_words(pa.array(words_)).view(np.int64), strict=True)}
        rest = sum(t.k * np.log10(n.get(hashed[t.h], 0) + 1) for t in r.tail)
        assert found == pytest.approx(total, rel=1e-4)
        assert r.inside + rest == pytest.approx(inside)


def test_training_uses_every_word_of_every_document(spark, monkeypatch):
    _, _, m = odd_model(spark)
    texts = [" ".join(f"w{i % 7}" for i in range(n)) for n in (1, 40, 700, 5)]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate([*texts, ""])], "id long, text string, held_out boolean")
    got = sorted(len(r.codes) // 2 for r in recurrent_lm.coded_documents(docs, m).collect())
    assert got == sorted([len(t.split()) + 1 for t in texts] + [1])  # the words and the end
    r, seen = np.random.default_rng(4), []
    plain = recurrent_lm.gradients
    monkeypatch.setattr(recurrent_lm, "STREAMS", 8)
    monkeypatch.setattr(recurrent_lm, "gradients", lambda w, x, y, fresh, h: seen.append((x, y)) or plain(w, x, y, fresh, h))
    codes = [np.r_[14, r.choice(np.delete(np.arange(14), 6), size)] for size in (5, 3000, 1, 700)]
    recurrent_lm.train_shard(small_weights(), codes, 1)
    pairs = lambda x, y: Counter(zip(x.tolist(), y.tolist(), strict=True))
    want = sum((pairs(c[:-1], c[1:]) for c in codes), Counter())
    had = sum((pairs(x.reshape(-1), y.reshape(-1)) for x, y in seen), Counter())
    assert had >= want and len(seen) == math.ceil(3706 / (recurrent_lm.BACK * 8))


def test_several_shards_train(spark, monkeypatch):
    docs, _, m = odd_model(spark)
    coded = recurrent_lm.keep(recurrent_lm.coded_documents(docs, m), "coded")
    monkeypatch.setattr(recurrent_lm, "SHARD_WORDS", 4000)
    monkeypatch.setattr(recurrent_lm, "LEAST", 1)
    out = recurrent_lm.fit(coded.select("id", "codes"), m)
    assert all(np.isfinite(v[v > -1e29]).all() for v in out.weights.values())
    assert any((out.weights[k] != m.weights[k]).any() for k in m.weights)


def test_gradients_against_differences():
    w = small_weights(np.float64)
    r = np.random.default_rng(1)
    real = np.delete(np.arange(14), 6)
    x, y = r.choice(np.append(real, 14), (6, 3)), r.choice(real, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[0] = fresh[3, 1] = True
    h = np.zeros((3, 5))
    grad, _, _ = recurrent_lm.gradients(w, x, y, fresh, h)
    rows, values = grad["embed"]
    grad["embed"] = np.zeros_like(w["embed"])
    grad["embed"][rows] = values
    for name in w:
        for at in list(np.ndindex(w[name].shape))[:: max(1, w[name].size // 23)]:
            kept = w[name][at]
            if kept < -1e29:
                assert grad[name][at] == 0
                continue
            w[name][at] = kept + 1e-5
            up = recurrent_lm.gradients(w, x, y, fresh, h)[2]
            w[name][at] = kept - 1e-5
            down = recurrent_lm.gradients(w, x, y, fresh, h)[2]
            w[name][at] = kept
            assert grad[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


# --- mixing ---------------------------------------------------------------------------------------------------------


def mixing_rows(n=600, seed=3):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        q, t = int(r.random() < 0.6), int(r.random() < 0.2)
        pool = [f"{'good' if q else 'junk'}{k}" for k in range(50)] + [f"bad{k}" for k in range(10)] * (3 * t)
        rows.append((i, " ".join(r.choice(pool) for _ in range(r.randint(20, 90))), "en", "s", 1, "k", "l", "i", "n", 0, 0))
        labels.append((i, q, t))
    return rows, labels


def test_mixing_meets_its_targets(spark):
    rows, labels = mixing_rows()
    table = spark.createDataFrame(labels[::2] + [(None, 1, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    weights = {"low": 0.5, "low_toxic": 0.0, "high": 0.5, "high_toxic": 0.0}
    got = mixing.mix(docs, table, weights).toPandas()
    p = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert p.sum(1) == pytest.approx(np.ones(len(p)))
    true = np.array([2 * q + t for _, q, t in labels])
    assert (p.argmax(1)[got["doc_id"].argsort()] == true).mean() > 0.9
    assert got["rate"].min() >= 0
    reached = (p * (got["n_tokens"] * got["rate"]).to_numpy()[:, None]).sum(0)
    total = got["n_tokens"].sum()
    assert reached[[0, 2]] == pytest.approx([total / 2, total / 2], rel=0.1)
    assert reached[[1, 3]].sum() < 0.1 * total
    assert (np.abs(got["copies"] - got["rate"]) < 1).all()


def test_rates_against_plain_projected_gradient(spark):
    rows, labels = mixing_rows(120, 8)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), table).toPandas()
    p, n = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy(), got["n_tokens"].to_numpy(float)
    scale = (p * n[:, None]).sum(0)
    target = np.array([mixing.WEIGHTS[d] for d in mixing.DOMAINS]) * n.sum()
    rate = np.ones(len(n))
    for _ in range(2000):
        rate = np.maximum(0, rate - p @ (((p * (n * rate)[:, None]).sum(0) - target) / scale))
    loss = lambda r: ((((p * (n * r)[:, None]).sum(0) - target) ** 2) / scale).sum()
    assert loss(got["rate"].to_numpy()) <= loss(rate) + 0.02 * (loss(np.ones(len(n))) - loss(rate))


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_steps_end_at_the_optimum(spark, floor):
    rows, labels = mixing_rows(200, 9)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), table, floor=floor).toPandas()
    p, n, r = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy(), got["n_tokens"].to_numpy(float), got["rate"].to_numpy()
    scale, target = n @ p, np.array([mixing.WEIGHTS[d] for d in mixing.DOMAINS]) * n.sum()
    moved = np.maximum(floor, r - p @ (((n * r) @ p - target) / scale)) - r
    assert np.sqrt(n @ moved**2 / n.sum()) < 1e-3


def test_growth_that_the_shares_need(spark):
    r = np.random.default_rng(2)
    p, n = r.dirichlet([0.1, 0.01, 0.6, 0.01], 1000), r.integers(1, 500, 1000)
    members = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(p, n, strict=True)], "p array<double>, n_tokens long")
    weights = dict(zip(mixing.DOMAINS, [0.3, 0.0, 0.7, 0.0], strict=True))
    pull, _, _, reached = mixing.fit_rates(members, n @ p, weights, None, 1.0)
    _, _, _, fixed = mixing.fit_rates(members, n @ p, weights, 1.0, 1.0)
    of = lambda v: v[[0, 2]] / v[[0, 2]].sum()
    assert of(n @ p)[0] < 0.2 and of(fixed)[0] < 0.29
    assert of(reached) == pytest.approx([0.3, 0.7], abs=0.002)
    rate = mixing.rates(pull, p, 1.0)
    assert rate.min() >= 1 and (n * rate) @ p == pytest.approx(reached)


def test_mixed_documents_repeat_as_copies_say(spark):
    rows, labels = mixing_rows(200)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([*rows, (None, None, *[None] * 9), (7000, "", *[None] * 9)], SCHEMA)
    weights = {"low": 0.3, "low_toxic": 0.0, "high": 0.7, "high_toxic": 0.0}
    want = Counter({r.doc_id: r.copies for r in mixing.mix(docs, table, weights, 1.1, 1.0).collect()})
    out = mixing.mixed_documents(docs, table, weights, 1.1, 1.0)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == want
    assert min(want.values()) >= 1 and max(want.values()) > 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mix(empty_docs(spark), none).count() == 0
    assert mixing.mix(odd_docs(spark), none).count() == len(odd_rows())


def test_mixing_with_any_columns(spark):
    rows, labels = mixing_rows(120)
    table = spark.createDataFrame([(i, q, t, 3, "x") for i, q, t in labels], "doc_id long, quality int, toxic int, id long, text string")
    docs = spark.createDataFrame([(r[0], r[1], 0.5, 1, "q", 2.0) for r in rows], "doc_id long, text string, _chance double, id long, row string, p double")
    weights = {"low": 0.3, "low_toxic": 0.0, "high": 0.7, "high_toxic": 0.0}
    got = mixing.mix(docs, table, weights, None, 1.0).collect()
    out = mixing.mixed_documents(docs, table, weights, None, 1.0)
    assert out.schema == docs.schema
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: r.copies for r in got})
    found = mixing.fit_mixture(docs, table, weights, None, 1.0)
    report = {r.domain: r for r in found.report().collect()}
    assert {d: r.target_tokens for d, r in report.items()} == pytest.approx(dict(zip(mixing.DOMAINS, found.target, strict=True)))
    for i, d in enumerate(mixing.DOMAINS):
        tokens = sum(r[f"p_{d}"] * r.n_tokens * r.rate for r in got)
        assert report[d].reached_tokens == pytest.approx(tokens, rel=1e-6)
        assert got[0][f"reached_{d}"] == pytest.approx(report[d].reached_tokens / found.reached.sum())


def test_features_don_t_depend_on_neighbours():
    texts = [r[1] for r in odd_rows()]
    whole, size = mixing.features(pa.array(texts, pa.string()))
    for i in (0, 1, 7, 9, 12):
        one, n = mixing.features(pa.array([texts[i]], pa.string()))
        assert one[0] == pytest.approx(whole[i], abs=1e-6)
        assert n[0] == size[i]
