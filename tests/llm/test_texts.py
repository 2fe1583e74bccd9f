import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from anemos.llm import jaccard, langid, quality
from anemos.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain_sets(docs):
    out = []
    for text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def plain_components(ids, docs):
    sets, root, lists = plain_sets(docs), {i: i for i in ids}, defaultdict(set)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(sets):
        shared = Counter(j for x in s for j in lists[x])
        for j, n in shared.items():
            if 100 * n >= 75 * len(s | sets[j]):
                a, b = find(ids[k]), find(ids[j])
                root[max(a, b)] = min(a, b)
        for x in s:
            lists[x].add(k)
    return [len(s) for s in sets], [find(i) for i in ids]


def hard_documents():
    """Near copies around the threshold, a group of them in a chain, a passage in many, and odd texts."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    texts = [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four five", "Word " * 3000, "word " * 2000]
    for i in range(70):
        copy = list(base)
        for at in rng.sample(range(120), i % 9):
            copy[at] = word()
        texts.append(" ".join(copy))
    for _ in range(60):
        own = [word() for _ in range(rng.randrange(5, 200))]
        texts.append(" ".join(own[:len(own) // 2] + passage + own[len(own) // 2:]))
    for i in range(15):  # each a step from the one before
        base = base[4:] + [word() for _ in range(4)]
        texts.append("\n".join(base))
    return texts + texts[9:12] + [" ".join(word() for _ in range(3000))] * 2


@pytest.mark.parametrize("tile", [jaccard.TILE, 900])
def test_jaccard(spark, tile, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 0.05)
    texts = hard_documents()
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    ids = [3 * i + 1 for i in order]
    rows = [(i, t, 1, 2) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame([*rows, (None, texts[10], 1, 2)], "doc_id long, text string, id int, component int").repartition(5)
    got = jaccard.similar_documents(df, tile=tile).collect()
    sizes, want = plain_components(ids, texts)
    assert Counter(tuple(r) for r in got if r["doc_id"] is not None) == Counter(zip(ids, sizes, want, strict=True))
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None] and len(got) == len(texts) + 1


def test_jaccard_of_repeated_rows_and_nothing(spark):
    kind = "doc_id long, text string"
    df = spark.createDataFrame([(4, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (9, "x")], kind)
    assert Counter(map(tuple, jaccard.similar_documents(df).collect())) == Counter([(4, 2, 2)] * 2 + [(2, 2, 2), (9, 1, 9)])
    assert jaccard.similar_documents(df.limit(0)).count() == 0


def test_jaccard_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    sizes, want = plain_components([r["doc_id"] for r in docs], [r["text"] for r in docs])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op8_jaccard"](spark, SMALL).collect()}
    assert got == {d["doc_id"]: x for d, x in zip(docs, zip(sizes, want, strict=True), strict=True)}


def test_block_search_equals_brute_force():
    """Random small sets, so that overlaps lie on both sides of the threshold, with long and short lists."""
    rng = np.random.default_rng(0)
    for _ in range(40):
        words = np.unique(rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64))
        sets = [np.sort(rng.choice(words, rng.integers(1, 40), replace=False)) for _ in range(60)]
        ids = rng.permutation(1000)[:60]
        root = {i: i for i in ids}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for i in range(60):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                    a, b = find(ids[i]), find(ids[j])
                    root[max(a, b)] = min(a, b)
        assert jaccard.search_block(ids, sets).tolist() == [find(i) for i in ids]


def test_language(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = QUERIES["op7_language"](spark, MIDDLE).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert np.mean(right) > 0.97


def test_language_of_odd_texts(spark):
    from pyspark.sql import functions as F

    lessons = [("a", "the then that this " * 20), ("b", "der die das und ein " * 20), ("b", None), (None, "the " * 50), ("c", "")]
    odd = [(None, "x"), ("", "x"), ("123 !?", "x"), ("the that " * 50_000, "x"), ("und das die", "x"), ("É", "x")]
    df = spark.createDataFrame(odd, "text string, found string")
    model = langid.fit(spark.createDataFrame(lessons, "lang string, text string"))
    assert model.languages == ["a", "b"]
    got = [r["p"] for r in df.select(langid.predict_with(spark, model)(F.col("text")).alias("p")).collect()]
    assert [r["lang"] for r in got[:5]] == ["und", "und", "und", "a", "b"] and got[5]["lang"] in ("a", "b")
    assert [r["score"] for r in got[:3]] == [0, 0, 0] and not any(r["ambiguous"] for r in got[:5])
    for taught, want in (([], "und"), (lessons[:1], "a")):
        model = langid.fit(spark.createDataFrame(taught, "lang string, text string"))
        got = [r["p"] for r in df.select(langid.predict_with(spark, model)(F.col("text")).alias("p")).collect()]
        assert [r["lang"] for r in got] == ["und"] * 3 + [want] * 3
        assert [r["score"] for r in got[3:]] == [float(want == "a")] * 3


def letters(text):
    """The bytes a language is told from: lower case, other signs than letters a space."""
    data = list((text or "").encode())
    out = []
    for i, b in enumerate(data):
        b = b + 32 if 65 <= b <= 90 else b
        if i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E:
            b += 32
        out.append(b if b >= 128 or chr(b).isalpha() else 32)
    return out


def plain_grams(text):
    """Pairs and triples that hold no two spaces side by side, as hashed numbers."""
    data, out = letters(text), Counter()
    for n, factor in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        for i in range(len(data) - n + 1):
            part = data[i:i + n]
            if (32, 32) not in zip(part, part[1:]):
                code = 0
                for b in part:
                    code = code << 8 | b
                out[(code * factor & 0xFFFFFFFF) >> 16] += 1
    return out


def plain_language(lessons, text):
    """Loss of each language by the definition: classifiers per bit, losses weighted by reliance, summed."""
    languages = sorted({lang for lang, t in lessons if lang and plain_grams(t)})
    shares = []
    for lang in languages:
        counts = sum((plain_grams(t) for own, t in lessons if own == lang), Counter())
        total = sum(counts.values()) + langid.FEATURES / 2
        shares.append([(counts[f] + 0.5) / total for f in range(langid.FEATURES)])
    shares = np.array(shares)
    code = langid.codewords(len(languages))
    found = plain_grams(text)
    n, losses, reliances = sum(found.values()), np.zeros(len(languages)), []
    for bit in code.T:
        one, zero = shares[bit == 1].mean(axis=0), shares[bit == -1].mean(axis=0)
        weights = np.log(one / zero)
        reliances.append(np.sqrt(((one - zero) * weights).sum()))
        margin = sum(weights[f] * k for f, k in found.items()) / np.sqrt(n) if n else 0
        losses += [reliances[-1] * np.log1p(np.exp(-margin * b)) for b in bit]
    losses /= np.mean(reliances)
    best = int(np.argmin(losses))
    return languages[best], 1 / sum(np.exp(losses[best] - x) for x in losses), losses


def test_language_against_a_plain_version(spark):
    """Counts and loss-weighted decoding, with rows repeated, texts of one sign, and a clashing column."""
    from pyspark.sql import functions as F

    lessons = [("a", "the then that this, 12 "), ("a", "with other things"), ("b", "der die das  und ein"), ("b", "der die das  und ein"),
               ("c", "le la les des \u00c9T\u00c9 pr\u00e8s"), ("d", "el los una que, por"), (None, "zzz"), ("d", None), ("b", "")]
    df = spark.createDataFrame([(*x, i, i) for i, x in enumerate(lessons)], "lang string, text string, feature int, n int").repartition(3)
    counted = {(r["lang"], r["feature"]): r["n"] for r in langid.count_grams(df).collect()}
    want = Counter()
    for lang, text in lessons:
        if lang:
            want.update({(lang, f): n for f, n in plain_grams(text).items()})
    assert counted == want
    asked = ["the other", "DER und das", "\u00e9t\u00e9", "que", "x", "a b", "die that"]
    predict = langid.predict_with(spark, langid.fit(df))
    got = spark.createDataFrame([(t,) for t in asked], "text string").select("text", predict(F.col("text")).alias("p")).collect()
    for row in got:
        lang, score, losses = plain_language(lessons, row["text"])
        gap = np.sort(losses)[1] - losses.min()
        assert row["p"]["lang"] == lang and row["p"]["score"] == pytest.approx(score, rel=1e-4)
        assert row["p"]["ambiguous"] == (gap < langid.CLEAR)


def test_codewords():
    for n in range(12):
        code = langid.codewords(n)
        assert len(code) == n and len({tuple(r) for r in code}) == (n if n != 1 else 1)
    assert langid.codewords(40).shape[1] >= 50
    code = langid.codewords(7)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) == 32


def test_quality_gradient():
    """The fit's step follows the likelihood: its result beats nearby parameters."""
    rng = np.random.default_rng(2)
    at = rng.integers(0, 30, 4000)
    bounds = np.arange(0, 4001, 10)
    score = np.add.reduceat(np.linspace(-1, 1, 30)[at], bounds[:-1])
    grades = (score > -1).astype(int) + (score > 1)
    model = quality.fit_ordinal(at, np.ones(4000), bounds, grades)
    found = np.add.reduceat(model.weights[at], bounds[:-1])
    assert np.mean(np.digitize(found, model.thresholds) == grades) > 0.95
    assert (np.diff(model.thresholds) > 0).all()

    def loss(weights, thresholds):
        p = np.concatenate((np.ones((400, 1)), quality.Model(weights, thresholds).tails(
            np.add.reduceat(weights[at], bounds[:-1])), np.zeros((400, 1))), axis=1)
        i = np.arange(400)
        return -np.log(np.maximum(p[i, grades] - p[i, grades + 1], 1e-12)).mean() + quality.PULL / 400 / 2 * (weights**2).sum()

    best = loss(model.weights, model.thresholds)
    for _ in range(20):
        assert loss(model.weights + rng.normal(size=len(model.weights)) * (np.arange(len(model.weights)) < 30) * 0.5, model.thresholds) > best - 1e-3


def test_quality_query(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = QUERIES["op10_quality"](spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    rated = [(labels[r["doc_id"]], r) for r in rows if r["doc_id"] in labels]
    good = [r["selected"] for x, r in rated if x["quality"] == 1 and x["toxic"] == 0]
    poor = [r["selected"] for x, r in rated if x["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.1
    assert all(r["tail_probability"] <= r["expected_grade"] <= 2 for r in rows)


def test_quality_held_out(spark):
    """Fitted on one half of the rated documents, right on the other."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    grades = quality.grades(spark.read.parquet(f"{MIDDLE}/labels.parquet")).cache()
    model = quality.fit(docs, grades.where("doc_id % 2 = 0"))
    got = docs.join(grades, "doc_id").where("doc_id % 2 = 1").select(
        "grade", quality.rate_with(spark, model)("text")["selected"].alias("s")).collect()
    assert np.mean([r["s"] for r in got if r["grade"] == 2]) > 0.97
    assert np.mean([r["s"] for r in got if r["grade"] == 0]) < 0.15


def test_quality_without_ratings(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    for ratings in ([], [(1, 2)], [(1, None), (None, 1)]):
        model = quality.fit(docs, spark.createDataFrame(ratings, "doc_id long, grade int"))
        assert model is None
        got = [r["r"] for r in docs.select(quality.rate_with(spark, model)("text").alias("r")).collect()]
        assert {(r["expected_grade"], r["tail_probability"], r["selected"]) for r in got} == {(None, None, True)}
    model = quality.fit(docs, spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, grade int"))
    got = [r["r"] for r in docs.select(quality.rate_with(spark, model)("text").alias("r")).collect()]
    assert got[1] == got[2] and 0 <= got[0]["tail_probability"] <= 1


def plain_shape(word):
    """Letters, capitals, digits and other signs of a word, runs of one kind shortened."""
    out = []
    for b in word.encode():
        kind = "x" if b >= 128 else "A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 else "0" if 48 <= b <= 57 else chr(b)
        if not out or out[-1] != kind:
            out.append(kind)
    return tuple(out)


def plain_features(text):
    """Counts of (word), (shape) and (repeats the word before)."""
    out, before = Counter(), None
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), word)
        out.update([("word", lower), ("shape", plain_shape(word)), ("same", lower == before)])
        before = lower
    return out


def odd_texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aBc1.-\u00e9") for _ in range(rng.randrange(1, 6)))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    return [None, "", " \t", "one", "One one ONE", *texts, texts[0], "Word 12 " * 100_000]


def test_quality_features_and_scores_against_a_plain_version(spark):
    """Numbers of features differ by hash only: one number per plain feature, with its count over the root of the words."""
    texts = odd_texts()
    df = spark.createDataFrame([(i, i % 3, t, "x") for i, t in enumerate(texts)], "place long, grade int, text string, at string").repartition(4)
    names = {}
    rows = {r["place"]: dict(zip(r["at"], r["value"], strict=True)) for r in quality.rated_features(df).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        plain, n = plain_features(text), len((text or "").split())
        assert len(rows[i]) == len(plain)
        assert sorted(rows[i].values()) == pytest.approx(sorted(c / np.sqrt(n) for c in plain.values()), rel=1e-6)
        for f in plain:  # a plain feature has the same number in every text
            names.setdefault(f, set(rows[i])).intersection_update(rows[i])
    assert all(names.values())
    model = quality.Model(np.random.default_rng(0).normal(size=quality.FEATURES) * 0.1, np.array([-0.5, 0.75]))
    got = df.select("place", quality.rate_with(spark, model)("text").alias("r")).collect()
    for row in got:
        score = sum(model.weights[f] * v for f, v in rows[row["place"]].items())
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert row["r"]["expected_grade"] == pytest.approx(sum(tails), abs=1e-4)
        assert row["r"]["tail_probability"] == pytest.approx(tails[1], abs=1e-4)
        assert row["r"]["selected"] == (row["r"]["tail_probability"] >= quality.KEEP)


def test_quality_fit_of_repeated_rows_and_bounded_features(spark):
    """Rows that repeat change nothing; beyond the bound the rated texts that come first by hash are used."""
    texts = odd_texts()
    rows = [(i, t, i) for i, t in enumerate(texts)]
    kind = "doc_id long, text string, place int"
    rated = spark.createDataFrame([(i, i % 3) for i in range(len(texts))], "doc_id long, grade int")
    one = quality.fit(spark.createDataFrame(rows, kind), rated)
    two = quality.fit(spark.createDataFrame(rows + rows[::2], kind).repartition(3), rated.union(rated))
    # The order of rows is Spark's, so sums differ in the last places.
    assert np.allclose(one.thresholds, two.thresholds, atol=1e-6) and np.allclose(one.weights, two.weights, atol=1e-6)
    df = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(texts)], "place long, grade int, text string")
    sizes = [len(plain_features(t)) for t in texts]
    features = quality.rated_features(df).cache()
    for bound in (-1, 0, sizes[3] + sizes[4], 100, sum(sizes) - 1, sum(sizes)):
        used = sorted(r["place"] for r in quality.bounded(features, bound).select("place").collect())
        want = [i for i in range(len(texts)) if sum(sizes[:i + 1]) <= bound] or [0]
        assert used == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.limit(3).union(spark.createDataFrame(
        [(None, "the that and", None, None, None), (10**6, None, None, None, None), (10**6 + 1, "", "en", "x", 0)], docs.schema))
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "language id", "n-gram jaccard join", "packing"]
    steps = dict(corpus_pipeline.STAGES)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = steps["quality classifier"](spark, docs.union(odd), SMALL).cache()
    assert kept.columns == columns
    clean = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(clean & {r["doc_id"] for r in kept.collect()}) >= 0.97 * len(clean)
    spoken = steps["language id"](spark, kept, SMALL).cache()
    assert spoken.columns == columns and spoken.where("text IS NULL OR text = ''").count() == 0
    assert spoken.count() >= 0.97 * kept.where("length(text) > 20").count()
    single = steps["n-gram jaccard join"](spark, spoken, SMALL).cache()
    rows = spoken.where("doc_id IS NOT NULL").collect()
    _, component = plain_components([r["doc_id"] for r in rows], [r["text"] for r in rows])
    assert sorted(r["doc_id"] for r in single.where("doc_id IS NOT NULL").collect()) == sorted(set(component))
    assert single.columns == columns
    pieces = steps["packing"](spark, single, SMALL)
    assert pieces.select("doc_id").distinct().count() == single.count()
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), SMALL).count() == 0


def test_similar_stage_with_clashing_columns(spark):
    """Columns named like the stage's own, in any case; repeated ids; a null id stays."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a", 1, 5), (2, text, "b", 2, 6), (2, text, "b", 2, 7), (3, "another text of more than five words here", "c", 3, 8),
            (3, "another text of more than five words here", "d", 3, 8), (None, text, "e", 4, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Copy string, first int, _copy int")
    out = corpus_pipeline.one_of_similar(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["Copy"]) for r in out.collect()), key=str) == sorted([(1, "a"), (3, "c"), (None, "e")], key=str)
