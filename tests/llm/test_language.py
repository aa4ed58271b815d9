import random

import pytest
from pyspark.sql import functions as F

from clickloom.llm import language

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, flags string"


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{SF}/documents.parquet"), per_language=120, landmarks=48)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(language.held_out(F.col("doc_id"))).collect()
    assert len(held) > 300 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_edges(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'de'").orderBy("doc_id")
    german = docs.first().text
    rows = [(1, None), (2, ""), (3, "123 !?\n"), (4, german), (4, german), (None, german), (5, german * 1500), (6, "…—")]
    frame = spark.createDataFrame([(i, t, "xx", 1.0, "f") for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.lang_pred) for r in language.identify(frame, model).collect()]
    want = [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "de"), (5, "de"), (6, "und")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = language.in_known_language(frame, model)
    assert kept.columns == frame.columns and kept.count() == 4
    assert language.identify(frame.limit(0), model).count() == 0


def test_without_training_rows(spark):
    frame = spark.createDataFrame([(1, "some text", None, 1.0, "f")], SCHEMA)
    assert language.train(frame) is None
    assert language.identify(frame, None).first().lang_pred == "und"


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))
    other = language.train(docs.withColumn("lang", wrong), per_language=30, landmarks=16)
    same = language.train(docs, per_language=30, landmarks=16)
    assert other.languages == same.languages and (other.coefficients == same.coefficients).all()


def test_presence_of_long_texts():
    text = "abc déf " * 300_000
    assert (language.presence(text) == language.presence(text[:800])).all()
    assert language.presence("12 3") is None and language.presence(None) is None


def test_every_label_is_learned(spark):
    """More labels than rows in all allow at the usual number, each with letters of its own."""
    def text(label, k):
        rng = random.Random(100 * label + k)
        return " ".join(chr(0x4E00 + 20 * label + rng.randrange(20)) * 2 for _ in range(80))

    rows = [(1000 * label + k, text(label, k), f"l{label:03}", 1.0, "f") for label in range(150) for k in range(30 - label // 8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    model = language.train(frame, rows_in_all=600)
    assert model.languages == sorted({r[2] for r in rows}) and len(model.landmarks) >= 150
    found = {r.doc_id: r.lang_pred for r in language.identify(frame, model).collect()}
    assert sum(found[r[0]] == r[2] for r in rows) >= 0.99 * len(rows)


def test_texts_in_no_learned_language_go(spark, model):
    """Clean documents of every length stay; other alphabets and strings of consonants go."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    least = language.least_overlap(docs, model)
    assert 0.3 < least < 0.7
    odd = ["漢字 仮名 交じり 文 " * 20, "привет мир это текст " * 20, "αβγ δε", "xqzk wvvq kqxz zzq " * 20, "12"]
    extra = spark.createDataFrame([(-1 - k, t, "xx") for k, t in enumerate(odd)], docs.schema)
    kept = language.in_known_language(docs.unionByName(extra), model, least)
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() == docs.count()
    assert language.least_overlap(docs.limit(0), model) == 0


def test_overlap_is_the_share_of_common_grams(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(20)
    got = {r.doc_id: r.overlap for r in language.identify(docs, model).collect()}
    marks = [set(i for i, bit in enumerate(m) if bit) for m in language.np.unpackbits(model.landmarks, axis=1)]
    for row in docs.collect():
        own = set(language.np.flatnonzero(language.presence(row.text, model.bits, model.n)))
        assert got[row.doc_id] == pytest.approx(max(len(own & m) / len(own) for m in marks), abs=1e-6)


def test_all_labelled_rows_are_learned_from(spark):
    """More texts of a label than a sample would have: the regression over every row, done at once."""
    rng = random.Random(5)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop"}
    rows = []
    for doc in range(2_000):
        lang = "aa" if doc % 10 else ("bb", "cc")[doc % 20 // 10]
        words = ("".join(rng.choices(letters[lang], k=rng.randrange(2, 5))) for _ in range(8))
        rows.append((doc, " ".join(words) if doc % 97 else "12 3", lang, 1.0, "f"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    model = language.train(frame, landmarks=12)
    held = {r.doc_id for r in frame.where(language.held_out(F.col("doc_id"))).collect()}
    sets = {r[0]: language.presence(r[1]) for r in rows if r[0] not in held}
    used = [r for r in rows if sets.get(r[0]) is not None]
    np, names = language.np, [r[2] for r in used]
    assert names.count("aa") > 1_000
    marks = np.unpackbits(model.landmarks, axis=1)
    values, vectors = np.linalg.eigh(language.kernel(marks, marks).astype(float))
    whiten = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    features = language.kernel(np.stack([sets[r[0]] for r in used]), marks).astype(float) @ whiten
    weight = np.array([1 / names.count(name) for name in names])[:, None]
    wanted = np.array([[1.0 if name == lang else -1.0 for lang in sorted(letters)] for name in names])
    square = features.T @ (features * weight) + language.RIDGE * np.eye(features.shape[1])
    want = whiten @ np.linalg.solve(square, features.T @ (wanted * weight))
    assert model.languages == sorted(letters) and np.allclose(model.coefficients, want, rtol=1e-3, atol=1e-3)


def test_the_least_overlap_is_judged_by_all_held_out_rows(spark):
    """More held-out rows than a sample would have, and values that meet in a cell or do not."""
    np, rng = language.np, random.Random(6)
    rows = []
    for doc in range(40_000):
        words = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 6))) for _ in range(3))
        rows.append((doc, words if doc % 50 else "12", "aa" if doc % 11 else None, 1.0, "f"))
    frame = spark.createDataFrame(rows, SCHEMA)
    model = language.train(frame, per_language=60, landmarks=16)
    held = frame.where(language.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    found = [r.overlap for r in language.identify(held, model).collect() if r.lang_pred != "und"]
    assert len(found) > 11_000
    least = language.least_overlap(frame, model)
    assert least == pytest.approx(0.7 * np.quantile(found, 0.002), abs=1e-12)
    kept = {r.doc_id for r in language.in_known_language(frame, model).collect()}
    assert kept == {r.doc_id for r in language.in_known_language(frame, model, least).collect()}
    for values in ([0.5], [0.1, 0.9], [0.2, 0.2, 0.2001, 0.7], [k / 999 for k in range(1000)]):
        staged = spark.createDataFrame([(v,) for v in values], "overlap double")
        for share in (0.0, 0.002, 0.37, 0.5, 1.0):
            assert language._quantile(staged, share) == pytest.approx(np.quantile(values, share), abs=1e-12)
