"""Toxicity, language and secret scans: held-out accuracy, and odd rows."""

import itertools
import pathlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stampcard.llm.language_id import fit_languages, identify
from stampcard.llm.queries import QUERIES, toxicity_model
from stampcard.llm.secret_scan import SecretPlan, candidates, dictionary, format_labels, score_findings, train_forest
from stampcard.llm.toxicity import ToxicityPlan, _sample, fit_toxicity, maximal_segments, score_toxicity


def crc(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def test_segments_equal_exhaustive_search():
    """All maximal segments: the best one, then those left and right of it."""

    def exhaustive(scores, shift=0):
        best = max(
            ((sum(scores[i:j]), -(j - i), -i, i, j) for i, j in itertools.combinations(range(len(scores) + 1), 2)), default=None
        )
        if not best or best[0] <= 0:
            return []
        i, j = best[3:]
        return [*exhaustive(scores[:i], shift), (i + shift, j - 1 + shift, best[0]), *exhaustive(scores[j:], shift + j)]

    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([-1, -1, -1, 1.5, 2.25, 4.125]) for _ in range(rng.randrange(14))]
        at = [i for i, s in enumerate(scores) if s > 0]
        got = maximal_segments(np.array(at, dtype=int), np.array([scores[i] for i in at]), 1.0)
        assert got == exhaustive(scores)


def toxic_rows(n):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(1, 80))
        label = int(i % 7 == 0)
        if label:
            text[rng.randrange(len(text))] = "vile" + rng.choice("abcdefghijklmnop") + rng.choice("abcdefghijklmnop")
        yield i, " ".join(text), label


def test_toxicity_learns_stems_and_finds_the_passage(spark):
    rows = list(toxic_rows(3000))
    train = spark.createDataFrame(rows, "doc_id bigint, text string, label int").filter("doc_id % 3 > 0").drop("doc_id")
    model = fit_toxicity(train)
    odd = [(-1, None, 0), (-2, "", 0), (-3, "w1 " * 40_000 + "VILEab " + "w2 " * 40_000, 1), (-4, "w3 vilezz w4", 1)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, score int")
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    assert len(got) == len(rows) + len(odd)
    held = [(got[i].score >= 0.5, bool(label)) for i, _, label in rows if i % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert got[-1].score == got[-2].score < 0.5 and got[-1].passages == []
    assert [(p.first_word, p.last_word) for p in got[-4].passages] == [(1, 1)]
    assert got[-4].score >= 0.5


def test_toxicity_without_labels(spark):
    train = spark.createDataFrame([("a b", 0), (None, 1), ("c", None)], "text string, label int")
    docs = spark.createDataFrame([("a", 1)], "text string, doc_id int")
    assert [r.score for r in score_toxicity(docs, fit_toxicity(train)).collect()] == [0.0]
    assert score_toxicity(docs.limit(0), fit_toxicity(train.limit(0))).collect() == []


def test_toxicity_keeps_rows_that_share_a_passage(spark):
    """One passage in all rows, and a frequent line, do not make them copies."""
    shared = "this passage stands in every single row of the table"
    rows = [(f"{shared} {text}", label) for _, text, label in toxic_rows(900)]
    from stampcard.llm.toxicity import ToxicityPlan, _sample

    sample = _sample(spark.createDataFrame(rows * 2, "text string, label int"), ToxicityPlan())
    assert sample.count() > 0.9 * len(set(rows))


def test_toxicity_learns_without_shuffling_texts(spark, tmp_path):
    """What training deals out is small beside the texts, where no label table is broadcast."""
    rng = random.Random(7)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(200)], k=1500)) for _ in range(1500)]
    rows = [(i, t + " vile" * (i % 5 == 0)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def dealt():
        return {p: p.stat().st_size for f in folders for p in pathlib.Path(f).glob("*/shuffle_*.data")}

    key = "spark.sql.autoBroadcastJoinThreshold"
    threshold, before = spark.conf.get(key), dealt()
    spark.conf.set(key, "-1")
    try:
        model = toxicity_model(spark, str(tmp_path))
        moved = sum(size for p, size in dealt().items() if p not in before)
    finally:
        spark.conf.set(key, threshold)
    assert model.curve is not None
    assert 0 < moved < 0.1 * sum(len(t) for t in texts)


def test_toxicity_sample_of_documents_and_labels_equals_that_of_their_join(spark):
    """Above and below the bound; null and repeated ids, null texts, copies with either label, labels that count for nothing."""
    rows = [(i, text) for i, text, _ in toxic_rows(600)]
    rows += [(i + 5000, text) for i, text in rows[:200]] + rows[:50] + [(i, f"other {text}") for i, text in rows[50:100]]
    rows += [(None, "no id"), (9000, None), (9001, ""), (9002, "unlabelled")]
    marks = [(i, int(i % 7 == 0)) for i in range(600)] + [(i + 5000, i % 2) for i in range(200)]
    marks += [(None, 1), (9000, 1), (9001, 0), (3, None), (4, 2), (20, 0), (20, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, label bigint")
    sizes = []
    for plan in (ToxicityPlan(), ToxicityPlan(sample_rows=300)):
        plain = _sample(docs.join(labels, "doc_id"), plan)
        got = _sample(docs, plan, labels)
        assert got.columns == plain.columns == ["label", "text", "fold"]
        assert sorted(got.collect()) == sorted(plain.collect())
        sizes.append(got.count())
    assert 0 < sizes[1] < sizes[0]


def test_toxicity_calibrates_on_all_rows_where_its_quarter_lacks_a_kind(spark):
    rows = [(f"clean words number {i} w{i}", 0) for i in range(40)] + [("vile thing", 1), ("vile vile other", 1), ("so vile", 1)]
    df = spark.createDataFrame(rows, "text string, label int")
    model = fit_toxicity(df)
    assert model.curve is not None
    got = {r.text2: r.score for r in score_toxicity(df.selectExpr("text", "text AS text2"), model).collect()}
    assert min(got[t] for t, y in rows if y) > max(got[t] for t, y in rows if not y)


def test_toxicity_query_scores_everything(spark, sf_dir):
    rows = QUERIES["op10_toxicity"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(held) >= 0.9 * len(held)


def test_language_query_on_held_out_rows(spark, sf_dir):
    rows = QUERIES["op5_language_id"](spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_language_odd_rows(spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("x", None)] * 5, "text string, lang string"
    )
    rows = [(1, "The DOG", "q"), (2, "Die KATZE und", "q"), (3, None, "q"), (4, "12 !?", "q"), (5, "", None), (6, "the " * 90_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, fit_languages(train)).collect()}
    assert {i: x[0] for i, x in got.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en"}
    assert got[3][1] == got[4][1] == 0.0
    assert [r.lang_pred for r in identify(docs.filter("doc_id = 1"), fit_languages(train.limit(0))).collect()] == ["und"]


def test_secret_scan_finds_planted_and_leaves_decoys(spark, sf_dir):
    import re

    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {(r.doc_id, r.begin): (docs[r.doc_id][r.begin : r.begin + r.n_bytes], r.is_secret) for r in QUERIES["op7_secret_scan"](spark, sf_dir).collect()}
    planted = [(i, m.start(1)) for i, t in docs.items() for m in re.finditer(rb'(?:token = "|password=)([0-9a-f]{18,40})', t)]
    assert planted and all(found[p][1] for p in planted)
    decoys = [x for x in found.values() if x[0].isdigit() or b"@" in x[0]]
    assert decoys and not any(secret for _, secret in decoys)


def test_secret_scan_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (None, 'key = "abc123def456ghi789"', "p"), (4, "é password=f00dfeedbeef1234 é", "p"), (5, "z" * 90_000 + "1", "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, path string")
    found = candidates(docs, frozenset())
    got = sorted(((r.doc_id, r.begin, r.value[:20], r.name) for r in found.collect()), key=str)
    assert got == [(4, 12, "f00dfeedbeef1234", "password"), (5, 0, "z" * 20, ""), (None, 7, "abc123def456ghi789", "key")]
    assert train_forest(format_labels(found).withColumn("label", F.lit(None).cast("int"))) is None
    assert {r.is_secret for r in score_findings(found, None).collect()} == {False}
    assert candidates(docs.limit(0), frozenset()).collect() == []


@pytest.mark.parametrize(
    "form, name",
    [
        ('{{"id":7,"token":"{0}","next":{{"api_key":"{1}"}}}}', "token"),
        ("https://h/y?id=7&token={0}&x=1&secret={1}", "token"),
        ("id=1;token={0};n=2,{1}", "token"),
        ("1,2,{0},x,{1}", ""),
        ("postgres://app:{0}@db:5432/x?password={1}", "app"),
        ("日本語token:{0}日本語{1}", "日本語token"),
        ('"keys":["{0}","{1}"]', "keys"),
        ("token={0}=={1}", "token"),
    ],
)
def test_secret_scan_takes_every_value_of_a_word(spark, form, name):
    """Several secrets in one word, against a search for where they were put."""
    rng = random.Random(form)
    texts, planted = [], set()
    for i in range(20):
        values = ["".join(rng.choices("0123456789abcdef", k=rng.randrange(18, 41))) for _ in "ab"]
        glue = rng.choice([" ", ";", "é"])
        texts.append((i, "é " + glue.join([form.format(*values)] * 3), "p"))
        data = texts[-1][1].encode()
        for value in values:
            at = -1
            while (at := data.find(value.encode(), at + 1)) >= 0:
                planted.add((i, at, value))
    rows = candidates(spark.createDataFrame(texts, "doc_id bigint, text string, path string"), frozenset()).collect()
    found = {(r.doc_id, r.begin, r.value): r.name for r in rows}
    assert len(planted) == 120 and planted <= found.keys()
    assert len(rows) == len(found)
    first = {i: min(p for p in planted if p[0] == i) for i, _, _ in texts}
    assert {found[p] for p in first.values()} == {name}


def test_secret_scan_keeps_a_value_of_short_parts(spark):
    docs = spark.createDataFrame([(1, "key=abcd=1234 QWxhZGRpbjpv=", "p")], "doc_id bigint, text string, path string")
    got = sorted((r.begin, r.value, r.name) for r in candidates(docs, frozenset()).collect())
    assert got == [(4, "abcd=1234", "key"), (14, "QWxhZGRpbjpv", "")]


def test_secret_dictionary_counts_all_texts(spark):
    """More texts than a sample would hold; one word just reaches the share, one just misses it."""
    n = 45_000
    row = F.col("id")
    text = F.concat_ws(
        " ",
        F.concat(F.lit("text "), F.translate(row.cast("string"), "0123456789", "abcdefghij")),
        F.when(row < n * 0.02, "Reached reached").otherwise(""),
        F.when(row < n * 0.02 - 1, "missed").otherwise(""),
    )
    assert dictionary(spark.range(n).select(text.alias("text")), SecretPlan()) == {"text", "reached"}
    assert dictionary(spark.range(0).select(text.alias("text")), SecretPlan()) == frozenset()
