"""Piece encoding against the format's own library; the pipeline's stages."""

import random
import time
import tracemalloc

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from stampcard.llm.common import table
from stampcard.llm.piece_encoding import decode, encode, read_model
from stampcard.llm.queries import PIECE_MODEL, QUERIES
from test_minhash_join import brute


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_query_equals_the_library_and_round_trips(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op1_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.piece_ids == library.encode(texts[r.doc_id])
        assert r.same_text and r.n_pieces == len(r.piece_ids)


def test_odd_texts(spark, library):
    rng = random.Random(4)
    parts = ["th", "in", "er", " ", "  ", "▁", "\n", "\t", "日本", "☃", "é", "0", "<s>", "\u0000", "a" * 40, "👍"]
    texts = ["", " ", "x", "▁", None, "no" * 60_000] + ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(400)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, piece_ids string")
    model = read_model(PIECE_MODEL)
    encoded = encode(df, model, verify=True)
    for r in decode(encoded, model).collect():
        text = texts[r.doc_id]
        assert r.piece_ids == (None if text is None else library.encode(text))
        assert r.same_text == (None if text is None else True)
        assert r.decoded == (None if text is None else text.replace("▁", " "))
    assert encode(df.limit(0), model).collect() == []


@pytest.mark.parametrize("parts", [["th", "in", "er", "日", "e", "0", "👍"], ["a"], ["ab", "\n", "é"]])
def test_a_very_long_text_without_blanks(library, parts):
    """Two million characters within a minute, equal to the library."""
    rng = random.Random(len(parts))
    text = "".join(rng.choices(parts, k=2_000_000))[:2_000_000]
    begin = time.perf_counter()
    ids, numbers = read_model(PIECE_MODEL).encoder.encode([text, "short one", text[:70_000]])
    assert time.perf_counter() - begin < 60
    assert ids[: numbers[0]].tolist() == library.encode(text)
    assert ids[numbers[0] :].tolist() == library.encode("short one") + library.encode(text[:70_000])


def test_memory_of_a_batch_is_bounded(library):
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 12))) for _ in range(90_000)]
    encoder = read_model(PIECE_MODEL).encoder
    encoder.encode(["warm up"])
    tracemalloc.start()
    encoder.encode([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)])
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_stages_in_order_and_their_decisions(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "piece_encoding"]
    docs = table(spark, sf_dir, "documents")
    scores = {r.doc_id: r.predicted for r in QUERIES["op10_toxicity"](spark, sf_dir).collect()}
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p}
    kept = stage["near_dedup"](spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (n, c) in brute(rows).items() if i == c or not n)
    mixed = stage["mixing"](spark, docs, sf_dir)
    taken = {r.doc_id: r.taken // r.size for r in QUERIES["op9_mixing"](spark, sf_dir).collect() if r.size}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    bare = {i for i, t in rows if not (t or "").strip(" \t\n\x0b\x0c\r")}
    assert got == {i: n for i, n in taken.items() if n} | dict.fromkeys(bare, 1)


def test_rows_of_one_id_with_different_texts_are_kept(spark):
    text = "a b c d e f g h"
    rows = [(4, text, "s"), (4, "quite another text of this id here", "s"), (9, text.upper(), "s"), (None, text, "s"), (None, "no id and a text of its own", None), (5, None, "s"), (5, " \n", "s"), (4, text, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["near_dedup"](spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(4, text), (4, rows[1][1]), (None, rows[4][1]), (5, None), (5, " \n")], key=str
    )
    clashing = docs.withColumnsRenamed({"n_chars": "times", "lang": "threshold"})
    assert stage["mixing"](spark, clashing, "").columns == clashing.columns
    mixed = stage["mixing"](spark, docs, "").collect()
    assert [r.text for r in mixed if r.doc_id == 5] in ([None, " \n"], [" \n", None])
    sizes = {(i, t): len((t or "").split()) for i, t, _ in rows}
    assert {(r.doc_id, r.text) for r in mixed} <= sizes.keys()


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [
        (1, None, "en", "a", 0, "x"), (2, "", None, None, None, "x"), (None, "some text of a row without id", "en", "a", 9, "x"),
        (4, "one two three four five six", "en", "a", 9, "x"), (4, "one two three four five six", "en", "a", 9, "x"),
        (5, "One two three four five SIX", "en", "b", 9, "x"), (6, "w" * 200_000, "en", "b", 9, "x"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    for name, rows_of in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows_of, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in out} <= {1, 2, None, 4, 6}
        assert not rows_of or {1, 2} <= {r.doc_id for r in out}
        assert bool(out) == bool(rows_of)


def test_toxicity_sends_a_text_once(spark, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id bigint, text string, score string"
    rows = [(1, "a text", "x"), (2, None, None), (None, "", "y")]
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = corpus_pipeline.toxicity(spark, docs, folder)
    node = kept._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "MapInArrow":
        node = node.children().head()
    assert node.child().schema().simpleString().count("string") == 2
    assert kept.dtypes == docs.dtypes
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)


def test_long_texts_reach_a_worker_in_small_batches(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    texts = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("abcdefghij"), 10_000).alias("text"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    texts = table(spark, str(tmp_path), "documents")
    assert max(r.n for r in texts.mapInArrow(sizes, "n bigint").collect()) < 10e6
