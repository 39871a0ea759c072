"""Language identification with bit-sliced Bloom filters over character n-grams.

Training finds, per language, the n-grams that a fair part of its texts
contain. They go into one Bloom filter whose slots hold a bit per language: the
AND of an n-gram's slots is the set of all languages that may contain it, found
for all languages at once. To identify a text, every n-gram occurrence is looked
up, bits are counted per language, and the counts are corrected for the rate at
which that language's slice answers falsely. The language with the largest
corrected share wins; the score is its share of the claims of all languages.

Training looks at no more than ``LanguagePlan.sample_rows`` texts per language
in expectation, chosen by a hash of the text. An n-gram counts for a language
where at least ``least_share`` of its sampled texts contain it, so the filter's
size follows from the plan and not from the corpus.

Defined results: a null text, or one without letters, is ``und`` with score 0,
and so is every text when there is nothing to learn from; null languages are
not learned from; ties go to the smaller language name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import extended, written
from stampcard.llm.wordhash import groups, mix

UNKNOWN = "und"
_SLICE = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LanguagePlan:
    lengths: tuple[int, ...] = (1, 2, 3, 4)
    sample_rows: int = 4_000
    least_share: float = 0.02
    hashes: int = 3
    #: Slots per n-gram of the largest language.
    slots: int = 12


@dataclass
class LanguageModel:
    """``table`` has a 64-bit slot per row and slice of 64 languages."""

    plan: LanguagePlan
    names: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    #: Mean corrected share of a language's own texts, to even out filter sizes.
    usual: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Code point of each letter, and 0 for what is no letter."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], dtype=np.uint32)


def _grams(texts: list[bytes], plan: LanguagePlan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of all n-grams of each length; texts are lower-case UTF-8. A
    gap stands for any run of other characters and is part of n-grams, but no
    n-gram is a gap alone and none reaches over a gap to the next word."""
    points = [_letters()[np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)] for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(p) + 2 for p in points])
    gap = np.zeros(1, dtype=np.uint32)
    line = np.concatenate([x for p in points for x in (gap, p, gap)] or [gap[:0]])
    keep = (line != 0) | (np.append(line[1:], 0) != 0) | (np.append(np.uint32(0), line[:-1]) != 0)
    line, row = line[keep], row[keep]
    spread = mix(line.astype(np.uint64) + np.uint64(1))
    acc = np.zeros(len(line), dtype=np.uint64)
    inner = np.zeros(len(line), dtype=bool)  # a gap within, other than at the ends
    for n in range(1, max(plan.lengths) + 1):
        size = len(line) - n + 1
        if size <= 0:
            return
        if n > 2:
            inner = inner[:size] | (line[n - 2 : n - 2 + size] == 0)
        acc = mix(acc[:size] * _STEP + spread[n - 1 : n - 1 + size])
        if n in plan.lengths:
            ok = (row[:size] == row[n - 1 : n - 1 + size]) & ~inner[:size]
            if n == 1:
                ok &= line[:size] != 0
            if n == 2:
                ok &= (line[:size] != 0) | (line[1 : 1 + size] != 0)
            yield row[:size][ok], acc[ok]


def _slots(grams: np.ndarray, hashes: int, size: int) -> Iterator[np.ndarray]:
    for i in range(hashes):
        yield (mix(grams + np.uint64(i + 1)) % np.uint64(size)).astype(np.int64)


def _lower(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


def _answers(grams: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Bits of the languages that may contain each n-gram, by slice."""
    found = np.full((len(grams), model.table.shape[1]), ~np.uint64(0))
    for at in _slots(grams, model.plan.hashes, len(model.table)):
        found &= model.table[at]
    return found


def _claims(texts: list[bytes], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of n-grams, and the corrected count per language."""
    hits = np.zeros((len(texts), len(model.names)))
    total = np.zeros(len(texts))
    for row, grams in _grams(texts, model.plan):
        if not len(row):
            continue
        found = _answers(grams, model)
        cuts = np.searchsorted(row, np.arange(len(texts) + 1))
        total += np.diff(cuts)
        for i in range(len(model.names)):
            bit = ((found[:, i // _SLICE] >> np.uint64(i % _SLICE)) & np.uint64(1)).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(bit)])
            hits[:, i] += np.diff(sums[cuts])
    corrected = np.maximum(hits - total[:, None] * model.false_rate, 0) / (1 - model.false_rate)
    return total, corrected


def fit_languages(train: DataFrame, plan: LanguagePlan = LanguagePlan()) -> LanguageModel:
    """Learn from ``train`` (``text``, ``lang``)."""
    spark = train.sparkSession
    rows = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < (F.lit(float(1 << 40)) * plan.sample_rows / F.col("n"))
    sample = written(rows.join(counts, "lang").filter(part).select("text", "lang"), "lang-sample")

    def contained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _lower(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for low, high in groups(texts):
                names = sorted(set(langs[low:high]))
                place = np.array([names.index(x) for x in langs[low:high]])
                for row, grams in _grams(texts[low:high], plan):
                    order = np.lexsort((row, grams))
                    g, r = grams[order], row[order]
                    new = np.ones(len(g), dtype=bool)
                    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
                    g, lang = g[new], place[r[new]]
                    for i, name in enumerate(names):
                        keys, n = np.unique(g[lang == i], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                            names=["lang", "gram", "n"],
                        )

    sizes = {r.lang: r.n for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return LanguageModel(plan, [], np.zeros((1, 1), dtype=np.uint64), np.zeros(0), np.zeros(0))
    limits = spark.createDataFrame([(n, max(1.0, plan.least_share * sizes[n])) for n in names], "lang string, least double")
    grams = (
        sample.mapInArrow(contained, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .join(limits, "lang")
        .filter("n >= least")
        .select("lang", "gram")
        .toArrow()
    )
    lang = np.searchsorted(np.array(names), np.array(grams["lang"].to_pylist(), dtype=str))
    keys = grams["gram"].to_numpy().view(np.uint64)
    largest = max(1, int(np.bincount(lang, minlength=len(names)).max(initial=0)))
    size = plan.slots * largest
    table = np.zeros((size, math.ceil(len(names) / _SLICE)), dtype=np.uint64)
    filled = np.zeros(len(names))
    for i in range(len(names)):
        for at in _slots(keys[lang == i], plan.hashes, size):
            table[at, i // _SLICE] |= np.uint64(1) << np.uint64(i % _SLICE)
        filled[i] = ((table[:, i // _SLICE] >> np.uint64(i % _SLICE)) & np.uint64(1)).mean()
    model = LanguageModel(plan, names, table, filled**plan.hashes, np.ones(len(names)))
    shared = spark.sparkContext.broadcast(model)

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = _lower(batch.column("text")), batch.column("lang").to_pylist()
            for low, high in groups(texts):
                total, claims = _claims(texts[low:high], shared.value)
                own = claims[np.arange(high - low), [shared.value.names.index(x) for x in langs[low:high]]]
                share = np.where(total > 0, own / np.maximum(total, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[low:high], pa.string()), pa.array(share)], names=["lang", "share"]
                )

    shares = sample.mapInArrow(usual, "lang string, share double").groupBy("lang").agg(F.avg("share").alias("share"))
    for r in shares.collect():
        model.usual[names.index(r.lang)] = max(r.share, 0.05)
    return model


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    text = docs[text_column]
    rest, schema = extended(docs.drop(text_column), "lang_pred string, score double")
    names = rest.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = _lower(batch.column(batch.num_columns - 1))
            for low, high in groups(texts):
                n = high - low
                if model.names:
                    total, claims = _claims(texts[low:high], model)
                    share = claims / np.maximum(total, 1)[:, None] / model.usual
                    best = share.argmax(axis=1)
                    top = share[np.arange(n), best]
                    score = np.where(total > 0, top / np.maximum(share.sum(axis=1), 1e-12), 0.0)
                    pred = [model.names[b] if t else UNKNOWN for b, t in zip(best, total)]
                else:
                    score, pred = np.zeros(n), [UNKNOWN] * n
                part = batch.slice(low, n).select(names)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(np.clip(score, 0.0, 1.0))],
                    names=[*names, "lang_pred", "score"],
                )

    return docs.select(*names, text).mapInArrow(identified, schema)
