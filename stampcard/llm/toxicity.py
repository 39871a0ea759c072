"""Toxic passages as maximum-scoring segments of token log-odds.

Each token's score is its log-odds of occurring in a toxic text. The odds are
smoothed by a chain of Dirichlet priors: a word's prior is its longer prefix's
estimate, that one's is the shorter prefix's, and so on to the overall rate, so
unseen forms of a known stem are scored too. All other tokens cost a little.
A linear scan then finds every maximal scoring segment of a text (Ruzzo and
Tompa). The best segment's score is calibrated by an extreme-value (Gumbel)
distribution, whose place grows with the logarithm of the text's length, fitted
on clean texts; a logistic curve over that significance gives the score.

Training looks at no more than ``ToxicityPlan.sample_rows`` labelled texts (in
expectation; chosen by a hash of the text) and takes one of each group of close
copies, rows of one label whose sets of shingles have the same three minwise
values. A quarter of them calibrates, the rest gives the odds; where that quarter
lacks a toxic row or two clean ones, all of them calibrate. Ids and hashes of the
texts meet the labels and choose the rows; the chosen ids, which the plan bounds,
are broadcast to the texts, so that no text is shuffled.

Defined results: a null or empty text has no passage and the score of such a
text; null labels are not learned from; without a toxic row to learn the odds
from, or with fewer than two clean rows in all, every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import extended, text_key, written
from stampcard.llm.wordhash import groups, mix, not_alphanumeric, shingles_of, words_of

PASSAGE = "array<struct<first_word:int,last_word:int,score:double,p_value:double>>"


@dataclass(frozen=True)
class ToxicityPlan:
    sample_rows: int = 60_000
    #: Lengths of word prefixes in bytes, the finer first.
    prefixes: tuple[int, ...] = (8, 6, 5, 4)
    #: Weight of a prior, in texts.
    prior: float = 4.0
    #: What a token without evidence costs.
    drift: float = 0.8
    #: Passages this unlikely in a clean text are significant.
    p_value: float = 0.05


@dataclass
class ToxicityModel:
    """``keys`` (sorted) and ``odds`` of the features that matter."""

    plan: ToxicityPlan
    keys: np.ndarray
    odds: np.ndarray
    place: tuple[float, float] = (0.0, 0.0)
    scale: float = 1.0
    curve: tuple[float, float] | None = None

    def p_values(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Chance of a segment of this score in a clean text of ``n`` tokens."""
        z = (best - self.place[0] - self.place[1] * np.log(np.maximum(n, 1))) / self.scale
        return -np.expm1(-np.exp(-np.clip(z, -30, 600)))

    def scores(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(best))
        x = significance(self.p_values(best, n))
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * x, -60, 60)))


def significance(p: np.ndarray) -> np.ndarray:
    """Minus log10 of a p-value, levelling off beyond 12."""
    return np.minimum(-np.log10(np.maximum(p, 1e-300)), 12.0)


def _lower(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


def _features(texts: list[bytes], plan: ToxicityPlan):
    """Rows of the tokens, and their keys from the word to the shortest prefix."""
    words = words_of(texts, not_alphanumeric(), None, plan.prefixes)
    chain = [words.hash, *words.prefixes]
    return words.row, [mix(h + np.uint64(i)) for i, h in enumerate(chain)]


def maximal_segments(position: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: (first, last position, score).

    ``position`` and ``score`` are of the tokens above zero; every other token
    scores ``-drift``. Each candidate remembers the sum before it and up to its
    end; a new one is merged with the nearest candidate that starts lower, if
    that one ends lower.
    """
    found: list[list] = []  # first, last, sum before, sum at the end, earlier candidate that starts lower
    total, at = 0.0, 0
    for p, s in zip(position.tolist(), score.tolist()):
        total -= drift * (p - at)
        at = p + 1
        new = [p, p, total, total + s, -1]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def _scan(texts: list[bytes], model: ToxicityModel) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(number of tokens, segments) of each text."""
    row, chain = _features(texts, model.plan)
    counts = np.bincount(row, minlength=len(texts))
    odds = np.zeros(len(row))
    if len(model.keys):
        known = np.zeros(1 << 16, dtype=bool)
        known[(model.keys >> np.uint64(48)).astype(np.int64)] = True
        for keys in reversed(chain):  # a finer feature replaces a coarser one
            hit = np.flatnonzero(known[(keys >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(model.keys, keys[hit]), len(model.keys) - 1)
            same = model.keys[at] == keys[hit]
            odds[hit[same]] = model.odds[at[same]]
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    above = np.flatnonzero(odds > 0)
    cuts = np.searchsorted(row[above], np.arange(len(texts) + 1))
    for r in range(len(texts)):
        part = above[cuts[r] : cuts[r + 1]]
        yield counts[r], maximal_segments(part - begin[r], odds[part], model.plan.drift) if len(part) else []


def _bounded(rows: DataFrame, hash_: Column, plan: ToxicityPlan) -> DataFrame:
    """All rows, or of too many those whose text has a small hash."""
    n = rows.count()
    if n <= plan.sample_rows:
        return rows
    return rows.filter(F.pmod(hash_, F.lit(1_000_003)) < int(1_000_003 * plan.sample_rows / n))


def _labelled(docs: DataFrame, labels: DataFrame, plan: ToxicityPlan) -> DataFrame:
    """``label, text``: the bounded part of ``docs`` joined with ``labels``. Of
    equal texts with one label those of the smallest id stand for all."""
    known = docs.filter(F.col("text").isNotNull()).select("doc_id", *text_key(F.col("text")))
    rows = known.join(_usable(labels).select("doc_id", "label"), "doc_id")
    few = _bounded(written(rows, "toxic-labelled"), F.col("k1"), plan)
    ids = written(few.groupBy("k1", "k2", "label").agg(F.min("doc_id").alias("doc_id")), "toxic-ids")
    texts = docs.select("doc_id", "text", *text_key(F.col("text")))
    return texts.join(F.broadcast(ids), ["doc_id", "k1", "k2"]).select("label", "text")


def _usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("int"))


def _sample(train: DataFrame, plan: ToxicityPlan, labels: DataFrame | None = None) -> DataFrame:
    """``label, text, fold``: a bounded part of the rows, close copies once."""
    if labels is None:
        rows = _usable(train.filter(F.col("text").isNotNull())).select("label", "text")
        rows = _bounded(rows, F.xxhash64("text"), plan)
    else:
        rows = _labelled(train, labels, plan)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for low, high in groups(texts):
                row, shingle = shingles_of(texts[low:high], 5)
                least = np.zeros((3, high - low), dtype=np.uint64)
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if len(row):
                    for i, values in enumerate(least):
                        values[row[begin]] = np.minimum.reduceat(mix(shingle + np.uint64(i)), begin)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(values.view(np.int64)) for values in least], *part.columns], names=[*copies, "label", "text"]
                )

    copies = ["least1", "least2", "least3"]
    marked = written(
        rows.mapInArrow(tokens, ", ".join(f"{c} bigint" for c in copies) + ", label int, text string").select(
            F.monotonically_increasing_id().alias("row"), *copies, *text_key(F.col("text")), "label", "text"
        ),
        "toxic-marked",
    )
    one = marked.groupBy(*copies, "label").agg(F.max(F.struct("k1", "k2", "row")).alias("one"))
    fold = F.pmod(F.xxhash64(*copies), F.lit(4)) == 0
    chosen = written(one.select("one.row", fold.alias("fold")), "toxic-chosen")
    return marked.select("row", "label", "text").join(F.broadcast(chosen), "row").drop("row")


def _odds(sample: DataFrame, plan: ToxicityPlan) -> tuple[np.ndarray, np.ndarray, float]:
    """Keys and log-odds of the features that differ from what they inherit."""
    levels = len(plan.prefixes) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, label = _lower(batch.column("text")), batch.column("label").to_numpy()
            for low, high in groups(texts):
                row, chain = _features(texts[low:high], plan)
                for level, keys in enumerate(chain):
                    order = np.lexsort((row, keys))
                    k, r = keys[order], row[order]
                    new = np.ones(len(k), dtype=bool)
                    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
                    order, k = order[new], k[new]
                    if not len(k):
                        continue
                    begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                    toxic = np.add.reduceat(label[low:high][row[order]].astype(np.int64), begin)
                    all_ = np.diff(np.append(begin, len(k)))
                    above = chain[min(level + 1, levels - 1)][order[begin]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(begin), level, dtype=np.int32)),
                            pa.array(k[begin].view(np.int64)),
                            pa.array(above.view(np.int64)),
                            pa.array(toxic),
                            pa.array(all_.astype(np.int64)),
                        ],
                        names=["level", "key", "above", "toxic", "texts"],
                    )

    schema = "level int, key bigint, above bigint, toxic bigint, texts bigint"
    sums = written(
        sample.filter("not fold")
        .mapInArrow(counted, schema)
        .groupBy("level", "key", "above")
        .agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts")),
        "toxic-counts",
    )
    toxic, rows = sample.filter("not fold").agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    if not toxic or toxic == rows:
        return np.zeros(0, dtype=np.uint64), np.zeros(0), 0.0
    base = toxic / rows
    estimate = lambda prior: (F.col("toxic") + plan.prior * prior) / (F.col("texts") + plan.prior)
    odds_of = lambda p: F.log(p / (1 - p)) - math.log(base / (1 - base))
    coarser, kept = None, []
    for level in range(levels - 1, -1, -1):
        own = sums.filter(F.col("level") == level)
        if coarser is None:
            own = own.withColumn("prior", F.lit(base))
        else:
            own = own.join(coarser.select(F.col("key").alias("above"), F.col("p").alias("prior")), "above")
        coarser = written(own.select("key", "prior", estimate(F.col("prior")).alias("p")), "toxic-odds")
        odds, inherited = odds_of(F.col("p")), odds_of(F.col("prior"))
        matters = (F.greatest(odds, inherited) > plan.drift) & (F.abs(odds - inherited) > 0.2)
        kept.append(coarser.filter(matters).select("key", odds.alias("odds")))
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    table = found.toArrow()
    keys = table["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table["odds"].to_numpy()[order] - plan.drift, base


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton's method with a weak ridge."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.05 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit_toxicity(
    train: DataFrame, plan: ToxicityPlan = ToxicityPlan(), labels: DataFrame | None = None
) -> ToxicityModel:
    """Learn from ``train`` (``text``, ``label`` 0 or 1). With ``labels``
    (``doc_id``, ``label``) ``train`` has ``doc_id`` and ``text``, and is joined."""
    sample = _sample(train, plan, labels)
    keys, odds, base = _odds(sample, plan)
    model = ToxicityModel(plan, keys, odds)
    if not base:
        return model

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _lower(batch.column("text"))
            for low, high in groups(texts):
                rows = [(n, max((s[2] for s in found), default=0.0)) for n, found in _scan(texts[low:high], model)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(r[i]) for r in rows]) for i in (0, 1)]
                    + [batch.column("label").slice(low, high - low)],
                    names=["n", "best", "label"],
                )

    for part in (sample.filter("fold"), sample):
        seen = part.mapInArrow(scanned, "n double, best double, label int").toArrow()
        n, best, label = (seen[c].to_numpy() for c in ("n", "best", "label"))
        clean = label == 0
        if clean.sum() >= 2 and not clean.all():
            break
    else:
        return model
    logs = np.log(np.maximum(n[clean], 1))
    slope = np.cov(logs, best[clean])[0, 1] / max(logs.var(ddof=1), 1e-9)
    slope = float(max(slope, 0.0))
    left = best[clean] - slope * logs
    model.scale = float(max(left.std() * math.sqrt(6) / math.pi, 0.25))
    model.place = (float(left.mean() - 0.5772156649 * model.scale), slope)
    model.curve = _fit_curve(significance(model.p_values(best, n)), label.astype(float))
    return model


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_column: str = "text", keep_text: bool = False
) -> DataFrame:
    """``docs`` without its text, or with it, and with ``score``, and ``passages``:
    all significant segments by word numbers. A text that is kept is still sent
    to the workers once."""
    rest, schema = extended(docs if keep_text else docs.drop(text_column), f"score double, passages {PASSAGE}")
    names = rest.columns
    sent = names if text_column in names else [*names, docs[text_column]]
    at = names.index(text_column) if text_column in names else len(names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = _lower(batch.column(at))
            for low, high in groups(texts):
                part = batch.slice(low, high - low).select(names)
                scans = list(_scan(texts[low:high], model))
                n = np.array([s[0] for s in scans], dtype=float)
                best = np.array([max((x[2] for x in s[1]), default=0.0) for s in scans])
                size = [len(s[1]) for s in scans]
                p = model.p_values(np.array([x[2] for s in scans for x in s[1]]), np.repeat(n, size))
                passages, i = [], 0
                for s in scans:
                    here = zip(s[1], p[i : i + len(s[1])].tolist())
                    i += len(s[1])
                    passages.append(
                        [
                            {"first_word": a, "last_word": b, "score": c, "p_value": q}
                            for (a, b, c), q in here
                            if model.curve is not None and q <= model.plan.p_value
                        ]
                    )
                kind = pa.list_(
                    pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())])
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.scores(best, n)), pa.array(passages, kind)],
                    names=[*names, "score", "passages"],
                )

    return docs.select(*sent).mapInArrow(scored, schema)
