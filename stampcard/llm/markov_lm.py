"""A hidden Markov language model over whole texts.

Tokens are the words of a text, with A to Z in lower case, and one end. A word's
probability in a state is that of its class in the state times its share of the
class. Each word with at least a fixed share of all tokens is a class of its own;
the others are dealt to a fixed number of classes by hash. So the emission table
has a fixed size, however many words a corpus has, and the counts of all words
stay in a table that is joined.

Baum and Welch's counts are taken by every task from its own texts, with scaled
forward and backward passes over many sequences at once, and summed over the
tasks. Training first takes disjoint slices of the texts, one after another, each
moving the counts a step, then all texts together. For these passes a text is cut
into sequences of ``piece`` tokens; where a cut one starts is learned apart. The
score of a text is the exact likelihood of the whole of it, by the scaled forward
recursion.

Words are told apart by 64-bit hashes. Words with a share of 1 in ``known_words``
are looked up in memory (so there are at most that many), all others by a join.

Defined results: a null or empty text is one end; a text without an id is
learned from and not held out; equal rows and rows that repeat an id are scored
each; without texts to learn from, every class has its prior's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stampcard.llm.common import written
from stampcard.llm.wordhash import ascii_fold, groups, white_space, words_of
from stampcard.session import scratch_path

#: Fixed value: what is added to each count.
ADD = 0.1
HELD_OUT = -1
#: Tokens of the sequences that are worked on at once.
TOKENS_AT_ONCE = 250_000


@dataclass(frozen=True)
class MarkovPlan:
    states: int = 8
    #: Words with one in so many of all tokens are looked up in memory.
    known_words: int = 1 << 19
    #: Words with one in so many of all tokens are a class of their own.
    own_classes: int = 1 << 15
    other_classes: int = 1 << 13
    slices: int = 8
    full_rounds: int = 2
    piece: int = 1024
    #: Weight of the overall shares of the classes in a state, in tokens.
    prior: float = 2000.0
    #: Chance to stay in a state before anything is learned.
    stay: float = 0.9
    seed: int = 11


@dataclass
class MarkovModel:
    """``words`` (sorted) with ``counts`` and ``classes``; class 0 is the end.
    ``total`` is the weight of each class; ``share`` of the words dealt by hash
    is relative to it."""

    plan: MarkovPlan
    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    own: int
    total: np.ndarray
    tokens: int
    distinct: int
    texts: int
    entry: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @property
    def weight(self) -> float:
        return self.tokens + ADD * (self.distinct + 1)


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their words: (from, to, text within, hash)."""
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    for low, high in groups(texts):
        found = words_of(texts[low:high], white_space(), ascii_fold())
        yield low, high, found.row, found.hash.view(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` over all of ``text``, as a written table."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, words in _words(batch.column(0)):
                word, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n.astype(np.int64))], names=["word", "n"])

    found = texts.select("text").mapInArrow(counted, "word bigint, n bigint")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")


def _bucket(plan: MarkovPlan) -> Column:
    return F.pmod(F.col("word"), F.lit(plan.other_classes)).cast("int")


def vocabulary(counts: DataFrame, texts: int, plan: MarkovPlan) -> MarkovModel:
    """An untrained model from the word counts. At most ``known_words`` rows and
    ``other_classes`` sums come to the driver."""
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).head()
    tokens, distinct = row.n + texts, row.v + (texts > 0)
    known = counts.filter(F.col("n") * plan.known_words >= tokens).toArrow()
    words, n = known.column("word").to_numpy(), known.column("n").to_numpy()
    order = np.argsort(words)
    words, n = words[order], n[order]
    alone = n * plan.own_classes >= tokens
    own = 1 + int(alone.sum())
    classes = np.where(alone, np.cumsum(alone), own + np.mod(words, plan.other_classes))
    total = np.full(own + plan.other_classes, ADD)
    total[0] += texts
    total[1:own] += n[alone]
    rare = counts.filter(F.col("n") * plan.own_classes < tokens).groupBy(_bucket(plan).alias("b"))
    for b, c, v in rare.agg(F.sum("n"), F.count(F.lit(1))).collect():
        total[own + b] += c + ADD * v
    share = total / total.sum()
    k = plan.states
    rng = np.random.default_rng(plan.seed)
    emit = share[:, None] * np.exp(0.5 * rng.standard_normal((len(share), k)))
    move = np.full((k, k), (1 - plan.stay) / max(k - 1, 1))
    np.fill_diagonal(move, plan.stay if k > 1 else 1.0)
    return MarkovModel(
        plan, words, n, classes, own, total, tokens, distinct, texts, np.full((2, k), 1 / k), move, emit / emit.sum(axis=0)
    )


def encoded(docs: DataFrame, model: MarkovModel, held_out: Column) -> DataFrame:
    """The texts as classes, a written table by slice: ``row, doc_id, slice,
    classes, n_tokens, hits, base, inside`` and, of the words to be joined,
    ``rest`` and ``times``. ``base`` and ``inside`` are log10 sums over the
    words that are known here."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    part = F.when(held_out, F.lit(HELD_OUT)).otherwise(F.pmod(F.xxhash64("doc_id", "text"), F.lit(model.plan.slices)).cast("int"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", part.alias("slice"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {kind}, slice int, classes array<int>, n_tokens bigint, hits bigint, "
        "base double, inside double, rest array<bigint>, times array<int>"
    )
    names = StructType.fromDDL(schema).names

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: MarkovModel = shared.value
        in_base = np.log10((m.counts + ADD) / m.weight)
        in_class = np.where(m.classes < m.own, 0.0, np.log10((m.counts + ADD) / m.total[m.classes]))
        end = m.texts + ADD
        for batch in batches:
            for low, high, row, word in _words(batch.column("text")):
                n = high - low
                at = np.minimum(np.searchsorted(m.words, word), max(len(m.words) - 1, 0))
                there = m.words[at] == word if len(m.words) else np.zeros(len(word), dtype=bool)
                classes = np.empty(len(word) + n, dtype=np.int32)
                ends = np.searchsorted(row, np.arange(n), "right") + np.arange(n)
                inner = np.ones(len(classes), dtype=bool)
                inner[ends] = False
                classes[ends] = 0
                classes[inner] = m.own + np.mod(word, m.plan.other_classes)
                classes[np.flatnonzero(inner)[there]] = m.classes[at[there]]
                seen, of = row[there], at[there]
                sums = [np.bincount(seen, w, n).astype(np.float64) for w in (in_base[of], in_class[of])]
                hits = np.bincount(seen, minlength=n) + (m.texts > 0)
                # The other words, each once per text.
                other_row, other = row[~there], word[~there]
                order = np.lexsort((other, other_row))
                other_row, other = other_row[order], other[order]
                new = np.ones(len(other), dtype=bool)
                new[1:] = (other_row[1:] != other_row[:-1]) | (other[1:] != other[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(other)))
                cut = np.searchsorted(other_row[first], np.arange(n + 1)).astype(np.int32)
                cuts = np.concatenate([[0], ends + 1]).astype(np.int32)
                columns = [
                    *[batch.column(c).slice(low, n) for c in ("row", "doc_id", "slice")],
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(classes)),
                    pa.array(np.diff(cuts).astype(np.int64)),
                    pa.array(hits.astype(np.int64)),
                    pa.array(sums[0] + np.log10(end / m.weight)),
                    pa.array(sums[1]),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(other[first])),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = rows.mapInArrow(coded, schema)
    path = scratch_path(docs.sparkSession, "lm-texts")
    found.write.partitionBy("slice").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of a column of lists, and each list's start and length."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(), at[:-1].astype(np.int64), np.diff(at).astype(np.int64)


def _by_length(length: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Groups of sequences, the longest first, of about ``most`` tokens."""
    order = np.argsort(-length, kind="stable")
    tokens = np.cumsum(length[order])
    begin = 0
    while begin < len(order):
        done = tokens[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(tokens, done + most, "right")))
        yield order[begin:stop]
        begin = stop


def _active(length: np.ndarray) -> np.ndarray:
    """How many of the sequences, the longest first, go on at each step."""
    return np.searchsorted(-length, -np.arange(int(length[0])), "left")


@dataclass
class Counts:
    """Expected counts: how sequences begin (whole or cut ones), which state
    follows which, and which class a state has."""

    entry: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, classes: int, k: int) -> Counts:
        return cls(np.zeros((2, k)), np.zeros((k, k)), np.zeros((classes, k)))

    def rows(self) -> np.ndarray:
        return np.concatenate([self.entry, self.move, self.emit])

    @classmethod
    def of_rows(cls, rows: np.ndarray, k: int) -> Counts:
        return cls(rows[:2], rows[2 : 2 + k], rows[2 + k :])


def expect(out: Counts, model: MarkovModel, values: np.ndarray, start: np.ndarray, length: np.ndarray, cut: np.ndarray) -> None:
    """Add the expected counts of some sequences, the longest first."""
    active = _active(length)
    k = model.plan.states
    alphas, weights, seen = [], [], []
    alpha = None
    for t, n in enumerate(active.tolist()):
        classes = values[start[:n] + t]
        emit = model.emit[classes]
        alpha = (model.entry[cut[:n]] if alpha is None else alpha[:n] @ model.move) * emit
        scale = alpha.sum(axis=1, keepdims=True)
        alpha = alpha / scale
        alphas.append(alpha)
        weights.append(emit / scale)
        seen.append(classes)
    beta = np.ones((int(active[-1]), k))
    back = model.move.T
    move = np.zeros((k, k))
    for t in range(len(active) - 1, -1, -1):
        weighted = weights[t] * beta
        weights[t] = alphas[t] * beta
        if t:
            before = alphas[t - 1]
            move += before[: len(weighted)].T @ weighted
            beta = np.ones((len(before), k))
            beta[: len(weighted)] = weighted @ back
    out.move += move * model.move
    first = weights[0]
    for c in (0, 1):
        out.entry[c] += first[cut == c].sum(axis=0)
    gamma, classes = np.concatenate(weights), np.concatenate(seen)
    for s in range(k):
        out.emit[:, s] += np.bincount(classes, gamma[:, s], len(out.emit))


def _pieces(start: np.ndarray, length: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count = -(-length // piece)
    text = np.repeat(np.arange(len(length)), count)
    skip = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * piece
    return start[text] + skip, np.minimum(length[text] - skip, piece), (skip > 0).astype(np.int64)


def expected_counts(texts: DataFrame, model: MarkovModel) -> Counts:
    """Expected counts over all of ``classes``: each task sums its own, and the
    sums are added by class. What comes to the driver has the model's size."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    k, classes = model.plan.states, len(model.total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: MarkovModel = shared.value
        out = Counts.none(classes, k)
        for batch in batches:
            values, start, length = _sequences(batch.column(0))
            start, length, cut = _pieces(start, length, m.plan.piece)
            for some in _by_length(length, TOKENS_AT_ONCE):
                expect(out, m, values, start[some], length[some], cut[some])
        rows = out.rows()
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *[pa.array(rows[used, s]) for s in range(k)]], names=["at", *names]
        )

    names = [f"s{s}" for s in range(k)]
    found = texts.select("classes").mapInArrow(summed, "at int, " + ", ".join(f"{n} double" for n in names))
    table = found.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    shared.unpersist()
    rows = np.zeros((2 + k + classes, k))
    if table.num_rows:
        rows[table.column("at").to_numpy()] = np.stack([table.column(n).to_numpy() for n in names], axis=1)
    return Counts.of_rows(rows, k)


def improved(model: MarkovModel, counts: Counts) -> MarkovModel:
    """The model that expected counts give, with Dirichlet priors."""
    plan, k = model.plan, model.plan.states
    share = model.total / model.total.sum()
    emit = counts.emit + plan.prior * share[:, None]
    move = counts.move + 1.0 / k
    entry = counts.entry + 1.0 / k
    return replace(
        model,
        emit=emit / emit.sum(axis=0),
        move=move / move.sum(axis=1, keepdims=True),
        entry=entry / entry.sum(axis=1, keepdims=True),
    )


def trained(model: MarkovModel, texts: DataFrame) -> MarkovModel:
    """The model after all rounds over the texts that are not held out."""
    plan = model.plan
    learned = None
    for step in range(plan.slices):
        found = expected_counts(texts.filter(F.col("slice") == step), model).rows() * plan.slices
        rate = 1.0 if learned is None else (step + 1) ** -0.6
        learned = found if learned is None else (1 - rate) * learned + rate * found
        model = improved(model, Counts.of_rows(learned, plan.states))
    for _ in range(plan.full_rounds):
        model = improved(model, expected_counts(texts.filter(F.col("slice") != HELD_OUT), model))
    return model


def likelihoods(model: MarkovModel, values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """log10 likelihood of each whole sequence of classes, the longest first."""
    out = np.zeros(len(length))
    alpha = None
    for t, n in enumerate(_active(length).tolist()):
        alpha = (model.entry[[0] * n] if alpha is None else alpha[:n] @ model.move) * model.emit[values[start[:n] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[:n] += np.log10(scale)
    return out


def _scored(texts: DataFrame, model: MarkovModel) -> DataFrame:
    """``texts`` without their lists, with ``path``, the likelihood of the classes."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kept = ["row", "doc_id", "slice", "n_tokens", "hits", "base", "inside"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, start, length = _sequences(batch.column("classes"))
            path = np.zeros(len(length))
            for some in _by_length(length, 4 * TOKENS_AT_ONCE):
                path[some] = likelihoods(shared.value, values, start[some], length[some])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(path)], names=[*kept, "path"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*kept).schema)
    return texts.select(*kept, "classes").mapInArrow(scored, f"{schema}, path double")


def _rest_sums(texts: DataFrame, counts: DataFrame, model: MarkovModel) -> DataFrame:
    """By text: what the words that are not looked up in memory add."""
    words = texts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x"))
    words = words.select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    spark = texts.sparkSession
    table = [(b, float(t)) for b, t in enumerate(model.total[model.own :])]
    totals = F.broadcast(spark.createDataFrame(table, "bucket int, total double"))
    joined = words.join(counts, "word", "left").withColumn("bucket", _bucket(model.plan)).join(totals, "bucket")
    # One share of a class goes to all words that were not seen.
    n = F.coalesce("n", F.lit(0)) + F.lit(ADD)
    return joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n / F.lit(model.weight))).alias("more_base"),
        F.sum(F.col("times") * F.log10(n / F.col("total"))).alias("more_inside"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0)).alias("more_hits"),
    )


def score_texts(docs: DataFrame, held_out: Column, plan: MarkovPlan = MarkovPlan()) -> DataFrame:
    """Learn from ``docs`` (``doc_id, text``) that are not held out; score all."""
    learned = docs.filter(~held_out)
    counts = word_counts(learned)
    model = vocabulary(counts, learned.count(), plan)
    texts = encoded(docs, model, held_out)
    model = trained(model, texts)
    zero = F.lit(0)
    return (
        _scored(texts, model)
        .join(_rest_sums(texts, counts, model), "row", "left")
        .select(
            "doc_id",
            (F.col("slice") == HELD_OUT).alias("held_out"),
            "n_tokens",
            (F.col("hits") + F.coalesce("more_hits", zero)).cast("bigint").alias("n_known"),
            F.lit(int(model.tokens)).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
            (F.col("path") + F.col("inside") + F.coalesce("more_inside", zero)).alias("score"),
        )
    )
