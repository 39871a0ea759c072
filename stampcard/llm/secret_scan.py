"""Secrets in texts: candidates, and a random forest that removes false ones.

Candidates are found generously: words with digits, assigned values, long words
of mixed case. Such a word is cut into all its runs of value characters, and every
run of eight or more is a candidate (a key before "=" only if it has a digit or
mixed case), named after the nearest key before it. Each gets features of its length, its
character transitions, how much of it dictionary words cover, its path, and its
neighbouring words. A random forest trained from labelled findings scores them.

The dictionary holds the words that a fair part of all training texts contain.
Training takes at most ``SecretPlan.sample_rows`` labelled findings in
expectation, chosen by a hash of the finding.

Defined results: a null or empty text has no candidates; null paths and ids are
kept as they are; positions are bytes of the text in UTF-8; equal rows give
equal findings; without both kinds of labels every score is null and nothing is
a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import written
from stampcard.llm.wordhash import groups, white_space, words_of

CREDENTIAL = re.compile(r"pass(word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|credential|private", re.I)
TEST_PATH = re.compile(r"test|example|sample|fixture|mock|doc", re.I)

#: Shortest value.
MIN_VALUE = 8
#: A word's parts: what may be a key or a value, and the signs that matter between.
PARTS = re.compile(rb"""[^=:,;&|?#{}\[\]()<>"'` ]+|[=:,;&|?#{} \[\]]""")
RUN = re.compile(rb"[A-Za-z0-9+/_.@%\-]+")
RUN_WITH_SIGNS = re.compile(rb"[A-Za-z0-9+/=_.@%\-]+")
#: The user part of an address ends at its "@", which is not part of a value.
USER_PART = re.compile(rb"""(://[^/?#@"'<>]*)@""")
OUTER_KEY = re.compile(r"""([^=:,;&|?#{}\[\]()<>"'`]*)["'`\])]*[=:]+$""")

FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "transitions", "entropy", "pairs",
    "covered", "path_length", "path_test", "assigned", "credential", "before_known", "after_known", "quoted",
)


@dataclass(frozen=True)
class SecretPlan:
    sample_rows: int = 20_000
    dictionary_share: float = 0.02
    trees: int = 20
    depth: int = 6
    seed: int = 11
    decision: float = 0.5


def dictionary(texts: DataFrame, plan: SecretPlan) -> frozenset[str]:
    """Words of three letters or more that many of the texts contain, counted
    over all of them. Few come to the driver: a share bounds their number."""
    rows = texts.filter("text IS NOT NULL").select("text")
    least = max(2.0, plan.dictionary_share * rows.count())
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))))
    common = rows.select(words.alias("w")).groupBy("w").count().filter(F.col("count") >= least)
    return frozenset(r.w for r in common.select("w").collect())


def _classes(value: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value)


def _covered(value: str, words: frozenset[str]) -> float:
    """Share of the characters in the longest dictionary words, left to right."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        n = next((n for n in range(min(16, len(low) - at), 2, -1) if low[at : at + n] in words), 0)
        covered += n
        at += n or 1
    return covered / max(1, len(low))


def value_runs(word: bytes, outer: str = "") -> list[tuple[int, int, str]]:
    """``begin, end, name`` of all values in a word without white space. The name
    is the nearest key before "=" or ":", up to the end of its pair or list, and
    ``outer`` before the first key."""
    word = USER_PART.sub(rb"\1 ", word)
    runs: list[tuple[int, int, str]] = []
    last: list[tuple[int, int, str]] = []  # runs of the last part, which may turn out to be a key
    key, name, assigned, named, listed = None, outer, False, False, False
    starts, names, inner = [], [], []
    for part in PARTS.finditer(word):
        text, at = part[0], part.start()
        if text in b"=:":
            if key is not None:
                name, key = key, None
            named = True
            assigned |= text == b"="
        elif text in b",;&|?#{} ":
            assigned, key, listed = False, None, listed and text == b","
            if not listed:
                name, named = "", False
        elif text in b"[]":
            listed = text == b"["
        else:
            is_key = assigned and bool(inner) and not inner[-1] and not names[-1]
            runs += [x for x in last if not is_key or _stands_alone(word[x[0] : x[1]])]
            assigned, key = False, text.strip(b"/").decode("utf-8", "replace")
            last = []
            for run in RUN.finditer(text):
                size = len(run[0].rstrip(b".%"))
                if size >= MIN_VALUE:
                    last.append((at + run.start(), at + run.start() + size, name))
            starts.append(at)
            names.append(name)
            inner.append(named)
    runs += last
    # A value of short parts with "=" between them stays one value.
    for run in RUN_WITH_SIGNS.finditer(word) if b"=" in word else ():
        text, at = run[0].rstrip(b"=.%"), run.start()
        lead = len(text) - len(text.lstrip(b"="))
        here = bisect_right(starts, at + lead) - 1
        if not lead and not (here >= 0 and inner[here]):
            lead = text.find(b"=") + 1
            here = bisect_right(starts, at + lead) - 1
        short = text[lead:].split(b"=")
        if len(short) > 1 and len(text) - lead >= MIN_VALUE and all(len(x.rstrip(b".%")) < MIN_VALUE for x in short):
            runs.append((at + lead, at + len(text), names[here]))
    return sorted(runs)


def _stands_alone(value: bytes) -> bool:
    return any(48 <= c < 58 for c in value) or (len(value) >= 16 and sum(65 <= c < 91 for c in value) >= 3)


def _features(value: str, name: str, before: bool, after: bool, path: str, quoted: bool, words: frozenset[str], pairs: frozenset[str]):
    n = len(value)
    kinds = _classes(value)
    counts = [value.count(c) / n for c in set(value)]
    letters = [value[i : i + 2].lower() for i in range(n - 1) if value[i : i + 2].isalpha()]
    return (
        float(n),
        *(kinds.count(k) / n for k in "dulo"),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        -sum(p * math.log2(p) for p in counts),
        sum(p in pairs for p in letters) / len(letters) if letters else 0.0,
        _covered(value, words),
        float(len(path)),
        float(bool(TEST_PATH.search(path))),
        float(bool(name)),
        float(bool(CREDENTIAL.search(name))),
        float(before),
        float(after),
        float(quoted),
    )


def candidates(docs: DataFrame, words: frozenset[str]) -> DataFrame:
    """``doc_id, path, text`` rows to findings: ``doc_id, path, begin, value,
    name`` and the features."""
    known = docs.sparkSession.sparkContext.broadcast(
        (words, frozenset(w[i : i + 2] for w in words for i in range(len(w) - 1)))
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, pairs = known.value
        known_word = lambda w: w.strip("\"'.,;:!?()").lower() in dictionary
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            paths, ids = batch.column("path").to_pylist(), batch.column("doc_id").to_pylist()
            for low, high in groups(texts):
                part = texts[low:high]
                at = words_of(part, white_space())
                if not len(at.row):
                    continue
                line = np.frombuffer(b"".join(part), np.uint8)
                base = np.concatenate([[0], np.cumsum([len(t) for t in part])[:-1]])[at.row]
                count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[np.stack([at.start + base, at.end + base])], axis=0)[0]  # noqa: E731,B023
                digits, uppers = count((line >= 48) & (line < 58)), count((line >= 65) & (line < 91))
                signs, colons = count(line == 61), count(line == 58)
                size = at.end - at.start
                # A colon at a word's end is punctuation.
                colons = colons - (line[at.end + base - 1] == 58)
                sign_before = np.concatenate([[False], (signs[:-1] > 0) & (size[:-1] == 1)])
                sign_before[1:] &= at.row[1:] == at.row[:-1]
                long = size >= MIN_VALUE
                chosen = (long & ((digits > 0) | (signs > 0) | (colons > 0))) | sign_before | ((size >= 16) & (uppers >= 3))
                rows = []
                for i in np.flatnonzero(chosen).tolist():
                    r = int(at.row[i])
                    text = part[r]
                    word = text[at.start[i] : at.end[i]]
                    near = lambda k: text[at.start[k] : at.end[k]].decode("utf-8", "replace") if 0 <= k < len(at.row) and at.row[k] == r else ""  # noqa: E731,B023
                    before, after = near(i - 1), near(i + 1)
                    outer = ""
                    if sign_before[i]:
                        outer = near(i - 2)
                    elif before.endswith(("=", ":")):
                        outer = OUTER_KEY.search(before)[1]
                    elif word[:1] in (b"=", b":"):
                        outer = before
                    runs = value_runs(word, outer)
                    if not runs:
                        continue
                    path, start = paths[low + r] or "", int(at.start[i])
                    known_before, known_after = known_word(before), known_word(after)
                    for begin, end, name in runs:
                        value = word[begin:end].decode()
                        quoted = begin > 0 and word[begin - 1] in b"\"'([{<"
                        rows.append(
                            (ids[low + r], paths[low + r], start + begin, value, name)
                            + _features(value, name, known_before, known_after, path, quoted, dictionary, pairs)
                        )
                columns = list(zip(*rows)) if rows else [()] * (5 + len(FEATURES))
                kinds = [batch.schema.field("doc_id").type, pa.string(), pa.int64(), pa.string(), pa.string()]
                kinds += [pa.float64()] * len(FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "path", "begin", "value", "name", *FEATURES],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, path string, begin bigint, value string, name string"
    return docs.select("doc_id", "path", "text").mapInArrow(found, schema + "".join(f", {f} double" for f in FEATURES))


def train_forest(findings: DataFrame, plan: SecretPlan = SecretPlan()) -> PipelineModel | None:
    """Fit from ``findings`` with a ``label`` (0 or 1); None if one is missing."""
    rows = findings.filter("label IN (0, 1)")
    n = rows.count()
    if n > plan.sample_rows:
        key = F.xxhash64("value", "name", "begin")
        rows = rows.filter(F.pmod(key, F.lit(1_000_003)) < int(1_000_003 * plan.sample_rows / n))
    # Copies of a text repeat its findings; each is learned from once.
    rest = [c for c in rows.columns if c not in ("value", "name", "label")]
    # The copy with the least hash: the same in every run.
    order = F.struct(F.xxhash64("path", "doc_id", "begin"), "begin")
    one = rows.groupBy("value", "name", "label").agg(F.min_by(F.struct(*rest), order).alias("one"))
    rows = written(one.select("value", "name", "label", "one.*"), "secret-train")
    if rows.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=plan.trees, maxDepth=plan.depth, seed=plan.seed
    )
    ready = assembler.transform(rows.orderBy("value", "name").withColumn("label", F.col("label").cast("double")))
    return PipelineModel(stages=[assembler, forest.fit(ready)])


def score_findings(findings: DataFrame, forest: PipelineModel | None, plan: SecretPlan = SecretPlan()) -> DataFrame:
    """``findings`` with ``score`` and ``is_secret``."""
    if forest is None:
        return findings.withColumn("score", F.lit(None).cast("double")).withColumn("is_secret", F.lit(False))
    scored = forest.transform(findings).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction").withColumn(
        "is_secret", F.col("score") >= plan.decision
    )


def format_labels(findings: DataFrame) -> DataFrame:
    """Findings with a ``label`` where their format leaves no doubt: a known key
    format or a high-entropy value assigned to a credential name is a secret;
    numbers, addresses, and words of the dictionary are not; others are null."""
    value = F.col("value")
    secret = value.rlike(r"^AKIA[0-9A-Z]{16}$") | (
        (F.col("credential") == 1) & (F.length(value) >= 12) & (F.col("entropy") >= 2.5) & (F.col("covered") < 0.5)
    )
    harmless = value.rlike(r"^[0-9.+\-/]+$") | value.rlike(r"^[^@]+@[^@]+\.[a-z]+$") | (F.col("covered") >= 0.6)
    return findings.withColumn("label", F.when(secret, 1).when(harmless, 0).cast("int"))
