"""Near duplicates by a chosen-path set similarity join over minwise tokens.

A text's set is its distinct word shingles; its signature holds the least of
them under many hash functions. In a tree, a node's texts are dealt into
children by the signature value at a coordinate drawn for the node (the root
has one, deeper nodes have 1 / similarity on average). A node is settled

* when all its texts are known to be linked with each other,
* by comparing its texts exhaustively when it is small,
* else by its children; at the last level, or where dealing out no longer makes
  nodes smaller, by comparing it exhaustively in blocks that many tasks share.

In every node each text is first compared with a few pivots of the node. That
links most of a large group of near copies in time linear in its size, and
settles nodes of such copies, so no group is ever expanded into all its pairs.
Deeper levels leave the pivots out once those of a level linked next to nothing:
what is left then are texts that share a passage. The exhaustive comparisons at
the end see all pairs of a node that are not linked, with pivots or without.
Independent trees raise the recall. Signatures, and sketches of more minwise
hashes cut to a byte each, only choose the pairs: a link is confirmed on the
full sets of both texts.

Rows with equal text are one class from the start.

Defined results: a null text, or one without words, has the empty set and is
linked with nothing; a text with fewer words than a shingle has one shingle;
equal ids are one document; a null id never names a component (its component
is null if no row of it has an id) and such a row is kept if its component is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import salted_lookup, text_key, written
from stampcard.llm.components import connected_components
from stampcard.llm.wordhash import groups, mix, shingles_of

#: Ids of rows without an id lie from here on.
NO_ID = 1 << 62


@dataclass(frozen=True)
class JoinPlan:
    width: int = 5
    #: Link where ``100 * intersection >= percent * union``.
    percent: int = 75
    coordinates: int = 32
    #: Bytes of the sketch that chooses pairs.
    sketch: int = 192
    #: Chance for a pair at the threshold to be found in some tree.
    recall: float = 0.99999
    #: Nodes up to this size are compared exhaustively; also the size of blocks.
    leaf: int = 1024
    levels: int = 8
    #: Large nodes are dealt out further while that leaves at most so large a
    #: part of their rows in large nodes; else blocks are cheaper.
    shrink: float = 0.7
    #: Pivots are compared at a level if those of the level before linked at
    #: least so large a part of its rows.
    pivots_pay: float = 0.01
    #: Rows that one task compares, about.
    batch: int = 16_384
    #: Shingles that one task holds when it compares full sets, about.
    batch_shingles: int = 2_000_000

    @property
    def similarity(self) -> float:
        return self.percent / 100

    @property
    def trees(self) -> int:
        """A pair at the threshold stays together with chance s at the root and
        with about s^2 when it has to pass deeper nodes."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity**2))

    @property
    def least_agreement(self) -> int:
        """Equal bytes of two sketches, 4.5 standard deviations below what the
        threshold lets expect."""
        s, n = self.similarity, self.sketch
        return max(1, math.floor(n * s - 4.5 * math.sqrt(n * s * (1 - s))))


#: Orders of the ids by which a node draws its pivots: the least id after
#: exclusive or with each of these.
PIVOT_ORDERS = (0, (1 << 62) - 1, 0x1555555555555555, 0x2AAAAAAAAAAAAAAA)

#: Bits of the filter that keeps rows which are not needed out of a shuffle. Its
#: size is fixed, so it can be broadcast; what it lets through by chance is
#: dropped by the join behind it.
FILTER_BITS = 1 << 22


def _likely_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``c`` is not in ``ids``."""
    slot = F.pmod(F.xxhash64("c"), F.lit(FILTER_BITS)) + 1
    bits = (
        ids.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits"))
    )
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.withColumn("__bucket", F.bitmap_bucket_number(slot))
        .join(F.broadcast(bits), "__bucket")
        .filter(F.getbit(byte, (place % 8).cast("int")) == 1)
        .drop("__bucket", "__bits")
    )


def signatures(docs: DataFrame, plan: JoinPlan) -> DataFrame:
    """``d, k1, k2`` with ``n_shingles``, the signature ``sig`` and the sketch."""
    factors = mix(np.arange(1, plan.coordinates + plan.sketch + 1, dtype=np.uint64)) | np.uint64(1)
    width, coordinates = plan.width, plan.coordinates

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for low, high in groups(texts):
                row, shingle = shingles_of(texts[low:high], width)
                counts = np.bincount(row, minlength=high - low)
                filled = np.flatnonzero(counts)
                begin = np.concatenate([[0], np.cumsum(counts[filled])[:-1]]).astype(np.int64)
                sig = np.empty((len(filled), coordinates), dtype=np.int32)
                sketch = np.zeros((high - low, plan.sketch), dtype=np.uint8)
                for i, factor in enumerate(factors if len(filled) else []):
                    least = np.minimum.reduceat(((shingle * factor) >> np.uint64(32)).astype(np.uint32), begin)
                    if i < coordinates:
                        sig[:, i] = least.view(np.int32)
                    else:
                        sketch[filled, i - coordinates] = least & 0xFF
                offsets = np.concatenate([[0], np.cumsum((counts > 0) * coordinates)]).astype(np.int32)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("d"),
                        part.column("k1"),
                        part.column("k2"),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.ravel())),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    names=["d", "k1", "k2", "n_shingles", "sig", "sketch"],
                )

    schema = "d bigint, k1 bigint, k2 bigint, n_shingles bigint, sig array<int>, sketch binary"
    return docs.mapInArrow(signed, schema)


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _similar_sizes(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Sets whose sizes alone allow the similarity."""
    return 100 * np.minimum(x, y) >= percent * np.maximum(x, y)


class _Search:
    """One join: the texts by id, their classes, and what is linked so far."""

    def __init__(self, texts: DataFrame, classes: DataFrame, plan: JoinPlan) -> None:
        self.texts, self.classes, self.plan = texts, classes, plan
        self.labels: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``label``, the component of ``c`` as known so far."""
        if self.labels is None:
            return rows.withColumn("label", F.col("c"))
        return rows.join(self.labels.withColumnRenamed("id", "c"), "c", "left").withColumn(
            "label", F.coalesce("label", "c")
        )

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` whose sizes and sketches allow a link."""
        plan, least = self.plan, self.plan.least_agreement
        ids = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c")))
        known = _likely_in(self.classes.select("c", "n_shingles", "sketch"), ids)
        side = lambda x: known.select(
            F.col("c").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")
        )

        def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    same = (_sketches(batch.column("sketch_a")) == _sketches(batch.column("sketch_b"))).sum(axis=1)
                    fits = _similar_sizes(*(batch.column(n).to_numpy() for n in ("n_a", "n_b")), plan.percent)
                    yield batch.select(["a", "b"]).filter(pa.array((same >= least) & fits))

        both = pairs.join(side("b"), "b").join(side("a"), "a")
        return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(filtered, "a bigint, b bigint")

    def confirm(self, pairs: DataFrame) -> int:
        """Check pairs on the full sets, keep the links, and bring the
        components up to date. Returns the number of links."""
        pairs = written(pairs.distinct(), "join-pairs")
        needed = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
        texts = written(self.needed_texts(needed), "join-texts")
        both = pairs.join(texts.select(F.col("c").alias("b"), F.col("text").alias("text_b")), "b").join(
            texts.select(F.col("c").alias("a"), F.col("text").alias("text_a")), "a"
        )
        plan = self.plan

        def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left, right = (batch.column(n).cast(pa.binary()).to_pylist() for n in ("text_a", "text_b"))
                known: dict[bytes, int] = {}
                for low, high in groups([x + y for x, y in zip(left, right)]):
                    known.clear()
                    places = [
                        (known.setdefault(x, len(known)), known.setdefault(y, len(known)))
                        for x, y in zip(left[low:high], right[low:high])
                    ]
                    row, shingle = shingles_of(list(known), plan.width)
                    sets = np.split(shingle, np.cumsum(np.bincount(row, minlength=len(known)))[:-1])
                    keep = []
                    for x, y in places:
                        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                        keep.append(100 * common >= plan.percent * (len(sets[x]) + len(sets[y]) - common))
                    part = batch.slice(low, high - low).select(["a", "b"])
                    yield part.filter(pa.array(keep))

        found = written(both.select("a", "b", "text_a", "text_b").mapInArrow(linked, "a bigint, b bigint"), "join-links")
        return self.link(found)

    def compare(self, rows: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Compare all texts within the nodes of ``rows`` (``node, c, n``) that
        are not in one component. A node larger than a leaf is cut into blocks,
        and each two of its blocks meet in one group.

        Without ``sets``: the texts ``c`` that look like some other one. With
        the full sets of these (``c, set``): links ``a, b`` that join all
        components of a group that any of its links joins.
        """
        plan, exact = self.plan, sets is not None
        if exact:
            rows = written(rows.join(sets.select("c"), "c", "left_semi"), "join-near")
        blocks = F.ceil(F.col("n") / plan.leaf).cast("int")
        block = F.pmod(F.xxhash64("c"), blocks).cast("int")
        met = F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda i: F.struct(F.least(block, i).alias("x"), F.greatest(block, i).alias("y")),
        )
        known = _likely_in(self.classes.select("c", "n_shingles", "sketch"), rows.select("c"))
        held = rows.withColumn("times", blocks.cast("bigint"))
        if exact:
            known = known.join(sets, "c")
            held = held.join(self.classes.select("c", "n_shingles"), "c").withColumn(
                "held", F.col("times") * F.col("n_shingles")
            )
        else:
            held = held.withColumn("held", F.lit(0).cast("bigint"))
        size = held.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in ("times", "held")]).first()
        tasks = max(1, math.ceil(max(size[0] / plan.batch, size[1] / plan.batch_shingles)))
        # Joined before the rows are dealt to the meetings of their blocks.
        dealt = (
            self.labelled(rows)
            .join(known, "c")
            .select("*", block.alias("block"), F.explode(met).alias("at"))
            .select(
                F.pmod(F.xxhash64("node", "at"), F.lit(tasks)).alias("task"),
                *("node", "at.x", "at.y", "block", "c", "label", "n_shingles", "sketch"),
                *["set"] * exact,
            )
        )
        least = plan.least_agreement

        def compared(table: pa.Table) -> pa.Table:
            node, x, y, block, c, label, size = (
                table[n].to_numpy() for n in ("node", "x", "y", "block", "c", "label", "n_shingles")
            )
            sketch = _sketches(table["sketch"])
            if exact:
                sets_here = table["set"].combine_chunks()
                members = sets_here.flatten().to_numpy().view(np.uint64)
                size = sets_here.value_lengths().to_numpy().astype(np.int64)
                start = np.concatenate([[0], np.cumsum(size)])
            order = np.lexsort((c, y, x, node))
            same_group = np.ones(len(order), dtype=bool)
            for column in (node, x, y):
                same_group[1:] &= column[order[1:]] == column[order[:-1]]
            joined: dict[int, int] = {}

            def root(name: int) -> int:
                while name in joined:
                    name = joined[name]
                return name

            alike = np.zeros(len(c), dtype=bool)
            links: list[tuple[int, int]] = []
            for group in np.split(order, np.flatnonzero(~same_group)):
                first = group[block[group] == x[group[0]]]
                second = group[block[group] == y[group[0]]]
                for place, i in enumerate(first):
                    others = second[place + 1 :] if x[i] == y[i] else second
                    others = others[(label[others] != label[i]) & _similar_sizes(size[others], size[i], plan.percent)]
                    if not len(others):
                        continue
                    others = others[(sketch[others] == sketch[i]).sum(axis=1) >= least]
                    if not exact:
                        alike[others] = True
                        alike[i] |= len(others) > 0
                    elif len(others):
                        own, n = members[start[i] : start[i + 1]], size[others]
                        ahead = np.concatenate([[0], np.cumsum(n)[:-1]])
                        values = members[np.repeat(start[others] - ahead, n) + np.arange(n.sum())]
                        at = np.minimum(np.searchsorted(own, values), len(own) - 1)
                        common = np.add.reduceat((own[at] == values).astype(np.int64), ahead)
                        for k in others[100 * common >= plan.percent * (n + len(own) - common)].tolist():
                            r, q = root(label[i]), root(label[k])
                            if r != q:
                                joined[max(r, q)] = min(r, q)
                                links.append((min(c[i], c[k]), max(c[i], c[k])))
            if exact:
                return pa.table({n: pa.array([p[j] for p in links], pa.int64()) for j, n in enumerate("ab")})
            return pa.table({"c": np.unique(c[alike])})

        return dealt.groupBy("task").applyInArrow(compared, "a bigint, b bigint" if exact else "c bigint")

    def full_sets(self, ids: DataFrame) -> DataFrame:
        """``c, set``: the sorted shingle hashes of texts."""
        width = self.plan.width

        def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                for low, high in groups(texts):
                    row, shingle = shingles_of(texts[low:high], width)
                    counts = np.bincount(row, minlength=high - low)
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingle.view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("c").slice(low, high - low), sets], names=["c", "set"]
                    )

        texts = self.needed_texts(ids).select("c", "text")
        return written(texts.mapInArrow(shingled, "c bigint, set array<bigint>"), "join-sets")

    def needed_texts(self, ids: DataFrame) -> DataFrame:
        """One text per id and key. Not a semi join: that would be moved before
        the filter."""
        return (
            _likely_in(self.texts, ids)
            .join(ids, "c")
            .groupBy("c", "k1", "k2")
            .agg(F.first("text").alias("text"))
        )

    def link(self, found: DataFrame) -> int:
        """Take in confirmed links, bring the components up to date if there are
        any, and return their number."""
        links = found.count()
        if not links:
            return 0
        known = found.select("a", "b")
        if self.labels is not None:
            before = self.labels.select(F.col("id").alias("a"), F.col("label").alias("b"))
            known = known.unionByName(before.filter("a != b"))
        self.labels = connected_components(known)
        return links

    def still_mixed(self, rows: DataFrame) -> DataFrame:
        """Rows of the nodes whose texts are not all in one component."""
        named = written(self.labelled(rows), "join-named")
        mixed = (
            named.groupBy("node")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low != high")
            .select("node")
        )
        return named.join(written(mixed, "join-mixed"), "node", "left_semi").select("node", "c", "n")

    def compare_pivots(self, live: DataFrame) -> int:
        """Compare the texts of ``live`` (``c``) with the ``pivots`` of their
        nodes. Returns the number of links found."""
        star = live.select("c", F.explode("pivots").alias("p")).filter("c != p")
        star = star.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
        if self.labels is not None:
            for side in ("a", "b"):
                named = self.labelled(star.withColumnRenamed(side, "c"))
                star = named.withColumnsRenamed({"c": side, "label": f"label_{side}"})
            star = star.filter("label_a != label_b").select("a", "b")
        return self.confirm(self.alike(written(star, "join-star")))

    def run(self) -> None:
        plan = self.plan
        sig = F.col("sig")
        # Coordinates of the roots differ as long as there are enough of them.
        roots = [
            F.xxhash64(F.lit(t), F.element_at(sig, t % plan.coordinates + 1)) for t in range(plan.trees)
        ]
        rows = self.classes.select("c", F.explode(F.array(*roots)).alias("node"))
        small: list[DataFrame] = []
        before, pay = None, True
        for level in range(1, plan.levels + 1):
            pivots = F.array(*[F.min(F.col("c").bitwiseXOR(F.lit(o))).bitwiseXOR(F.lit(o)) for o in PIVOT_ORDERS])
            sizes = [F.count(F.lit(1)).alias("n"), *[pivots.alias("pivots")] * pay]
            nodes = written(rows.groupBy("node").agg(*sizes).filter("n > 1"), "join-nodes")
            live = written(rows.join(nodes, "node").select("node", "c", *nodes.columns[1:]), f"join-level{level}")
            unsettled = live.select("node", "c", "n")
            if pay:
                pay = self.compare_pivots(live) >= plan.pivots_pay * live.count()
                # Both texts of a node of two have been compared.
                unsettled = unsettled.filter("n > 2")
            open_rows = written(self.still_mixed(unsettled), f"join-open{level}")
            large = open_rows.filter(F.col("n") > plan.leaf)
            left = large.count()
            last = level == plan.levels or not left or (before is not None and left > plan.shrink * before)
            leaf = open_rows if last else open_rows.filter(F.col("n") <= plan.leaf)
            small.append(leaf.select("node", "c", "n"))
            if last:
                break
            before = left
            # A node draws one coordinate, and a second one for part of the nodes.
            draw = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(plan.coordinates)).cast("int") + 1
            child = lambda k: F.xxhash64("node", draw(k), F.element_at(sig, draw(k)))
            extra = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(1000)) < int(1000 * (1 / plan.similarity - 1))
            children = F.when(extra, F.array(child(1), child(2))).otherwise(F.array(child(1)))
            dealt = large.join(_likely_in(self.classes.select("c", "sig"), large.select("c")), "c").select(
                "c", F.explode(children).alias("child")
            )
            # Read twice by the next level: dealt once.
            rows = written(dealt.select("c", F.col("child").alias("node")), "join-dealt")
        rows = written(reduce(DataFrame.unionByName, small), "join-leaves")
        alike = written(self.compare(rows).distinct(), "join-alike")
        self.link(written(self.compare(rows, self.full_sets(alike)), "join-exact"))


def _several_texts(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``d, k1, k2`` of the rows with an id and words, and the ids ``d`` that have
    more than one text."""
    texts = signed.filter("d IS NOT NULL AND n_shingles > 0").select("d", "k1", "k2")
    ends = texts.groupBy("d").agg(F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high"))
    return texts, ends.filter("low != high").select("d")


def _shared_ids(texts: DataFrame, several: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between the classes of ids that have several texts."""
    mixed = texts.join(several, "d").distinct()
    named = salted_lookup(mixed, classes.select("k1", "k2", "c"), ["k1", "k2"], ["d"]).select("d", "c").distinct()
    least = named.groupBy("d").agg(F.min("c").alias("a"))
    return named.join(least, "d").filter("a != c").select("a", F.col("c").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    plan: JoinPlan = JoinPlan(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    key = text_key(F.col(text_column))
    rows = docs.select(F.col(id_column).cast("bigint").alias("d"), *key, F.col(text_column).alias("text"))
    own_id = F.coalesce("d", F.lit(NO_ID) + F.shiftrightunsigned("k1", 3))
    signed = written(signatures(rows, plan), "join-signatures")
    classes = written(
        signed.filter("n_shingles > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min(own_id).alias("c"),
            *[F.first(n).alias(n) for n in ("n_shingles", "sig", "sketch")],
        ),
        "join-classes",
    )
    search = _Search(rows.select(own_id.alias("c"), "k1", "k2", "text"), classes, plan)
    search.run()
    texts, several = _several_texts(signed)
    if several.count():
        search.link(written(_shared_ids(texts, several, classes), "join-shared"))
    facts = search.labelled(classes.select("c", "k1", "k2")).select("k1", "k2", "label")
    out = salted_lookup(signed.select("d", "k1", "k2", "n_shingles"), written(facts, "join-facts"), ["k1", "k2"], ["d"])
    component = F.when(F.col("n_shingles") == 0, F.col("d")).otherwise(
        F.when(F.col("label") < NO_ID, F.col("label"))
    )
    return out.select(F.col("d").alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )
