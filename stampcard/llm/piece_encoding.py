"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A batch of texts is cut into units, a run of word marks and what follows up to
the next mark; no piece reaches over such a cut (this is checked when a model is
read), so a unit's encoding does not depend on its surroundings and each
distinct unit of a batch is encoded once.

The distinct units are laid out in one line and their suffixes sorted, as deep
as the longest piece. Every piece is looked up in the suffix array by binary
search; its range of suffixes is the places where it occurs. These edges (start,
piece) are put in order of position and relaxed from left to right: the encoding
of a prefix ends with the one piece that fits the last piece of the prefix
before it. Two pieces fit if merging would never join anything over their
border, which is found by undoing their merges in turn. The last pieces give the
encoding backwards. Characters that no piece has become byte pieces. A unit of
any length takes time in proportion to it: a long one is indexed in stretches,
each reaching over the next by the longest piece.

Results equal those of the reference implementation of the format for BPE models
with byte fallback, a leading word mark and no other normalisation; models of
another kind are refused.

Defined results: a null text has null ids, an empty one none; decoding gives the
text back but for a literal word mark (U+2581), which becomes a space; null ids
decode to null; byte pieces that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stampcard.llm.common import extended
from stampcard.llm.wordhash import Stretches, mix

#: Texts are encoded in batches of about so many characters.
BATCH_CHARS = 1_000_000
#: Units longer than this are relaxed one by one, in stretches of a line.
LONG, STRETCH = 4096, 250_000
MARK = 0x2581
#: Places of the cache of fitting pairs; a fixed size.
CACHE = 1 << 21


@dataclass
class PieceModel:
    """Tokens are numbered anew: single characters first, then pieces in the
    order in which they are merged. ``ids`` gives the model's own ids."""

    ids: np.ndarray
    points: list[np.ndarray]
    #: The two tokens of the last merge; a character has itself twice.
    left: np.ndarray
    right: np.ndarray
    #: left * n + right of all pairs that make a piece, sorted, and the piece.
    pair_keys: np.ndarray
    pair_tokens: np.ndarray
    byte_ids: np.ndarray
    #: UTF-8 bytes by the model's own ids; -1 where an id has none.
    surfaces: list[bytes]
    alphabet: np.ndarray = field(init=False)
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.array([len(p) for p in self.points])
        self.alphabet = np.unique(np.concatenate(self.points))

    @cached_property
    def encoder(self) -> Encoder:
        """Built once where the model is used."""
        return Encoder(self)

    @property
    def unknown(self) -> int:
        """Token of a character that no piece has."""
        return len(self.ids)


def _own_merges(symbols: list[int], joined: dict[tuple[int, int], int]) -> tuple[list[int], tuple[int, int]]:
    """Merge the symbols of one piece: what is left, and the last merge."""
    last = (symbols[0], symbols[0])
    while len(symbols) > 1:
        best = min(
            ((joined[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in joined), default=None
        )
        if best is None:
            break
        token, i = best
        last = (symbols[i], symbols[i + 1])
        symbols = [*symbols[:i], token, *symbols[i + 2 :]]
    return symbols, last


def read_model(path: str) -> PieceModel:
    """Read a model file on the driver."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    proto = ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    norm, trainer = proto.normalizer_spec, proto.trainer_spec
    if (
        trainer.model_type != 2
        or not trainer.byte_fallback
        or norm.precompiled_charsmap
        or not norm.add_dummy_prefix
        or norm.remove_extra_whitespaces
        or trainer.treat_whitespace_as_suffix
    ):
        raise ValueError("only BPE models with byte fallback, a leading mark and no normalisation are supported")
    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    plain = [i for i in range(size) if not special[i]]
    for i in plain:
        if chr(MARK) in text[i].lstrip(chr(MARK)):
            raise ValueError("a piece reaches over the end of a word")
    order = sorted(plain, key=lambda i: (len(text[i]) > 1, -model.get_score(i), i))
    token = {text[i]: n for n, i in enumerate(order)}
    joined = {
        (token[p[:k]], token[p[k:]]): n for p, n in token.items() for k in range(1, len(p)) if p[:k] in token and p[k:] in token
    }
    left, right, reachable = [], [], []
    for n, i in enumerate(order):
        symbols = [token.get(c, -1) for c in text[i]]
        found, last = _own_merges(symbols, joined) if -1 not in symbols else ([-1, -1], (n, n))
        reachable.append(found == [n])
        left.append(last[0])
        right.append(last[1])
    keys = np.array([a * len(order) + b for a, b in joined], dtype=np.int64)
    tokens = np.array(list(joined.values()), dtype=np.int64)
    by_key = np.argsort(keys)
    # Pieces that merging never makes keep their number but match nothing.
    points = [
        np.array([ord(c) for c in text[i]], dtype=np.uint32) if ok else np.array([0xFFFFFFFF], dtype=np.uint32)
        for i, ok in zip(order, reachable)
    ]
    surfaces = [
        b"" if special[i] and not model.is_byte(i) else bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(chr(MARK), " ").encode()
        for i, p in enumerate(text)
    ]
    return PieceModel(
        np.array(order, dtype=np.int32),
        points,
        np.array(left),
        np.array(right),
        keys[by_key],
        tokens[by_key],
        np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32),
        surfaces,
    )


class Encoder:
    """Encodes batches of texts with one model."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.depth = int(model.lengths.max())
        self.words = -(-self.depth // 4)
        # Letters are numbered from 1; 0 ends a unit, the last is any other letter.
        self.other = len(model.alphabet) + 1
        if self.other >= 1 << 15:
            raise ValueError("the alphabet has too many characters")
        packed = np.zeros((len(model.points), 4 * self.words), dtype=np.int64)
        for i, p in enumerate(model.points):
            packed[i, : len(p)] = self._letters(p)
        end = np.where(np.arange(packed.shape[1]) < model.lengths[:, None], packed, (1 << 15) - 1)
        matched = np.flatnonzero(packed[:, 0] < self.other)
        self.pieces = matched
        self.low, self.high = self._pack(packed[matched]), self._pack(end[matched])
        self.cache_key = np.full(CACHE, -1, dtype=np.int64)
        self.cache_fits = np.zeros(CACHE, dtype=bool)
        self.known_fits: dict[int, bool] = {}

    def _letters(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.model.alphabet, points), len(self.model.alphabet) - 1)
        found = (self.model.alphabet[at] == points) & (points != 0xFFFFFFFF)
        return np.where(found, at + 1, self.other)

    def _pack(self, letters: np.ndarray) -> np.ndarray:
        """Four letters of 15 bits to a word."""
        four = letters.reshape(len(letters), self.words, 4)
        return (four[:, :, 0] << 45) | (four[:, :, 1] << 30) | (four[:, :, 2] << 15) | four[:, :, 3]

    def _suffixes(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array of a line in which 0 ends each unit, sorted as deep
        as the longest piece, and each suffix's packed first letters. Letters
        behind a unit's end count as 0."""
        n = len(line)
        padded = np.concatenate([line, np.zeros(4 * self.words + 4, dtype=np.int64)])
        ahead = [padded[k : n + k] for k in range(4)]
        first, alive = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for k, letters in enumerate(ahead):
            alive = alive & (letters > 0)
            first |= np.where(alive, letters, 0) << (45 - 15 * k)
        ended = ~alive
        keys = np.zeros((n, self.words), dtype=np.int64)
        keys[:, 0] = first
        for w in range(1, self.words):
            left = max(0, n - 4 * w)
            keys[:left, w] = np.where(self._over(ended, 4 * w)[:left], 0, first[4 * w :])
        # Prefix doubling: in order by one word, then by two, then by four.
        order = np.argsort(first, kind="stable")
        ordered, rank, step = first[order], np.zeros(n, dtype=np.int64), 1
        while step < self.words:
            rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
            both = rank * (n + 1)
            left = max(0, n - 4 * step)
            both[:left] += np.where(self._over(ended, 4 * step)[:left], 0, rank[4 * step :])
            order = np.argsort(both, kind="stable")
            ordered = both[order]
            step *= 2
        return order, keys[order]

    @staticmethod
    def _over(ended: np.ndarray, letters: int) -> np.ndarray:
        """Whether a suffix's unit ends within so many letters; ``ended`` has it
        for four."""
        over = ended.copy()
        for k in range(4, letters, 4):
            over[: max(0, len(over) - k)] |= ended[k:]
        return over

    def _search(self, keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of all pieces at once, word by word of their letters."""
        low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(keys), dtype=np.int64)
        for _ in range(len(keys).bit_length()):
            open_ = low < high
            middle = np.minimum((low + high) // 2, len(keys) - 1)
            there = keys[middle]
            less = np.zeros(len(wanted), dtype=bool)
            same = np.ones(len(wanted), dtype=bool)
            for w in range(self.words):
                less |= same & (there[:, w] < wanted[:, w])
                same &= there[:, w] == wanted[:, w]
            if after:
                less |= same
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    def _fit(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each two tokens stay side by side."""
        m = self.model
        n = len(m.ids)
        out = np.ones(len(first), dtype=bool)
        known = np.flatnonzero((first < n) & (second < n))
        if not len(known):
            return out
        keys = first[known] * n + second[known]
        at = (keys * 0x9E3779B1 >> 7) & (CACHE - 1)
        hit = self.cache_key[at] == keys
        out[known[hit]] = self.cache_fits[at[hit]]
        keys, back = np.unique(keys[~hit], return_inverse=True)
        if len(keys):
            fits = self._undo(keys // n, keys % n)
            at = (keys * 0x9E3779B1 >> 7) & (CACHE - 1)
            self.cache_key[at], self.cache_fits[at] = keys, fits
            out[known[~hit]] = fits[back]
        return out

    def _undo(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Undo the merges of both tokens, the latest first. If at some point
        the tokens at the border make a piece that would have been merged before
        what was undone, they do not stay side by side."""
        m = self.model
        n = len(m.ids)
        result = np.zeros(len(first), dtype=bool)
        open_ = np.arange(len(first))
        a, b, limit = first.copy(), second.copy(), np.full(len(first), np.iinfo(np.int64).max)
        while len(open_):
            keys = a * n + b
            at = np.minimum(np.searchsorted(m.pair_keys, keys), len(m.pair_keys) - 1)
            joined = np.where(m.pair_keys[at] == keys, m.pair_tokens[at], np.iinfo(np.int64).max)
            alive = ~((joined < limit) & (m.pair_keys[at] == keys))
            whole_a, whole_b = m.left[a] == a, m.left[b] == b
            done = alive & whole_a & whole_b
            result[open_[done]] = True
            # The later token is undone first; a character cannot be undone.
            undo_a = (a > b) & ~whole_a | whole_b & ~whole_a
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, m.right[a], a), np.where(undo_a, b, m.left[b])
            go = alive & ~done
            open_, a, b, limit = open_[go], a[go], b[go], limit[go]
        return result

    def _edges(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces occur in a line: (token, start), one for each occurrence."""
        order, keys = self._suffixes(line)
        low, high = self._search(keys, self.low, False), self._search(keys, self.high, True)
        del keys
        count = np.maximum(high - low, 0)
        piece = np.repeat(self.pieces.astype(np.int32), count)
        skip = np.repeat((low - np.concatenate([[0], np.cumsum(count)[:-1]])).astype(np.int32), count)
        skip += np.arange(len(skip), dtype=np.int32)
        place = order.astype(np.int32)[skip]
        other = np.flatnonzero(line == self.other).astype(np.int32)
        return np.concatenate([piece, np.full(len(other), self.model.unknown, dtype=np.int32)]), np.concatenate([place, other])

    def _encode_units(self, line: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the units of a line, and where each begins. Units are in
        order of falling length."""
        token, place = self._edges(line)
        # Edges in order of their place within the unit: all units go on at once.
        # Units are short here, so offsets have 16 bits, which are sorted fast.
        offset = (np.arange(len(line)) - np.repeat(start, length + 1)).astype(np.int16)[place]
        order = np.argsort(offset, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(offset, minlength=int(length[0])))])
        token, place = token[order], place[order]
        del offset, order
        size_of = np.append(self.model.lengths, 1).astype(np.int32)
        last = np.full(len(line) + 1, -1, dtype=np.int32)
        last[start] = -2
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            here, at = token[low:high], place[low:high]
            before = last[at]
            if low:
                open_ = np.flatnonzero(before >= 0)
                here, at, before = here[open_], at[open_], before[open_]
                fits = self._fit(before.astype(np.int64), here.astype(np.int64))
                here, at = here[fits], at[fits]
            last[at + size_of[here]] = here
        # Backwards from each unit's end.
        units, at = np.arange(len(start)), start + length
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(units):
            token = last[at]
            at = at - size_of[token]
            taken.append((token, at))
            go = at > start[units]
            units, at = units[go], at[go]
        token = np.concatenate([x[0] for x in taken])
        begin = np.concatenate([x[1] for x in taken])
        by_place = np.argsort(begin, kind="stable")
        return token[by_place], begin[by_place]

    def _encode_long(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long unit, its edges found and relaxed stretch by
        stretch."""
        size_of = [*self.model.lengths.tolist(), 1]
        last = [-1] * (len(line) + 1)
        last[0] = -2
        for low in range(0, len(line), STRETCH):
            token, place = self._edges(line[low : low + STRETCH + self.depth])
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(min(STRETCH, len(line) - low) + 1)).tolist()
            tokens = token[order[: cuts[-1]]].tolist()
            for at, (first, stop) in enumerate(zip(cuts[:-1], cuts[1:]), low):
                before = last[at]
                if before != -1:
                    for here in tokens[first:stop]:
                        if before == -2 or self._fits(before, here):
                            last[at + size_of[here]] = here
        taken, begin, at = [], [], len(line)
        while at:
            here = last[at]
            at -= size_of[here]
            taken.append(here)
            begin.append(at)
        return np.array(taken[::-1], dtype=np.int32), np.array(begin[::-1], dtype=np.int64)

    def _fits(self, first: int, second: int) -> bool:
        """Whether two tokens stay side by side, see ``_undo``."""
        n = len(self.model.ids)
        if first >= n or second >= n:
            return True
        key = first * n + second
        found = self.known_fits.get(key)
        if found is None:
            if len(self.known_fits) >= CACHE:
                self.known_fits.clear()
            found = self.known_fits[key] = self._stay(first, second)
        return found

    def _stay(self, a: int, b: int) -> bool:
        left, right, pairs = self.halves
        n = len(left)
        limit = n
        while True:
            if pairs.get(a * n + b, n) < limit:
                return False
            whole_a, whole_b = left[a] == a, left[b] == b
            if whole_a and whole_b:
                return True
            if not whole_a and (a > b or whole_b):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    @cached_property
    def halves(self) -> tuple[list[int], list[int], dict[int, int]]:
        m = self.model
        return m.left.tolist(), m.right.tolist(), dict(zip(m.pair_keys.tolist(), m.pair_tokens.tolist()))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        m = self.model
        used = [t for t in texts if t]
        if not used:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        sizes = np.array([len(t) for t in used]) + 1
        raw = np.frombuffer("".join(" " + t for t in used).encode("utf-32-le"), np.uint32)
        points = np.where(raw == 0x20, np.uint32(MARK), raw)
        begin_text = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mark = points == MARK
        starts = mark.copy()
        starts[1:] &= ~mark[:-1]
        starts[begin_text] = True
        start = np.flatnonzero(starts)
        length = np.diff(np.append(start, len(points)))
        # Distinct units by a hash of their characters and length.
        key = self._unit_keys(points, start, length)
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        by_length = np.argsort(-length[first], kind="stable")
        first = first[by_length]
        where = np.empty(len(by_length), dtype=np.int64)
        where[by_length] = np.arange(len(by_length))
        back = where[back]
        size = length[first]
        long = int(np.searchsorted(-size, -LONG, "left"))
        tokens, units, found = [], [], []
        for u in range(long):
            letters = points[start[first[u]] : start[first[u]] + size[u]]
            token, place = self._encode_long(self._letters(letters))
            tokens.append(token)
            units.append(np.full(len(token), u))
            found.append(letters[place])
        if long < len(first):
            token, unit, letters = self._short_units(points, start[first[long:]], size[long:])
            tokens.append(token)
            units.append(unit + long)
            found.append(letters)
        unit = np.concatenate(units)
        ids = np.append(m.ids, np.int32(-1))[np.concatenate(tokens)]
        letters = np.concatenate(found)
        # Unknown characters become the pieces of their bytes.
        bytes_of = np.ones(len(ids), dtype=np.int64)
        unknown = np.flatnonzero(ids < 0)
        spelled = [chr(c).encode("utf-8", "replace") for c in letters[unknown].tolist()]
        bytes_of[unknown] = [len(b) for b in spelled]
        if len(unknown):
            at = np.concatenate([[0], np.cumsum(bytes_of)[:-1]])
            wide = np.repeat(ids, bytes_of)
            for p, b in zip(at[unknown].tolist(), spelled):
                wide[p : p + len(b)] = m.byte_ids[list(b)]
            unit, ids = np.repeat(unit, bytes_of), wide
        per_unit = np.bincount(unit, minlength=len(first))
        unit_at = np.concatenate([[0], np.cumsum(per_unit)[:-1]])
        counts = per_unit[back]
        total = np.concatenate([[0], np.cumsum(counts)])
        out = ids[np.repeat(unit_at[back] - total[:-1], counts) + np.arange(total[-1])]
        text_of = np.searchsorted(start, np.append(begin_text, len(points)))
        each = np.diff(total[text_of])
        numbers = np.zeros(len(texts), dtype=np.int64)
        numbers[[i for i, t in enumerate(texts) if t]] = each
        return out, numbers

    def _short_units(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of units in order of falling length: tokens, their units, and the
        characters they begin with."""
        # All in one line, each followed by a 0.
        line_start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        source = np.repeat(start - line_start, size + 1) + np.arange(int((size + 1).sum()))
        ends = line_start + size
        source[ends] = 0
        letters = points[source]
        del source
        line = self._letters(letters)
        line[ends] = 0
        token, place = self._encode_units(line, line_start, size)
        return token, np.searchsorted(line_start, place, "right") - 1, letters[place]

    @staticmethod
    def _unit_keys(points: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        units = Stretches(mix(points.astype(np.uint64) + np.uint64(1)))
        return mix(units.between(start, start + length) + mix(length.astype(np.uint64)))

    def decode(self, ids: np.ndarray, numbers: np.ndarray) -> list[bytes]:
        """Texts of consecutive runs of ids, as bytes."""
        if not hasattr(self, "surface"):
            self.surface = np.frombuffer(b"".join(self.model.surfaces), np.uint8)
            self.surface_size = np.array([len(s) for s in self.model.surfaces])
            self.surface_at = np.concatenate([[0], np.cumsum(self.surface_size)[:-1]])
        size = self.surface_size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.surface[np.repeat(self.surface_at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        cut = total[np.concatenate([[0], np.cumsum(numbers)])]
        texts = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        return [t[1:] if t[:1] == b" " else t for t in texts]


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or "") + 1
        if size and size + n > BATCH_CHARS:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def encode(docs: DataFrame, model: PieceModel, text_column: str = "text", verify: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids``; with ``verify`` also ``same_text``, whether
    decoding the ids gives the text back (null for a null text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs, schema = extended(docs, f"piece_ids array<int>{', same_text boolean' * verify}")
    names = docs.columns

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            for low, high in _batches(texts):
                ids, numbers = encoder.encode(texts[low:high])
                some = np.array([t is not None for t in texts[low:high]])
                offsets = pa.array(np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32), mask=np.append(~some, False))
                part = batch.slice(low, high - low)
                columns = [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ids))]
                if verify:
                    back = encoder.decode(ids, numbers)
                    same = [
                        None if t is None else t.replace(chr(MARK), " ").encode() == b
                        for t, b in zip(texts[low:high], back)
                    ]
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "piece_ids", *["same_text"] * verify])

    return docs.mapInArrow(encoded, schema)


def decode(docs: DataFrame, model: PieceModel, ids_column: str = "piece_ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs, schema = extended(docs, "decoded string")
    names = docs.columns

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder
        for batch in batches:
            runs = batch.column(ids_column).to_pylist()
            flat = np.array([i for x in runs for i in x or []], dtype=np.int64)
            texts = encoder.decode(flat, np.array([len(x or []) for x in runs], dtype=np.int64))
            out = [None if x is None else t.decode("utf-8", "replace") for x, t in zip(runs, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, "decoded"])

    return docs.mapInArrow(decoded, schema)
