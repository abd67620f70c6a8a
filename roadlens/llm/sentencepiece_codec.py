"""SentencePiece ids by streaming Viterbi, and back.

The lattice has a boundary after every character and an edge for every piece. In a BPE model an edge survives at a
boundary only if it is compatible with the surviving piece before it, that is if BPE leaves the two side by side when
it is given their text alone; then each boundary keeps one backpointer, and the path through them is the segmentation
that merging by priority gives. (Summing the scores of such a model, as in a unigram lattice, does not give its ids:
its scores are merge priorities.) Only boundaries within the longest piece can start a further edge, so a window of that
length is kept.

Ids are committed whenever all surviving paths meet in one boundary. Where no edge of the window runs over a boundary, they
do: a running maximum of where the edges from each boundary end tells all such boundaries of a text at once. From each of
them a path goes on by itself, so that many are extended at a time, by one boundary in each step, as arrays. Where paths
do not meet so for long, one path goes on alone and commits when its backpointers meet. A text is read in pieces of SLICE
characters; what is not committed is carried into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import spread

SPACE = "▁"
#: Characters whose lattice is held at a time.
SLICE = 1 << 17
#: Paths that are longer between two meetings are followed one by one.
LONG = 128
#: Pairs of pieces that a worker remembers.
PAIRS = 1 << 20
NEVER = np.iinfo(np.int32).max


class Table:
    """Numbers from 0 on to numbers, for arrays of keys at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask, self.missing = np.uint64(64 - bits), (1 << bits) - 1, missing
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, missing, np.int32)
        slot = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], self.missing)
        rest = np.flatnonzero((there != keys) & (there != -1))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            there = self.keys[slot[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (there != -1)]
        return out


class Codec:
    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=model)
        n = self.wide = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        self.bytes_ = {i: int(self.pieces[i][3:5], 16) for i in range(n) if p.is_byte(i)}
        self.byte_ids = {v: k for k, v in self.bytes_.items()}
        odd = lambda i: p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)
        self.ids = {self.pieces[i]: i for i in range(n) if not odd(i)}
        self.score = {self.pieces[i]: p.get_score(i) for i in range(n) if not odd(i)}
        self.longest = max(map(len, self.ids))
        self.unknown = p.unk_id()
        for probe in ("", " a  b", "the of\tand", "éè x12\n\n"):
            if p.encode(probe) != self.encode_plain(probe):
                raise ValueError("only BPE models without normalisation, with a leading space mark, are read")
        if any(c not in self.ids for x in self.ids for c in x):
            raise ValueError("only models that hold every character of their pieces are read")
        # an ASCII byte is a character by itself; other bytes have to be put together
        self.shown = [chr(self.bytes_[i]) if self.bytes_.get(i, 128) < 128 else x for i, x in enumerate(self.pieces)]
        self.partial = np.array([self.bytes_.get(i, 0) >= 128 for i in range(n)])
        self.commits = 0
        self._read_merges()
        self._read_edges()

    # BPE by its definition; only ever applied to single pieces, and to whole texts in tests.
    def merge(self, text: str, down_to: int = 1) -> list[str]:
        get, none = self.score.get, -np.inf
        parts = list(text)
        gains = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while len(parts) > down_to and (best := max(gains)) != none:
            k = gains.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del gains[k]
            if k:
                gains[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(gains):
                gains[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def encode_plain(self, text: str) -> list[int]:
        return [i for x in self.merge(SPACE + text.replace(" ", SPACE)) for i in self.ids_of(x)] if text else []

    def ids_of(self, piece: str) -> tuple[int, ...]:
        if piece in self.ids:
            return (self.ids[piece],)
        return tuple(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")) if self.byte_ids else (self.unknown,)

    def _read_merges(self) -> None:
        """When each piece is made (rank; a character is there from the start, -1) and of which two pieces, last of all."""
        order = {s: k for k, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank, self.left, self.right = np.full(self.wide, -1), np.full(self.wide, -1), np.full(self.wide, -1)
        self.made = np.zeros(self.wide, bool)  # merging gives the piece as a whole
        for x, i in self.ids.items():
            two = self.merge(x, 2) if len(x) > 1 else []
            self.made[i] = len(x) == 1 or len(two) == 2
            if len(two) == 2:
                self.rank[i], self.left[i], self.right[i] = order[self.score[x]], self.ids[two[0]], self.ids[two[1]]
        # a piece made of two that come after it: pairs with such a piece, at any depth, are told by merging them
        self.twisted = np.zeros(self.wide, bool)
        for i in sorted(np.flatnonzero(self.left >= 0).tolist(), key=lambda i: len(self.pieces[i])):
            two = [self.left[i], self.right[i]]
            self.twisted[i] = self.twisted[two].any() or (self.rank[two] >= self.rank[i]).any()
        joins = [(self.ids[x[:k]] * self.wide + self.ids[x[k:]], order[self.score[x]]) for x in self.ids for k in range(1, len(x)) if x[:k] in self.ids and x[k:] in self.ids]
        self.joined = Table(*np.array(joins or np.zeros((0, 2)), np.int64).T, NEVER)
        self.pair, self.pair_fits = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)

    def _read_edges(self) -> None:
        """The tree of the pieces' beginnings: a table of steps, and the piece that each node stands for, -1 for none."""
        letters = sorted({c for x in self.ids for c in x})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.many, nodes, steps = len(letters) + 1, {"": 0}, []
        for x in self.ids:
            for k in range(1, len(x) + 1):
                if x[:k] not in nodes:
                    nodes[x[:k]] = len(nodes)
                    steps.append((nodes[x[: k - 1]] * self.many + int(self.letter[ord(x[k - 1])]), nodes[x[:k]]))
        self.step = Table(*np.array(steps, np.int64).T, -1)
        self.piece_at = np.array([self.ids.get(x, -1) for x in nodes])
        self.piece_at[(self.piece_at >= 0) & ~self.made[self.piece_at]] = -1
        self.first = self.step(np.arange(self.many))

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces side by side; before is -1 where none is before."""
        key = before * self.wide + piece
        slot = ((key.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)
        out, new = self.pair_fits[slot], np.flatnonzero((self.pair[slot] != key) & (before >= 0))
        out[before < 0] = True
        if len(new):
            out[new] = self._side_by_side(before[new], piece[new])
            self.pair[slot[new]], self.pair_fits[slot[new]] = key[new], out[new]
        return out

    def _side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges on both sides of the border from the last to the first: at no time may the two pieces there have been joined.

        x and y are the pieces at the border at a time, until x became part of another at rank `x_until`, y likewise. Of
        equal ranks the left one is merged first.
        """
        out, rows = np.ones(len(a), bool), np.arange(len(a))
        x, y, x_until, y_until = a, b, np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(rows):
            at = self.joined(x * self.wide + y)
            joined = (at < x_until) & (at <= y_until)
            out[rows[joined]] = False
            x_last = self.rank[x] > self.rank[y]
            go = ~joined & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            rows, x, y, x_until, y_until, x_last = (v[go] for v in (rows, x, y, x_until, y_until, x_last))
            x_until, y_until = np.where(x_last, self.rank[x], x_until), np.where(x_last, y_until, self.rank[y])
            x, y = np.where(x_last, self.right[x], x), np.where(x_last, y, self.left[y])
        for k in np.flatnonzero(self.twisted[a] | self.twisted[b]).tolist():
            want = [self.pieces[a[k]], self.pieces[b[k]]]
            out[k] = self.merge("".join(want)) == want
        return out

    def lattice(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For letters of a text: the pieces from each boundary by length, the lengths of those that end at each boundary as
        bits, and where the longest from each boundary ends (one further, where there is none)."""
        n = len(codes)
        pieces, ending, reach = np.full((self.longest + 1, n), -1, np.int32), np.zeros(n + 1, np.int64), np.arange(1, n + 1)
        rows, node = np.arange(n), None
        for k in range(1, self.longest + 1):
            node = self.first[codes] if node is None else self.step(node * self.many + codes[rows + k - 1])
            on = np.flatnonzero(node >= 0)
            rows, node = rows[on], node[on].astype(np.int64)
            piece = self.piece_at[node]
            ends = rows[is_piece := piece >= 0]
            pieces[k, ends] = piece[is_piece]
            ending[ends + k] |= 1 << k
            reach[ends] = ends + k
            rows, node = rows[inside := rows + k < n], node[inside]
        return pieces, ending, reach

    def paths(self, codes: np.ndarray, final: bool, before: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Where pieces end and which they are (-1: a letter of none), and up to which boundary they are committed.

        If more letters are to follow (not final), only what these cannot change is committed. before is the piece in front.
        """
        pieces, ending, reach = self.lattice(codes)
        # no edge runs over a boundary that all edges before it end at
        meets = np.flatnonzero(np.maximum.accumulate(reach) <= np.arange(1, len(codes) + 1)) + 1
        if not final:
            meets = meets[meets <= len(codes) - self.longest]
        self.commits += len(meets)
        starts, sizes = np.r_[0, meets[:-1]], np.diff(np.r_[0, meets])
        last, back = np.full(len(codes) + 1, -1, np.int64), np.ones(len(codes) + 1, np.int64)
        last[0] = before
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] <= LONG]
        starts_, sizes_ = starts[order], sizes[order]
        for k in range(1, int(sizes_[0]) + 1 if len(sizes_) else 1):
            start = starts_[: np.searchsorted(-sizes_, -k, "right")]
            self._extend(start, start + k, pieces, ending, last, back)
        for start, size in zip(starts[sizes > LONG].tolist(), sizes[sizes > LONG].tolist()):
            self._follow(start, start + size, pieces, ending, last, back)
        ends, at, of = [], meets, starts
        while len(at):
            ends.append(at)
            at = at - back[at]
            at, of = at[more := at > of], of[more]
        ends = np.sort(np.concatenate([np.zeros(0, np.int64), *ends]))
        return ends, last[ends], int(meets[-1]) if len(meets) else 0

    def _extend(self, start: np.ndarray, at: np.ndarray, pieces: np.ndarray, ending: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """The surviving edges at boundaries `at` of paths that begin at `start`: of those that fit the longest."""
        left = ending[at]
        while True:
            some = left > 0
            if not some.all():
                start, at, left = start[some], at[some], left[some]
            if not len(at):
                return
            size = np.frexp(left.astype(np.float64))[1].astype(np.int64) - 1
            begin = at - size
            piece = pieces[size, begin].astype(np.int64)
            fits = self.fits(np.where((begin == start) & (start > 0), -1, last[begin]), piece)
            last[at[fits]], back[at[fits]] = piece[fits], size[fits]
            rest = ~fits
            start, at, left = start[rest], at[rest], left[rest] & ~(1 << size[rest])

    def _follow(self, start: int, end: int, pieces: np.ndarray, ending: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """The surviving edges of one long path, boundary by boundary."""
        seen: dict[tuple[int, int], bool] = {}
        for at in range(start + 1, end + 1):
            left = int(ending[at])
            while left:
                size = left.bit_length() - 1
                before, piece = -1 if at - size == start > 0 else int(last[at - size]), int(pieces[size, at - size])
                if (fits := seen.get((before, piece))) is None:
                    fits = seen[before, piece] = bool(self.fits(np.array([before]), np.array([piece]))[0])
                if fits:
                    last[at], back[at] = piece, size
                    break
                left &= ~(1 << size)

    @staticmethod
    def _meeting(back: np.ndarray, low: int, high: int) -> int:
        """The last boundary that all paths back from the boundaries of a window go through."""
        heads = set(range(low, high + 1))
        while len(heads) > 1:
            top = max(heads)
            heads.remove(top)
            heads.add(top - int(back[top]))
        return heads.pop()

    def _ids(self, chars: np.ndarray, ends: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, and how many each has: a letter of no piece is written by its bytes."""
        odd = np.flatnonzero(pieces < 0)
        if not len(odd):
            return pieces.astype(np.int32), np.ones(len(pieces), np.int64)
        codes, of = np.unique(chars[ends[odd] - 1], return_inverse=True)
        own = [self.ids_of(chr(c)) for c in codes.tolist()]
        sizes = np.ones(len(pieces), np.int64)
        sizes[odd] = np.array([len(x) for x in own])[of]
        out = np.repeat(pieces, sizes).astype(np.int32)
        out[np.repeat(pieces < 0, sizes)] = np.concatenate([own[k] for k in of.tolist()])
        return out, sizes

    def _one(self, chars: np.ndarray) -> np.ndarray:
        """Ids of one text of any length, in pieces of SLICE characters."""
        out, at, size, before = [np.zeros(0, np.int32)], 0, SLICE, -1
        while at < len(chars):
            part = chars[at : at + size]
            final = at + size >= len(chars)
            ends, pieces, done = self.paths(self.letter[part], final, before)
            if not done:  # one path runs on over all of the piece
                high = len(part) - self.longest
                ends, pieces, done = self._one_path(self.letter[part], high, before)
                if not done:
                    size *= 2
                    continue
                before = int(pieces[-1])
            else:
                before = -1
            out.append(self._ids(part, ends, pieces)[0])
            at, size = at + done, SLICE
        return np.concatenate(out)

    def _one_path(self, codes: np.ndarray, high: int, before: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Like `paths` for a path that meets no other: followed up to a boundary, committed where its backpointers meet."""
        pieces, ending, _ = self.lattice(codes)
        last, back = np.full(len(codes) + 1, -1, np.int64), np.ones(len(codes) + 1, np.int64)
        last[0] = before
        self._follow(0, high, pieces, ending, last, back)
        done, ends = self._meeting(back, max(0, high - self.longest + 1), high), []
        at = done
        while at > 0:
            ends.append(at)
            at -= int(back[at])
        self.commits += 1
        ends = np.array(ends[::-1], np.int64)
        return ends, last[ends], done

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after another, and how many each has."""
        values, counts, own, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [], 0

        def flush() -> None:
            if not own:
                return
            chars = _chars("\0".join([SPACE + t.replace(" ", SPACE) if t else "" for t in own]) + "\0")
            breaks = np.cumsum([len(t) + 2 if t else 1 for t in own])
            letters = self.letter[chars]
            letters[breaks - 1] = 0
            ends, pieces, _ = self.paths(letters, True)
            inside = np.ones(len(chars) + 1, bool)
            inside[breaks] = False
            ends, pieces = ends[keep := inside[ends]], pieces[keep]
            got, sizes = self._ids(chars, ends, pieces)
            values.append(got)
            counts.append(np.bincount(np.searchsorted(breaks, ends, "left"), sizes, len(own)).astype(np.int64))
            own.clear()

        for t in texts:
            if size + len(t) > SLICE:
                flush()
                size = 0
            if len(t) > SLICE:
                got = self._one(_chars(SPACE + t.replace(" ", SPACE)))
                values.append(got)
                counts.append(np.array([len(got)]))
            else:
                own.append(t)
                size += len(t) + 2
        flush()
        return np.concatenate(values), np.concatenate(counts)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        shown = self.shown
        if not self.partial[ids].any():
            text = "".join([shown[i] for i in ids.tolist()])
        else:
            text = "".join([bytes(raw).decode("utf-8", "replace") if raw else shown[i] for i, raw in self._runs(ids.tolist())])
        text = text.replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text

    def _runs(self, ids: list[int]) -> Iterator[tuple[int, bytearray]]:
        """Single ids, and runs of byte ids."""
        run = bytearray()
        for i in ids:
            if i in self.bytes_:
                run.append(self.bytes_[i])
                continue
            if run:
                yield -1, run
                run = bytearray()
            yield i, bytearray()
        if run:
            yield -1, run


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One to a Python worker."""
    return Codec(model)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A batch in runs of rows that hold about four times SLICE characters, each with its texts."""
    texts = batch.column(column)
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + 4 * SLICE)))
        yield (part := batch.slice(begin, end - begin)), part.column(column).to_pylist()
        begin = end


def encoded(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """docs with piece_ids array<int>, n_pieces long, and exact boolean: whether the ids decode to the text.

    A null text gives null ids, no pieces and exact true; an empty one an empty array. A text that holds the space mark
    itself, or lone surrogates, is encoded but does not decode to itself, and exact is false. Columns of these names are
    replaced; an empty table gives an empty one.
    """
    docs = spread(docs.drop("piece_ids", "n_pieces", "exact"))
    added = T.StructType().add("piece_ids", T.ArrayType(T.IntegerType())).add("n_pieces", "long").add("exact", "boolean")
    at = docs.columns.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for part, texts in _slices(batch, at):
                values, counts = own.encode_all([t or "" for t in texts])
                bounds = np.r_[0, np.cumsum(counts)]
                exact = [t is None or own.decode(values[i:j]) == t for t, i, j in zip(texts, bounds.tolist(), bounds[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(counts), pa.array(exact, pa.bool_())], names=[*part.schema.names, *added.names])

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, *added.fields]))


def decoded(ids: DataFrame, model: str, ids_col: str = "piece_ids") -> DataFrame:
    """ids with decoded string; null ids give a null text."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model)
        for batch in batches:
            yield pd.Series([None if x is None else own.decode(np.asarray(x, "<u4")) for x in batch])

    return ids.withColumn("decoded", decode(ids_col))
