"""Byte-level BPE by ranks: encoding in length-bucketed padded matrices, and decoding.

A text is cut into matches of the tokenizer's pattern. Matches not seen before in a worker are encoded together: they
are bucketed by length into padded matrices of token ids, and in every round each row merges its leftmost pair of
least rank. Pair ranks come from a hash table in numpy arrays; after a round only the two pairs beside the merge are
looked up again, the column that a merge frees is closed, and rows without a mergeable pair leave the matrix.

A round costs a row's length, so a piece of n bytes would cost n * n. A row of over WIDE columns therefore is a
matrix of its own, in which a round takes all places of the least rank, from left to right, after a check that this
is what single merges would do (see _merge_long).

Defined results: a null text counts as empty and has no tokens; identifiers, null or repeated, pass through, a row
for each row. Texts of any length are encoded whole; a worker handles about CHUNK_BYTES of text at a time. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.llm.words import PLAIN, PLAIN_TAIL, Memo, hold, numbered, release, runs

#: Bytes of text encoded at a time.
CHUNK_BYTES = 1_000_000
#: Cells of one matrix.
MATRIX_CELLS = 1_000_000
#: Columns from which a row is a matrix of its own.
WIDE = 1024

_NONE = np.int32(2**31 - 1)
_SCHEMA = "doc_id long, ids array<int>, decoded binary"

#: White space other than single spaces and line ends between visible characters.
_ODD_SPACE = r"^[ \n]|[ \n][ \n]|[ \n]$|[\t\x{0b}\x{0c}\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")


class PairTable:
    """Rank of a pair of ids by open addressing: two arrays, multiplicative hashing, linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(len(rank) * 4).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        keys = self._key(left, right)
        at, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == np.iinfo(np.uint64).max
            tried = todo[free]
            slots, first = np.unique(at[tried], return_index=True)
            placed = tried[first]
            self.keys[slots], self.ranks[slots] = keys[placed], rank[placed]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left, right):
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _home(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, _NONE where a pair can't merge."""
        keys = self._key(left, right)
        at = self._home(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], _NONE)
        todo = np.flatnonzero((found != keys) & (found != np.iinfo(np.uint64).max))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (found != np.iinfo(np.uint64).max)]
        return out


class BytePairEncoder:
    """Encoder and decoder of one rank file; matches of `pattern` are encoded separately."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        vocab = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            vocab[rank] = token
        self.vocab = pa.array(vocab, pa.large_binary())
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        splits = [
            (self.ranks[token[:k]], self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self.pairs = PairTable(*np.array(splits, np.int64).reshape(-1, 3).T)
        self.pieces = Memo(self._make, np.int32)

    # -- merging -------------------------------------------------------------------------------------------------

    def _make(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.merge([p.encode() for p in pieces])

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has. A piece that is a token is that token."""
        ids: list[np.ndarray] = []
        sizes = np.zeros(len(pieces), np.int64)
        at: list[np.ndarray] = []  # the piece that each array of `ids` belongs to, id by id
        by_length: dict[int, list[int]] = {}
        whole, known = [], []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                whole.append(i)
                known.append(rank)
            elif len(piece) > WIDE:
                ids.append(self._merge_long(piece))
                at.append(np.full(len(ids[-1]), i))
            elif piece:
                # a bucket's rows differ in length by an eighth at most
                n = len(piece)
                step = 1 << max(0, n.bit_length() - 4)
                by_length.setdefault(-(-n // step) * step, []).append(i)
        ids.append(np.array(known, np.int32))
        at.append(np.array(whole, np.int64))
        for width, rows in by_length.items():
            most = max(1, MATRIX_CELLS // width)
            for k in range(0, len(rows), most):
                part = rows[k : k + most]
                found, row = self._merge_matrix([pieces[i] for i in part], width)
                ids.append(found)
                at.append(np.array(part, np.int64)[row])
        flat, owner = np.concatenate(ids), np.concatenate(at)
        order = np.argsort(owner, kind="stable")
        sizes += np.bincount(owner, minlength=len(pieces))
        return flat[order], sizes

    def _first(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the bytes, -1 beyond a piece's end, and the ranks of neighbours."""
        size = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        inside = np.arange(width) < size[:, None]
        ids = np.where(inside, self.byte_ids[raw], np.int32(-1))
        ranks = np.full((len(pieces), width - 1), _NONE, np.int32)
        pair = inside[:, 1:]
        ranks[pair] = self.pairs.get(ids[:, :-1][pair], ids[:, 1:][pair])
        return ids, ranks

    def _merge_matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and the piece of each id."""
        ids, ranks = self._first(pieces, width)
        rows, out, owner = np.arange(len(pieces)), [], []

        def leave(lines: np.ndarray, names: np.ndarray) -> None:
            there = lines >= 0
            out.append(lines[there])
            owner.append(np.repeat(names, there.sum(axis=1)))

        while len(rows):
            n, w = ids.shape
            if w == 1:
                leave(ids, rows)
                break
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            best = ranks[np.arange(n), at]
            done = best == _NONE
            if done.any():
                leave(ids[done], rows[done])
                go = ~done
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                n = len(rows)
                if not n:
                    break
            every = np.arange(n)
            ids[every, at] = best
            # close the freed column: everything behind it moves one to the left
            behind = np.arange(w - 1) > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ranks = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1]) if w > 2 else ranks[:, :0]
            for pos in (at - 1, at):  # the pairs that the merge has changed
                ok = (pos >= 0) & (pos < w - 2)
                r, p = every[ok], pos[ok]
                left, right = ids[r, p], ids[r, p + 1]
                there = right >= 0
                new = np.full(len(r), _NONE, np.int32)
                new[there] = self.pairs.get(left[there], right[there])
                ranks[r, p] = new
        return np.concatenate(out), np.concatenate(owner)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges in a matrix of one row, where a round takes every place of the least rank from left to right.

        That is what as many rounds of one merge would do, unless a merge made a pair of a lower rank on the way, which
        would go first. Such pairs are looked for, and where there is one the round takes the leftmost place alone.
        """
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.get(ids[:-1], ids[1:])
        while len(ranks):
            least = ranks.min()
            if least == _NONE:
                break
            at = np.flatnonzero(ranks == least)
            # places one behind the other share an id: of a run of them every other one merges
            run = at - np.arange(len(at))
            at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            right = ids[at[at + 2 < len(ids)] + 2]
            if len(at) > 1 and (self.pairs.get(np.full(len(right), least), right) < least).any():
                at = at[:1]
            merged = self._merged_at(ids, ranks, at, least)
            if len(at) > 1 and merged[1].min(initial=_NONE) < least:
                merged = self._merged_at(ids, ranks, at[:1], least)
            ids, ranks = merged
        return ids

    def _merged_at(self, ids: np.ndarray, ranks: np.ndarray, at: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ranks of neighbours after the merges of the pairs at some places."""
        stays = np.ones(len(ids), bool)
        stays[at + 1] = False
        ids = ids[stays]
        ranks = ranks[stays[1:]]
        now = at - np.arange(len(at))
        ids[now] = rank
        changed = np.concatenate([now[now > 0] - 1, now[now < len(ids) - 1]])
        ranks[changed] = self.pairs.get(ids[changed], ids[changed + 1])
        return ids, ranks

    # -- texts ---------------------------------------------------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (and the last one's end)."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False) | (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0)
        if not odd.any():
            return self._joined(*self._plain_units(texts))
        if odd.all():
            return self._joined(*self._odd_units(texts))
        parts = [self._joined(*units(texts.filter(pa.array(mask)))) for units, mask in ((self._plain_units, ~odd), (self._odd_units, odd))]
        # back in the order of the texts
        flat, first, size = (np.concatenate(x) for x in ([p[0] for p in parts], [parts[0][1][:-1], parts[1][1][:-1] + len(parts[0][0])], [np.diff(p[1]) for p in parts]))
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        return flat[runs(first[order], size[order])], np.concatenate([[0], np.cumsum(size[order])])

    def _plain_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Units of texts in which single spaces and line ends stand between visible characters.

        No match reaches over a space that follows a visible character, except by starting with it, nor over a line
        end between visible characters, which is a match of its own. So such a text falls into units there.
        """
        codes, starts, words = numbered(pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " "))
        # a word has the space before it, unless it begins a text or a line
        line_end = pc.index(words, pa.scalar("\n", words.type)).as_py()
        spaced = np.ones(len(codes), bool)
        spaced[starts[:-1]] = False
        if line_end >= 0:
            ends = codes == line_end
            spaced[1:] &= ~ends[:-1]
            spaced &= ~ends
        numbers = codes.astype(np.int64) * 2 + spaced
        used = np.zeros(2 * len(words), bool)
        used[numbers] = True
        some = np.flatnonzero(used)
        chosen = words.take(pa.array(some >> 1))
        lead = pc.if_else(pa.array((some & 1).astype(bool)), " ", "")
        place = np.cumsum(used) - 1
        return place[numbers], starts, pc.binary_join_element_wise(lead, chosen, "")

    def _odd_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        return numbered(pa.array([_BEFORE_SPACE.split(t) if t else [] for t in texts.to_pylist()], pa.list_(pa.string())))

    def _joined(self, codes: np.ndarray, starts: np.ndarray, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        first, size, flat = self._unit_ids(units)
        ends = np.concatenate([[0], np.cumsum(size[codes])])
        return flat[runs(first[codes], size[codes])], ends[starts]

    def _unit_ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of each unit's ids, and the ids. Letters are one match, with the space before them; a sign after them is another."""
        bare = pc.utf8_ltrim(units, characters=" ")
        one, two = (pc.match_substring_regex(bare, p).to_numpy(zero_copy_only=False) for p in (PLAIN, PLAIN_TAIL))
        rest = np.flatnonzero(~one & ~two)
        found = [self.pattern.findall(u) for u in units.take(pa.array(rest)).to_pylist()]
        counts = np.where(two, 2, 1)
        counts[rest] = [len(f) for f in found]
        begin = np.cumsum(counts) - counts
        tails = units.filter(pa.array(two))
        pieces = pa.concat_arrays([units.filter(pa.array(one)), pc.utf8_rtrim(tails, characters=".,"), pc.utf8_slice_codeunits(tails, -1), pa.array([p for f in found for p in f], pa.string())])
        where = np.concatenate([begin[one], begin[two], begin[two] + 1, runs(begin[rest], counts[rest])])
        named = pieces.dictionary_encode()
        first, size = self.pieces.find(named.dictionary)
        order = np.empty(len(where), np.int64)
        order[where] = named.indices.to_numpy(zero_copy_only=False)
        flat = self.pieces.flat[runs(first[order], size[order])]
        ends = np.concatenate([[0], np.cumsum(size[order])])
        start = ends[begin]
        return start, ends[begin + counts] - start, flat

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The bytes of each run of ids between two starts."""
        found = self.vocab.take(pa.array(ids))
        ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends[starts])), found.buffers()[2]]).cast(pa.binary())


def encoder(path: str, pattern: str) -> BytePairEncoder:
    """The worker's encoder of a rank file."""
    return hold((path, pattern), lambda: BytePairEncoder(path, pattern))


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `most` bytes of text each, or one row."""
    size = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", check: bool = False) -> DataFrame:
    """doc_id, ids of the whole text, and the bytes that the ids decode to; with check, a text that these are not is an error."""

    def run(batches):
        coder = encoder(rank_file, pattern)
        for batch in batches:
            for part in chunks(batch):
                ids, starts = coder.encode(part["text"])
                decoded = coder.decode(ids, starts)
                if check and not decoded.equals(part["text"].cast(pa.binary())):
                    raise ValueError("ids don't decode to the text that they are of")
                listed = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], listed, decoded], ["doc_id", "ids", "decoded"])
            release()

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, _SCHEMA)


def ids_text(ids="ids"):
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")
