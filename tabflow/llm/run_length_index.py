"""Removal of byte strings that an earlier document also has, by run-length indexes.

A string of 50 bytes is looked for where its anchor leads: the least hash of its
24-byte strings, which equal strings share. Other strings seldom do: the more text there is, the more strings of 16 bytes
occur in several documents by chance, and all their pieces would be indexed for nothing. Windows (strings of 50 bytes) that
follow one another with one anchor form a piece of some 63 bytes. Texts are dealt to blocks, anchors to buckets:

1. every block tells every bucket its anchors; buckets answer which lie in several documents;
2. blocks send the distinct pieces of those, with the least id that has each;
3. every bucket indexes, of each anchor with several pieces, the piece of the least id: it sorts their suffixes and keeps the runs of the
   Burrows-Wheeler transform, with the text positions at both ends of each run sampled. The other pieces stream
   through it from their ends; their matching statistics tell which windows the first piece has, and so the least
   id that has them. Stretches without a long match go through the same again;
4. blocks mark the windows with a lesser id than the document's, merge and remove them.

So copies, hot lines and repeated passages reach a bucket once per block. An anchor with very
many pieces would make one bucket large: its windows are dealt by their own hash instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.llm.common import checkpointed, mixed, row_key, spare_name, span_hashes, utf8

LENGTH = 50
GRAM = 24  # three words of 8 bytes
BLOCK_BYTES = 2 << 20
MOST_BLOCK_BYTES = 48 << 20
PARCEL_KEYS = 82  # anchors that a block tells a bucket at once
ANCHOR_BYTES = 14  # of text to an anchor
KEY_BYTES = 5  # of an anchor that a bucket is told; anchors that agree in them are marked alike
BUCKET_BYTES = 4 << 20  # of text to a bucket
HOT_PIECES = 200_000  # anchors with more are dealt window by window
PIECE_WINDOWS = 40
PIECES_AT_ONCE = 1 << 17  # whose windows are marked together
UP_TO = np.array([(2 << b) - 1 for b in range(64)], np.uint64)  # the bits up to each
ROUNDS = 2  # of indexing the first pieces and streaming the others
ROW_BYTES = 64  # what a row counts besides its text where copies are added up
RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
CHUNK = 1 << 15
NO_ID = np.iinfo(np.int64).min  # a null id comes before all others


def window_keys(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The least hash of the 24-byte strings in every string of ``length`` bytes."""
    n, span = len(data) - length + 1, length - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    buffer = np.r_[data, np.zeros(8, np.uint8)]
    words = np.ndarray(len(data) + 1, "<u8", buffer, strides=(1,))  # the eight bytes from every place on
    out = np.empty(n, np.uint64)
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        grams = hi - lo + span - 1
        near = words[lo:lo + grams + GRAM - 8].copy()
        h = near[:grams] * np.uint64(0x9E3779B97F4A7C15)
        h += near[8:8 + grams] * np.uint64(0xC2B2AE3D27D4EB4F)
        h += near[16:16 + grams] * np.uint64(0xA0761D6478BD642F)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        reach = 1
        while reach < span:
            step = min(reach, span - reach)
            h = np.minimum(h[:-step], h[step:])
            reach += step
        out[lo:hi] = h
    return out


def pieces_of(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, windows, text) of the runs of windows with one key; none crosses texts."""
    key = window_keys(data, length)
    if not len(key):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none
    ends = starts[1:] - length + 1  # the first place where a window would leave its text
    long = ends > starts[:-1]
    edge = np.zeros(len(key) + 1, np.int8)
    edge[starts[:-1][long]] = 1
    edge[ends[long]] = -1  # the next text begins further on, so these never meet
    valid = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    new = valid.copy()
    new[1:] &= (key[1:] != key[:-1]) | ~valid[:-1]
    at = np.flatnonzero(new)
    text = np.searchsorted(starts, at, "right") - 1
    windows = np.minimum(np.r_[at[1:], len(key)], ends[text]) - at
    parts = -(-windows // PIECE_WINDOWS)
    if len(parts) and parts.max() > 1:
        of = np.repeat(np.arange(len(at)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        windows = np.minimum(PIECE_WINDOWS, windows[of] - nth * PIECE_WINDOWS)
        at, text = at[of] + nth * PIECE_WINDOWS, text[of]
    return key[at], at, windows, text


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one list after the other."""
    total = int(size.sum())
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


class Block:
    """The texts of a block and their pieces."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, buckets: int, length: int):
        self.data, self.starts = utf8(table[text_col])
        ids = table[id_col].combine_chunks() if isinstance(table[id_col], pa.ChunkedArray) else table[id_col]
        self.ids = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.buckets, self.length = buckets, length
        self.key, self.at, self.windows, self.text = pieces_of(self.data, self.starts, length)
        self.keys, self.of = np.unique(self.key, return_inverse=True)
        bucket = self._bucket(self.keys)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(self.buckets)).astype(np.int32)

    def anchors(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, the low bytes of its keys in order, 0 if one id has a key, else 1, plus twice its pieces up to 32,767)."""
        least = np.full(len(self.keys), np.iinfo(np.int64).max)
        most = np.full(len(self.keys), NO_ID)
        np.minimum.at(least, self.of, self.ids[self.text])
        np.maximum.at(most, self.of, self.ids[self.text])
        number = np.minimum(np.bincount(self.of, minlength=len(self.keys)), 32_767)
        told = ((least != most) | (number << 1)).astype(np.uint16)
        for bucket, where in self._segments():
            yield bucket, self.keys[where].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES], told[where]

    def _segments(self) -> Iterator[tuple[int, np.ndarray]]:
        first = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]]) if len(self.bucket) else []
        for lo, hi in zip(first, np.r_[first[1:], len(self.bucket)]):
            yield int(self.bucket[lo]), self.order[int(lo):int(hi)]

    def shared(self, codes: dict[int, bytes]) -> None:
        """Finds the distinct pieces of the anchors that the buckets' ``codes`` mark: 1 whole, 2 window by window."""
        code = np.zeros(len(self.keys), np.uint8)
        for bucket, where in self._segments():
            if told := codes.get(bucket):
                code[where] = np.frombuffer(told, np.uint8)
        code = code[self.of]
        whole, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        single = spread(self.at[hot], self.windows[hot])
        self.place = np.concatenate([self.at[whole], single])
        self.size = np.concatenate([self.windows[whole], np.ones(len(single), np.int64)])
        self.doc = np.concatenate([self.text[whole], np.repeat(self.text[hot], self.windows[hot])])
        h = span_hashes(self.data, self.place, self.place + self.size + self.length - 1)
        key = np.concatenate([self.key[whole], h[len(whole):]])
        bucket = self._bucket(key)
        # One number to sort by: the bucket, then what tells the piece.
        bits = self.buckets.bit_length()
        tell = mixed(mixed(key) + h + self.size.astype(np.uint64)) >> np.uint64(bits)
        tell |= bucket.astype(np.uint64) << np.uint64(64 - bits)
        order = np.argsort(tell)
        sorted_ = tell[order]
        new = np.r_[True, sorted_[1:] != sorted_[:-1]] if len(order) else np.empty(0, bool)
        self.kind = np.empty(len(order), np.int64)  # the distinct piece of every piece
        self.kind[order] = np.cumsum(new) - 1
        head = order[new]
        self.kind_bucket, self.kind_place, self.kind_size = bucket[head], self.place[head], self.size[head]
        self.owner = np.full(len(head), np.iinfo(np.int64).max)
        np.minimum.at(self.owner, self.kind, self.ids[self.doc])

    def parcels(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """(bucket, bytes of its distinct pieces, their windows, their least ids), all compressed."""
        pack = zstandard.ZstdCompressor(level=1).compress
        first = np.flatnonzero(np.r_[True, self.kind_bucket[1:] != self.kind_bucket[:-1]]) if len(self.kind_bucket) else []
        for lo, hi in zip(first, np.r_[first[1:], len(self.kind_bucket)]):
            lo, hi = int(lo), int(hi)
            chars = self.data[spread(self.kind_place[lo:hi], self.kind_size[lo:hi] + self.length - 1)]
            windows, owner = self.kind_size[lo:hi].astype(np.uint8), self.owner[lo:hi]
            yield int(self.kind_bucket[lo]), pack(chars.tobytes()), pack(windows.tobytes()), pack(owner.tobytes())

    def removed(self, least: np.ndarray) -> np.ndarray:
        """Which bytes go, if ``least`` has the least id of every window of the distinct pieces, in their order."""
        begin = np.cumsum(self.kind_size) - self.kind_size
        if len(least) != self.kind_size.sum():
            raise ValueError("the buckets have answered other windows than were asked for")
        edge = np.zeros(len(self.data) + 1, np.int32)
        for lo in range(0, len(self.place), PIECES_AT_ONCE):
            some = slice(lo, lo + PIECES_AT_ONCE)
            size = self.size[some]
            gone = least[spread(begin[self.kind[some]], size)] < np.repeat(self.ids[self.doc[some]], size)
            at = spread(self.place[some], size)[gone]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + self.length, -1)
        return np.cumsum(edge[:-1], out=edge[:-1]) > 0


@dataclass
class RunLengthIndex:
    """The Burrows-Wheeler transform of some pieces by its runs, stretches of one byte before the sorted suffixes."""

    text: np.ndarray  # the pieces' bytes as numbers from 1 on, an end (0) behind each
    begin: np.ndarray  # where each piece begins in it
    code: np.ndarray  # by byte: its number, 0 if it doesn't occur
    starts: np.ndarray  # a bit for each row that begins a run, 64 rows in a number
    ranks: np.ndarray  # how many runs begin before each of these
    byte: np.ndarray  # by run: its byte's number
    first: np.ndarray  # its first row
    last: np.ndarray  # its last row
    step: np.ndarray  # how far stepping back moves its rows
    at_first: np.ndarray  # the text position sampled at its first row
    at_last: np.ndarray  # and at its last one
    by_byte: np.ndarray  # number * runs + run, in order: the runs of each byte

    @staticmethod
    def build(data: np.ndarray, starts: np.ndarray, length: int) -> RunLengthIndex:
        """Sorts the suffixes of all pieces by prefix doubling; a piece's end comes before every byte, and ends by order.

        As long as two ranks and a position fit into 64 bits, that is up to two million bytes, a round is a sort of plain numbers.
        """
        n_pieces, sizes = len(starts) - 1, np.diff(starts)
        present = np.flatnonzero(np.bincount(data, minlength=256))
        code = np.zeros(256, np.uint8 if len(present) < 256 else np.uint16)
        code[present] = np.arange(1, len(present) + 1)
        n, width = len(data) + n_pieces, int(len(present)).bit_length()
        place_bits = int(n).bit_length()
        begin = starts[:-1] + np.arange(n_pieces)
        text = np.zeros(n + max(64, length), code.dtype)
        text[spread(begin, sizes)] = code[data]
        left = np.repeat(starts[1:] + np.arange(n_pieces), sizes + 1) - np.arange(n)  # bytes of the suffix
        depth = min(8, (63 - place_bits) // width)
        key = np.zeros(n, np.uint64)
        for k in range(depth):
            key <<= np.uint64(width)
            key |= text[k:k + n]
        short = np.flatnonzero(left < depth)  # nothing behind a piece's end counts
        beyond = ((depth - left[short]) * width).astype(np.uint64)
        key[short] = key[short] >> beyond << beyond
        order, rank = _ranked(key, place_bits, depth * width)
        while depth <= left.max(initial=0) and int(rank.max(initial=0)) < n - 1:
            order, rank = _ranked(rank * np.uint64(n + 1) + _behind(rank, left, depth), place_bits, 2 * place_bits)
            depth *= 2
        # Suffixes that are equal to their ends are in the order of their pieces.
        before = np.where(order > 0, text[order - 1], 0)
        new = np.zeros(-(-n // 64) * 64, bool)
        new[0], new[1:n] = True, before[1:] != before[:-1]
        first, bits = np.flatnonzero(new), np.packbits(new, bitorder="little").view("<u8")
        ranks = np.r_[0, np.cumsum(np.bitwise_count(bits), dtype=np.int64)[:-1]]
        byte, runs = before[first].astype(np.int64), len(first)
        size_of = np.diff(np.r_[first, n])
        by_byte = np.argsort(byte, kind="stable")
        back = np.empty(runs, np.int64)
        back[by_byte] = np.cumsum(size_of[by_byte]) - size_of[by_byte]
        last = first + size_of - 1
        return RunLengthIndex(text, begin, code, bits, ranks, byte, first, last, back - first, order[first], order[last], byte[by_byte] * runs + by_byte)

    def run_of(self, row: np.ndarray) -> np.ndarray:
        word = row >> 6
        return self.ranks[word] + np.bitwise_count(self.starts[word] & UP_TO[row & 63]) - 1

    def statistics(self, data: np.ndarray, at: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For every byte of some texts in ``data``, one text after the other: how long a string of the indexed pieces begins
        there, up to ``length``, and where the index has it.

        All texts step back from their ends at once. If a byte goes on before the row that is matched, so does the match. Else
        the nearest runs of that byte above and below have the sampled suffixes that agree longest with the matched one.
        At the end of a run the sampled position must be that of the match: this proves the walk.
        """
        runs, many = len(self.first), len(at)
        found = np.zeros(int(sizes.sum()), np.int16)
        place = np.zeros(len(found), np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(self.text, length)
        by_size = np.argsort(-sizes, kind="stable")
        size, source = sizes[by_size], (at + sizes)[by_size]
        slot = np.cumsum(sizes)[by_size]
        row, position, held = np.zeros(many, np.int64), np.full(many, self.at_first[0]), np.zeros(many, np.int64)

        def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            apart = windows[a] != windows[b]
            return np.where(apart.any(axis=1), apart.argmax(axis=1), length)

        for back in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-size, -back, "right"))  # texts of at least so many bytes
            r, p, n = row[:live], position[:live], held[:live]
            c = self.code[data[source[:live] - back]].astype(np.int64)
            run = self.run_of(r)
            ends = np.flatnonzero(self.last[run] == r)
            if not np.array_equal(self.at_last[run[ends]], p[ends]):
                raise ValueError("the run-length index has lost its place")
            odd = np.flatnonzero(self.byte[run] != c)
            absent = c == 0
            if len(odd):
                next_ = np.searchsorted(self.by_byte, c[odd] * runs + run[odd])
                below = self.by_byte[np.minimum(next_, runs - 1)]
                above = self.by_byte[np.maximum(next_ - 1, 0)]
                has_below, has_above = (next_ < runs) & (below // runs == c[odd]), (next_ > 0) & (above // runs == c[odd])
                below, above = below % runs, above % runs
                long_below, long_above = np.where(has_below, 0, -1), np.where(has_above, 0, -1)
                for ok, long, sample in ((has_below, long_below, self.at_first[below]), (has_above, long_above, self.at_last[above])):
                    some = np.flatnonzero(ok & (n[odd] > 0))
                    long[some] = agree(p[odd[some]], sample[some])
                up = long_above >= long_below
                to = np.where(up, above, below)
                longest = np.maximum(long_above, long_below)
                absent[odd] |= longest < 0
                moved = ~absent[odd]
                into, to = odd[moved], to[moved]
                r[into] = np.where(up[moved], self.last[to], self.first[to])
                p[into] = np.where(up[moved], self.at_last[to], self.at_first[to])
                n[into] = np.minimum(n[into], longest[moved])
                run[into] = to
            here = ~absent
            r[here] += self.step[run[here]]
            p[here] -= 1
            n[here] = np.minimum(n[here] + 1, length)
            n[absent] = 0
            out = slot[:live] - back
            found[out], place[out] = n, p
        return found, place


def _behind(rank: np.ndarray, left: np.ndarray, by: int) -> np.ndarray:
    """1 + the rank ``by`` places further on, 0 beyond the end of the piece."""
    further = np.zeros(len(rank), np.uint64)
    if by < len(rank):
        further[:len(rank) - by] = rank[by:] + np.uint64(1)
    further[left < by] = 0
    return further


def _ranked(key: np.ndarray, place_bits: int, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions by key and then place, rank of each position; equal keys share a rank)."""
    if key_bits + place_bits <= 64:
        packed = np.sort(key << np.uint64(place_bits) | np.arange(len(key), dtype=np.uint64))
        order, sorted_ = (packed & np.uint64((1 << place_bits) - 1)).astype(np.int64), packed >> np.uint64(place_bits)
    else:
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(np.r_[False, sorted_[1:] != sorted_[:-1]], dtype=np.uint64)
    return order, rank


def _by_sorting(data: np.ndarray, at: np.ndarray, windows: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """The least owner of every window of some pieces, by the windows themselves."""
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[spread(at, windows)])
    _, which = np.unique(rows.view(f"V{length}").ravel(), return_inverse=True)
    least = np.full(int(which.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, which, np.repeat(owner, windows))
    return least[which]


def least_ids(data: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The least id over all pieces that have it, for every window of the pieces.

    Equal windows have one anchor. So of the pieces of an anchor the one of the least owner settles all its windows, wherever they occur. These
    pieces are indexed, if their anchor has others, and the others stream through: a window with a match of
    ``length`` belongs to the piece it is matched in. What is left of the others, stretches of windows that the first piece
    hasn't got, goes through the same again; what is left after ``ROUNDS`` is sorted by itself.
    """
    if not len(owner):
        return np.empty(0, np.int64)
    at, windows = starts[:-1], np.diff(starts) - length + 1
    slot, key = np.cumsum(windows) - windows, window_keys(data, length)[at]
    least = np.full(int(windows.sum()), np.iinfo(np.int64).max)
    for turn in range(ROUNDS + 1):
        order = np.lexsort((-windows, owner, key))
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        head, rest = order[new], order[~new]
        least[spread(slot[head], windows[head])] = np.repeat(owner[head], windows[head])
        if not len(rest):
            break
        if turn == ROUNDS:
            # All pieces of an anchor together, some anchors at a time.
            group = np.cumsum(new)
            some = np.flatnonzero(np.isin(group, group[~new]))
            for part in np.split(some, np.flatnonzero(np.diff(group[some] // PIECES_AT_ONCE)) + 1):
                more = order[part]
                least[spread(slot[more], windows[more])] = _by_sorting(data, at[more], windows[more], owner[more], length)
            break
        shared = head[np.bincount(np.cumsum(new) - 1) > 1]
        size = windows[shared] + length - 1
        index = RunLengthIndex.build(data[spread(at[shared], size)], np.r_[0, np.cumsum(size)], length)
        size = windows[rest] + length - 1
        found, place = index.statistics(data, at[rest], size, length)
        of_windows = spread(np.cumsum(size) - size, windows[rest])
        hit, where = found[of_windows] >= length, place[of_windows]
        piece = np.searchsorted(index.begin, where[hit], "right") - 1
        least[spread(slot[rest], windows[rest])[hit]] = owner[shared[piece]]
        # Stretches of windows without a match go on.
        first = np.cumsum(windows[rest]) - windows[rest]
        opens, closes = ~hit & ~np.r_[False, ~hit[:-1]], ~hit & ~np.r_[~hit[1:], False]
        opens[first] = ~hit[first]
        closes[first + windows[rest] - 1] = ~hit[first + windows[rest] - 1]
        run, end = np.flatnonzero(opens), np.flatnonzero(closes)
        if not len(run):
            break
        of = np.searchsorted(first, run, "right") - 1
        far = run - first[of]
        at, slot, windows, owner, key = at[rest][of] + far, slot[rest][of] + far, end - run + 1, owner[rest][of], key[rest][of]
    return least


def _answer(table: pa.Table, length: int) -> pa.Table:
    """A bucket's answers to the blocks: the least ids of their windows, as places of change and values."""
    unpack = zstandard.ZstdDecompressor().decompress
    parts = lambda name: [unpack(x) if x else b"" for x in table[name].to_pylist()]
    sizes = [np.frombuffer(x, np.uint8).astype(np.int64) for x in parts("windows")]
    chars = np.frombuffer(b"".join(parts("chars")), np.uint8)
    owner = np.frombuffer(b"".join(parts("owner")), np.int64)
    size = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    starts = np.r_[0, np.cumsum(size + length - 1)]
    # Blocks have many pieces in common: only distinct ones are indexed.
    h = span_hashes(chars, starts[:-1], starts[1:])
    tell = mixed(h + size.astype(np.uint64))
    order = np.argsort(tell)
    sorted_ = tell[order]
    new = np.r_[True, sorted_[1:] != sorted_[:-1]] if len(order) else np.empty(0, bool)
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    head = order[new]
    least_owner = np.full(len(head), np.iinfo(np.int64).max)
    np.minimum.at(least_owner, kind, owner)
    own = chars[spread(starts[head], size[head] + length - 1)]
    least = least_ids(own, np.r_[0, np.cumsum(size[head] + length - 1)], least_owner, length)
    begin = np.cumsum(size[head]) - size[head]
    every = least[spread(begin[kind], size)]
    ends = np.cumsum([s.sum() for s in sizes]).tolist()
    changes, values = [], []
    for lo, hi in zip([0, *ends], ends):
        part = every[lo:hi]
        turn = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
        changes.append(turn.astype(np.int32).tobytes())
        values.append(part[turn].tobytes())
    counts = pa.array(np.array([s.sum() for s in sizes], np.int64))
    return pa.table({"block": table["block"], "bucket": table["bucket"], "codes": table["codes"], "total": counts,
                     "changes": pa.array(changes, pa.binary()), "values": pa.array(values, pa.binary())})


def _mark(table: pa.Table, hot: int) -> pa.Table:
    """A bucket's codes for the anchors the blocks have told it: 0 in one document only, 1 shared, 2 shared by very many pieces."""
    keys = [x.as_py() for x in table["keys"]]
    low = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)
    key, told = np.zeros((len(low), 8), np.uint8), np.frombuffer(b"".join(x.as_py() for x in table["told"]), np.uint16)
    key[:, :KEY_BYTES] = low
    key = key.view("<u8").ravel()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    size = np.diff(np.r_[first, len(key)])
    pieces = np.add.reduceat((told >> 1)[order].astype(np.int64), first)
    several = (size > 1) | (np.maximum.reduceat(told[order] & 1, first) > 0)
    code = np.empty(len(key), np.uint8)
    code[order] = np.repeat(np.where(several, np.where(pieces > hot, 2, 1), 0).astype(np.uint8), size)
    ends = np.cumsum([len(k) // KEY_BYTES for k in keys]).tolist()
    codes = [code[lo:hi] for lo, hi in zip([0, *ends], ends)]
    some = pa.array([bool(c.any()) for c in codes])
    out = pa.table({"block": table["block"], "bucket": table["bucket"], "codes": pa.array([c.tobytes() for c in codes], pa.binary())})
    return out.filter(some)


def block_bytes(buckets: int) -> int:
    """The size of a block: large enough that it has some ``PARCEL_KEYS`` anchors for every bucket, as far as ``MOST_BLOCK_BYTES`` go.

    So the rows between blocks and buckets grow with the text, and not with its square, up to some 180 GB. Beyond, they have
    fewer and fewer anchors each; they are never more than the anchors.
    """
    return max(BLOCK_BYTES, min(MOST_BLOCK_BYTES, PARCEL_KEYS * ANCHOR_BYTES * buckets))


def _cut(docs: DataFrame, length: int, hot: int, id_col: str, text_col: str, keep_text: bool) -> DataFrame:
    """``_cut_once``, where rows that agree in id and text and together exceed a block are cut once and their copies follow."""
    key = spare_name(docs, "_copy")
    marked = docs.withColumn(key, row_key(id_col, text_col))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES
    many = marked.groupBy(key).agg(F.count("*").alias("n"), F.sum(size.cast("bigint")).alias("size")).where((F.col("n") > 1) & (F.col("size") > BLOCK_BYTES))
    many = checkpointed(many.select(key))
    if many.isEmpty():
        return _cut_once(docs, length, hot, id_col, text_col, keep_text, [])
    copies = marked.join(many, key, "left_semi")
    apart = marked.join(many, key, "left_anti").unionByName(copies.dropDuplicates([key]))
    cut = checkpointed(_cut_once(apart, length, hot, id_col, text_col, keep_text, [key]))
    known = cut.join(many, key, "left_semi")
    own = [c for c in copies.columns if c.lower() not in RESULTS and (keep_text or c in (id_col, key))]
    if keep_text:
        left = spare_name(copies, "_left")
        known = known.select(key, F.when(F.col("n_removed") > 0, F.struct(text_col)).alias(left), *RESULTS)
        followed = copies.select(*own).join(known, key).withColumn(text_col, F.coalesce(F.col(left)[text_col], F.col(text_col))).drop(left)
    else:
        followed = copies.select(*own).join(known.select(key, *RESULTS), key)
    return cut.join(many, key, "left_anti").unionByName(followed).drop(key)


def _cut_once(docs: DataFrame, length: int, hot: int, id_col: str, text_col: str, keep_text: bool, carried: list[str]) -> DataFrame:
    block = spare_name(docs, "_block")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    n = max(1, -(-size // block_bytes(buckets)))
    # The text takes part, so that rows with one id don't all meet in one block.
    dealt = docs.withColumn(block, F.pmod(F.xxhash64(id_col, text_col), F.lit(n)).cast("int"))
    columns = [f for f in docs.schema.fields if f.name.lower() not in RESULTS and (keep_text or f.name in (id_col, *carried))]

    def tell(table: pa.Table) -> pa.Table:
        found = [*Block(table, id_col, text_col, buckets, length).anchors()]
        return pa.table({
            "block": pa.array([table[block][0].as_py()] * len(found), pa.int32()), "bucket": pa.array([b for b, _, _ in found], pa.int32()),
            "keys": pa.array([k.tobytes() for _, k, _ in found], pa.binary()), "told": pa.array([t.tobytes() for _, _, t in found], pa.binary())})

    def send(table: pa.Table, codes: pa.Table) -> pa.Table:
        told = dict(zip(codes["bucket"].to_pylist(), codes["codes"].to_pylist()))
        rows = []
        if table.num_rows and told:
            mine = Block(table, id_col, text_col, buckets, length)
            mine.shared(told)
            rows = [(codes["block"][0].as_py(), b, told.pop(b, None), c, w, o) for b, c, w, o in mine.parcels()]
            # A bucket all of whose marked anchors are hot still has its codes to pass on.
            rows += [(codes["block"][0].as_py(), b, c, b"", b"", b"") for b, c in told.items()]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        names = ("block", "bucket", "codes", "chars", "windows", "owner")
        return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds))})

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            raise ValueError("answers for a block without texts")
        mine = Block(table, id_col, text_col, buckets, length)
        gone = np.zeros(len(mine.data), bool)
        if answers.num_rows:
            answers = answers.sort_by("bucket")
            mine.shared({b: c for b, c in zip(answers["bucket"].to_pylist(), answers["codes"].to_pylist()) if c})
            parts = []
            for total, turn, value in zip(*(answers[c].to_pylist() for c in ("total", "changes", "values"))):
                turn = np.frombuffer(turn, np.int32).astype(np.int64)
                parts.append(np.repeat(np.frombuffer(value, np.int64), np.diff(np.r_[turn, total])))
            gone = mine.removed(np.concatenate(parts))
        counts, spans, shas, kept = [], [], [], []
        stay, starts = mine.data[~gone], mine.starts
        begins = gone & ~np.r_[False, gone[:-1]]
        begins[starts[:-1][starts[:-1] < len(gone)]] = gone[starts[:-1][starts[:-1] < len(gone)]]
        lost = 0
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            counts.append(int(np.count_nonzero(gone[lo:hi])))
            spans.append(int(np.count_nonzero(begins[lo:hi])))
            rest = stay[lo - lost:hi - lost - counts[-1]].tobytes()
            lost += counts[-1]
            shas.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        out = {f.name: table[f.name] for f in columns}
        if keep_text:
            whole = table[text_col].to_pylist()
            out[text_col] = pa.array([w if not c else k.decode(errors="ignore") for w, c, k in zip(whole, counts, kept)], pa.string())
        return pa.table(out | {"n_bytes": pa.array(np.diff(starts)), "n_removed": pa.array(counts, pa.int64()),
                               "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())})

    if not keep_text:
        dealt = dealt.select(id_col, text_col, *carried, block)
    by_block = lambda df, name="block": df.groupBy(df[name])
    told = by_block(dealt, block).applyInArrow(tell, "block int, bucket int, keys binary, told binary")
    codes = told.groupBy("bucket").applyInArrow(lambda t: _mark(t, hot), "block int, bucket int, codes binary")
    sent = by_block(dealt, block).cogroup(by_block(codes)).applyInArrow(
        send, "block int, bucket int, codes binary, chars binary, windows binary, owner binary")
    answers = sent.groupBy("bucket").applyInArrow(
        lambda t: _answer(t, length), "block int, bucket int, codes binary, total bigint, changes binary, values binary")
    schema = StructType([*columns])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return by_block(dealt, block).cogroup(by_block(answers)).applyInArrow(remove, schema.add("kept_sha256", "string"))


def repeated_bytes(docs: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Removed is every byte covered by a string of ``length`` bytes (32 at least) that also begins in a row with a
    lesser id. Null ids come before all others; rows with one id don't cut each other. A null text
    counts as empty; shorter texts lose nothing. Repeated rows stay; other columns are not read. Rows that agree in id and
    text are cut once if together they would exceed a block, so a hot row is not gathered.
    """
    return _cut(docs, length, hot, id_col, text_col, False)


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with those bytes gone from the text, and the columns of ``repeated_bytes``, which replace any of
    their names. Bytes left of a character of which others went are dropped from the text; texts that lose nothing stay as they are, nulls too."""
    return _cut(docs, length, hot, id_col, text_col, True)
