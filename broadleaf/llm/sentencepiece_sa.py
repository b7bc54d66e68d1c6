"""SentencePiece BPE encoding by suffix-array matching, and decoding.

Text is escaped (a mark before it and for every space) and cut into units that
no merge can cross: before a mark that follows other text, around characters that
no piece has, and between a letter and another character if no piece joins the
two.  The distinct new units of a batch are concatenated and indexed by a suffix
array, in order of as many characters as the longest piece has.  A binary search
of every piece gives the range of suffixes that start with it: each member is an
edge from the suffix's place over the piece's length.  Edges are sorted by where
they end and relaxed place by place, all units at once: the encoding of a prefix
ends in the one piece that can stand after the last piece of the prefix before
it, that is, where merging the two pieces' characters by rank gives just the two.
Characters without a piece become byte pieces.  Units are remembered, up to a
bound in bytes, so that only new ones are matched.

A unit of more than LONG characters is matched in stretches that overlap, all at
once: where the last pieces of two stretches agree over as many places as the longest
piece has characters, they agree from there on.  If they don't, the unit is relaxed
from its start.  The pieces of a run of spaces share one rank, the last of all, so a
run is as many of the longest as fit and a rest whose pieces are a table; the last
space goes to the word behind it if that word's own encoding takes it.

The result equals the sentencepiece library's.

Defined results: null and empty text have no ids and decode to the empty text; the
mark itself (U+2581) decodes to a space, so that text holding it isn't restored;
lone surrogates can't occur in Spark strings; repeated rows each get a row; other
columns are ignored.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, filesystem, remembers, text_blocks

MARK = "▁"
NORMAL, CONTROL, USER, BYTE = 1, 3, 4, 6
MOST_BYTES, BLOCK_CHARS, MATCH_CHARS = 48 << 20, 1_000_000, 150_000
LONG, STRETCH, OVERLAP = 8192, 4096, 512
#: Bytes that a remembered unit takes besides its characters and ids.
UNIT_BYTES = 140


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Pieces:
    """The pieces of a BPE model file, with what matching and merging need."""

    def __init__(self, data: bytes):
        self.text, score, kind = [], [], []
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                self.text.append(p[1].decode())
                score.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                kind.append(p.get(3, NORMAL))
            elif field == 2 and dict(_fields(value)).get(3) != 2:
                raise ValueError("not a BPE model")
            elif field == 3 and (dict(_fields(value)).get(1) != b"identity" or dict(_fields(value)).get(4, 1)):
                raise ValueError("only models without normalisation and with all white space kept are supported")
        self.kind = np.array(kind)
        self.byte = {int(t[1:-1], 16): i for i, t in enumerate(self.text) if kind[i] == BYTE}
        self.ids = {t: i for i, t in enumerate(self.text) if kind[i] in (NORMAL, USER)}
        n = len(self.text)
        order = sorted(self.ids.values(), key=lambda i: (-score[i], i))
        self.rank = np.full(n, n, np.int64)
        self.score = np.array(score)
        for r, i in enumerate(order):
            self.rank[i] = r
        self._splits()
        self._runs()
        pairs = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        self.letter_ends = not any(a.isalpha() and not b.isalpha() for a, b in pairs)
        self._keys()
        self.shown = [bytes([int(t[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else t.replace(MARK, " ").encode() for t, k in zip(self.text, kind, strict=True)]

    def merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Pieces of text by plain merging, best score and then leftmost first; and the last two that were merged. -1: no piece."""
        parts, last = [self.ids.get(c, -1) for c in text], None
        names = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(names[k] + names[k + 1])
                if i is not None and (best is None or self.score[i] > self.score[best[0]]):
                    best = (i, k)
            if best is None:
                return parts, last
            i, k = best
            last = (parts[k], parts[k + 1])
            parts[k : k + 2], names[k : k + 2] = [i], [names[k] + names[k + 1]]

    def _splits(self) -> None:
        """For each piece the two it is merged from (itself twice if it is one character), and all merges by pair."""
        n = len(self.text)
        self.left, self.right = np.arange(n), np.arange(n)
        self.usable = np.zeros(n, bool)
        keys, to = [], []
        for t, i in self.ids.items():
            if len(t) == 1:
                self.usable[i] = True
                continue
            parts, last = self.merged(t)
            if parts == [i]:
                self.usable[i] = True
                self.left[i], self.right[i] = last
        for t, i in self.ids.items():
            for k in range(1, len(t)):
                a, b = self.ids.get(t[:k]), self.ids.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    to.append(i)
        order = np.argsort(keys)
        self.pair_key, self.pair_to = np.array(keys)[order], np.array(to)[order]

    def _runs(self) -> None:
        """Pieces of runs of fewer marks than the longest run's, by number; none if runs aren't merged last and alike."""
        self.run: list[list[int]] = []
        own = {len(t): i for t, i in self.ids.items() if set(t) == {MARK}}
        n = max(own, default=1)
        others = [self.score[i] for t, i in self.ids.items() if len(t) > 1 and set(t) != {MARK}]
        alike = len({self.score[i] for k, i in own.items() if k > 1}) == 1 and self.score[own[n]] < min(others, default=0.0)
        if not alike or any(MARK * 2 in t and set(t) != {MARK} for t in self.ids):
            return
        plain = [self.merged(MARK * k)[0] for k in range(5 * n)]
        if all(x == [own[n]] * (k // n) + plain[k % n] for k, x in enumerate(plain)):
            self.run = plain[: n + 1]

    def run_ids(self, k: int) -> list[int]:
        n = len(self.run) - 1
        return self.run[n] * (k // n) + self.run[k % n]

    def can_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, side by side, are what merging their characters gives: no merge over the seam beats those inside."""
        n, out = len(self.text), np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), n + 1)
        while len(at):
            k = np.minimum(np.searchsorted(self.pair_key, a * n + b), len(self.pair_key) - 1)
            joined = (self.pair_key[k] == a * n + b) & (self.rank[self.pair_to[k]] < limit)
            out[at[joined]] = False
            ra, rb = np.where(self.left[a] == a, -1, self.rank[a]), np.where(self.left[b] == b, -1, self.rank[b])
            go = ~joined & ((ra >= 0) | (rb >= 0))
            by_a = ra > rb  # the later merge is undone first; of two equal ones the right
            limit = np.where(by_a, ra, rb + 1)[go]
            a, b = np.where(by_a, self.right[a], a)[go], np.where(by_a, b, self.left[b])[go]
            at = at[go]
        return out

    def _keys(self) -> None:
        """Usable pieces as rows of 16-bit character codes, the least and the largest that start with each."""
        chars = sorted({c for t in self.ids for c in t})
        if len(chars) > 0xFFFE:
            raise ValueError("too many characters for 16-bit codes")
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        pieces = [(t, i) for t, i in self.ids.items() if self.usable[i]]
        self.piece = np.array([i for _, i in pieces])
        self.size = np.zeros(len(self.text), np.int64)
        self.width = max(len(t) for t, _ in pieces)
        low = np.zeros((len(pieces), self.width), ">u2")
        high = np.full((len(pieces), self.width), 0xFFFF, ">u2")
        for k, (t, i) in enumerate(pieces):
            low[k, : len(t)] = high[k, : len(t)] = self.code[[ord(c) for c in t]]
            self.size[i] = len(t)
        self.low, self.high = (x.view(f"S{2 * self.width}").ravel() for x in (low, high))

    # -- matching ---------------------------------------------------------

    def relaxed(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For units end to end, the last piece of each prefix by its end (-1: a character without a piece); starts and ends of units."""
        sizes = np.array([len(u) for u in units])
        codes = self.code[np.frombuffer("".join(units).encode("utf-32-le"), "<u4")]
        ends = np.cumsum(sizes)
        starts, n = ends - sizes, len(codes)
        unit = np.repeat(np.arange(len(units)), sizes)
        # the suffix array: places in order of their first characters within the unit
        padded = np.append(codes, np.zeros(self.width, np.uint16))
        window = np.lib.stride_tricks.sliding_window_view(padded, self.width)[:n].astype(">u2")
        left = ends[unit] - np.arange(n)
        window[np.arange(self.width)[None, :] >= left[:, None]] = 0
        keys = window.view(f"S{2 * self.width}").ravel()
        suffixes = np.argsort(keys)
        keys = keys[suffixes]
        lo, hi = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        count = hi - lo
        edge_piece = np.repeat(self.piece, count)
        edge_from = suffixes[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        unknown = np.flatnonzero(codes == 0)
        edge_piece = np.concatenate([edge_piece, np.full(len(unknown), -1)])
        edge_from = np.concatenate([edge_from, unknown])
        edge_to = edge_from + np.where(edge_piece < 0, 1, self.size[edge_piece])
        # edges by how far into its unit they end, so that all units advance together
        depth = edge_to - starts[unit[edge_from]]
        order = np.argsort(depth, kind="stable")
        edge_piece, edge_from, edge_to, depth = edge_piece[order], edge_from[order], edge_to[order], depth[order]
        last = np.full(n + 1, -2, np.int64)  # the piece that ends before each place
        fresh = np.zeros(n + 1, bool)  # a unit or what follows an unknown character starts here
        fresh[starts] = True
        fresh[unknown + 1] = True
        bounds = np.searchsorted(depth, np.arange(1, (depth[-1] if len(depth) else 0) + 2))
        ends_at = np.full(n + 1, -2, np.int64)
        for a, b in zip(bounds, bounds[1:], strict=False):
            p, s, e = edge_piece[a:b], edge_from[a:b], edge_to[a:b]
            ok = fresh[s] | (p < 0)
            check = np.flatnonzero(~ok)
            ok[check] = self.can_follow(last[s[check]], p[check])
            # place e belongs to the unit before it; a unit's own start keeps its mark
            ends_at[e[ok]] = p[ok]
            inner = e[ok]
            last[inner] = p[ok]
        return ends_at, starts, ends

    def match(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, -1 for a character without a piece; and where each unit's end."""
        ends_at, starts, ends = self.relaxed(units)
        # back from the ends
        at, live, steps = ends.copy(), np.arange(len(units)), []
        while len(live):
            p = ends_at[at[live]]
            steps.append((live, p))
            at[live] -= np.where(p < 0, 1, self.size[p])
            live = live[at[live] > starts[live]]
        who = np.concatenate([w for w, _ in steps])[::-1]
        what = np.concatenate([p for _, p in steps])[::-1]
        order = np.argsort(who, kind="stable")
        return what[order], np.cumsum(np.bincount(who, minlength=len(units)))

    def match_long(self, unit: str) -> list[int]:
        """Ids of one unit by stretches that overlap."""
        n = len(unit)
        begins = range(0, max(1, n - OVERLAP), STRETCH)
        whole = np.empty(n + 1, np.int32)
        known = 0  # whole holds the last pieces of prefixes up to here
        for some in text_blocks((unit[k : k + STRETCH + OVERLAP] for k in begins), MATCH_CHARS):
            ends_at, starts, ends = self.relaxed(some)
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                own = ends_at[s + 1 : e + 1]
                if not known:
                    whole[1 : len(own) + 1], known, begin = own, len(own), 0
                    continue
                begin += STRETCH
                same = whole[begin + 1 : known + 1] == own[: known - begin]
                agreed = np.flatnonzero(np.convolve(same, np.ones(self.width), "valid") == self.width) if len(same) >= self.width else ()
                if not len(agreed):
                    return self.match([unit])[0].tolist()
                at = int(agreed[0])
                whole[begin + 1 + at : begin + len(own) + 1], known = own[at:], begin + len(own)
        out, at = [], n
        while at:
            p = int(whole[at])
            out.append(p)
            at -= 1 if p < 0 else int(self.size[p])
        return out[::-1]

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte[b] for b in text.encode()]


class Codec:
    """Encoding and decoding with a bounded memory of units; ids are 16-bit in memory."""

    def __init__(self, data: bytes):
        self.pieces = Pieces(data)
        if len(self.pieces.text) > 1 << 16:
            raise ValueError("more than 65536 pieces")
        letters = r"[^\W\d_]"
        stop = rf"\n{MARK}"
        self.unit = re.compile(rf"{MARK}*(?:{letters}+|(?:(?![{stop}])[\W\d_])+{letters}*)|\n+|{MARK}+" if self.pieces.letter_ends else rf"{MARK}*[^{stop}]+|\n+|{MARK}+")
        self.seen: dict[str, bytes] = {}
        self.held = 0

    def _coded(self, unit: str, ids: list[int]) -> bytes:
        """The ids with byte pieces for characters without a piece."""
        p, out, at = self.pieces, [], 0
        for i in ids:
            out += p.bytes_of(unit[at]) if i < 0 else [i]
            at += 1 if i < 0 else len(p.text[i])
        return np.array(out, "<u2").tobytes()

    def _learn(self, units: Iterable[str]) -> None:
        runs, plain = [], set()
        for u in units:
            k = len(u) - len(u.lstrip(MARK))
            if k < 2 or not self.pieces.run:
                plain.add(u)
            else:
                runs.append((u, k))
                if k < len(u):
                    plain.add(MARK + u[k:])
        plain -= self.seen.keys()
        for some in text_blocks((u for u in plain if len(u) <= LONG and (self.pieces.run or MARK * 3 not in u)), MATCH_CHARS):
            ids, ends = self.pieces.match(some)
            raw, last = ids.astype("<u2").tobytes(), 0
            for u, end in zip(some, (2 * ends).tolist(), strict=True):
                self._keep(u, raw[last:end])
                last = end
            for k in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), "right")).tolist():
                self._keep(some[k], self._coded(some[k], ids[ends[k - 1] if k else 0 : ends[k]].tolist()))
        for u in plain - self.seen.keys():
            self._keep(u, self._coded(u, self.pieces.match_long(u) if self.pieces.run or MARK * 3 not in u else self.pieces.merged(u)[0]))
        mark = np.array([self.pieces.ids.get(MARK, -1)], "<u2").tobytes()
        for u, k in runs:
            word = self.seen[MARK + u[k:]] if k < len(u) else mark
            alone = word[:2] == mark  # the word leaves the space before it to the run
            self._keep(u, np.array(self.pieces.run_ids(k if alone else k - 1), "<u2").tobytes() + (word[2:] if alone else word))

    def _keep(self, unit: str, ids: bytes) -> None:
        self.seen[unit] = ids
        self.held += 4 * len(unit) + len(ids) + UNIT_BYTES

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > MOST_BYTES:
            self.forget()
        units = [self.unit.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = set().union(*units).difference(self.seen)
        if new:
            self._learn(new)
        return [b"".join(map(self.seen.__getitem__, u)) for u in units]

    def forget(self) -> None:
        self.seen.clear()
        self.held = 0

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.pieces.shown.__getitem__, np.frombuffer(ids, "<u2").tolist()))
        return raw.decode("utf-8", "replace")[1:] if raw[:1] == b" " else raw.decode("utf-8", "replace")


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    fs, p = filesystem(path)
    with fs.open_input_file(p) as f:
        return Codec(f.read())


def _encoder(model: str, digest: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        remembers("sentencepiece", c.forget)
        for batch in batches:
            at = 0
            for texts in text_blocks(batch.column(1).to_pylist(), BLOCK_CHARS):
                coded = c.encode(texts)
                doc = batch.column(0).slice(at, len(texts))
                at += len(texts)
                same = pa.array([c.decode(x) == t for x, t in zip(coded, texts, strict=True)], pa.bool_())
                if digest:
                    n = pa.array([len(x) // 2 for x in coded], pa.int64())
                    crc = pa.array([zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in coded], pa.int64())
                    yield pa.RecordBatch.from_arrays([doc, n, crc, same], names=["doc_id", "n_ids", "ids_crc32", "restored"])
                else:
                    ends = np.cumsum([0] + [len(x) // 2 for x in coded]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<u2").astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([doc, ids, same], names=["doc_id", "ids", "restored"])

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    arrow_rows(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, and restored: whether the ids decode to the text. model: path of a model file, the same on all machines."""
    return _rows(docs, id_col, text_col).mapInArrow(_encoder(model, False), "doc_id long, ids array<int>, restored boolean")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers), restored."""
    return _rows(docs, id_col, text_col).mapInArrow(_encoder(model, True), "doc_id long, n_ids long, ids_crc32 long, restored boolean")


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids; null ids give null text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            texts = [None if x is None else c.decode(np.array(x, "<u2").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>")).mapInArrow(run, "doc_id long, text string")
