"""Content-addressed store of token ids.

Every document is encoded, an end id is appended, and the id stream of the
document is cut where a rolling hash of the last 32 ids says so, so that equal
runs of ids in different documents give equal chunks.  A chunk is named by the
SHA-256 of its ids and stored once.  Documents become recipes: lists of chunk
names with places in the pack files.  Recipe files hold the documents in
ascending doc_id order and carry a Merkle root; the manifest carries the root of
those roots.  Reading a store recomputes every hash on the way.

Jobs: (1) encode and cut; each task writes its own new chunks to segment files
and returns light rows; (2) one owner per chunk name; (3) compaction copies the
owned chunks from segments to packs, one task per segment; (4) recipes are joined
to packs, range-partitioned by doc_id and written.  Ids never pass through a
shuffle.  A file counts only if a committed row names it, so a lost or repeated
task leaves at most an orphan file.

Defined results: null text counts as empty text (one chunk: the end id); null
doc_ids come first; rows that share a doc_id each have a recipe, in the order of
a row number; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import io
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, delete, filesystem, new_dir, remembers, written

END_ID = 2
MIN_IDS, MASK_BITS, MAX_IDS, WINDOW_STEPS = 128, 9, 8192, (1, 2, 4, 8, 16)
SEGMENT_BYTES, RECIPE_IDS, READ_BYTES = 64 << 20, 8_000_000, 32 << 10
PACK_MAGIC, RECIPE_MAGIC = b"CASPACK1", b"CASRECI1"
CHUNK_SCHEMA = "row_no long, doc_id long, seq int, digest binary, n_ids int, seg string, off long, len int, fresh boolean"
PACK_SCHEMA = "digest binary, pack string, off long, len int"
FILE_SCHEMA = "path string, first_doc long, first_row long, n_docs long, n_ids long, root binary"
DOC = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("n_ids", "<u8"), ("crc", "<u4"), ("n_refs", "<u4")])
REF = np.dtype([("pack", "<u4"), ("off", "<u8"), ("len", "<u4"), ("n_ids", "<u4"), ("digest", "S32")])

#: Text of these characters alone can be cut into units: before white space that follows something else, and between a
#: letter and a character that is neither letter nor space.  Every pre-token of a byte-level tokenizer ends at both
#: places, so units can be encoded one by one and remembered.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
NOT_PLAIN = re.compile(rf"[^ -~\n{LETTERS}\u00a1-\u00a9\u00ab-\u00b9\u00bb-\u00bf\u2010-\u2027\u2030-\u205e\u20ac]")


@functools.lru_cache(1)
def kinds() -> np.ndarray:
    """0: space or line feed, 1: letter, 2: other; by the first byte of a character."""
    kind = np.full(256, 2, np.uint8)
    kind[[10, 32]] = 0
    kind[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 1
    return kind


def unit_starts(raw: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where units start in the UTF-8 bytes of plain texts that start at firsts."""
    kind = kinds()[raw]
    inner = np.flatnonzero((raw & 0xC0) == 0x80)
    for _ in range(2):  # a later byte is of its character's kind
        kind[inner] = kind[inner - 1]
    before, now = kind[:-1], kind[1:]
    is_start = np.zeros(len(raw), bool)
    np.logical_or((now == 0) & (before != 0), (now == 2) & (before == 1), out=is_start[1:])
    is_start[firsts] = True
    return np.flatnonzero(is_start)


class Seam(Exception):
    """A token reaches over the start of a unit: the texts must be encoded whole."""


class Encoder:
    """tokenizers' encoding of whole texts as little-endian 16-bit ids, with a bounded memory of units."""

    def __init__(self, path: str, most_units: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        if self.tok.get_vocab_size() > 1 << 16:
            raise ValueError("16-bit ids are too narrow for this vocabulary")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.n_bytes = np.zeros(1 << 16, np.int64)  # a byte-level vocabulary writes each byte as one character
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.n_bytes[i] = len(token)
        self.seen: dict[str, bytes] = {}
        self.most = most_units

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u2").tobytes() for e in found]

    def _units(self, units: list[str]) -> list[bytes]:
        """Units that start with white space, encoded as one text and cut where each one's bytes end."""
        ids = np.array(self.tok.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, dtype="<u2")
        ends = np.cumsum(self.n_bytes[ids])
        want = np.cumsum([len(u.encode()) for u in units])
        cut = np.searchsorted(ends, want)
        if not len(ends) or not np.array_equal(ends[cut], want):
            raise Seam
        raw, last, out = ids.tobytes(), 0, []
        for c in (2 * (cut + 1)).tolist():
            out.append(raw[last:c])
            last = c
        return out

    def _learn(self, units: list[str]) -> None:
        if len(self.seen) + len(units) > self.most:
            self.seen.clear()
        new = [u for u in units if u not in self.seen]
        spaced = [u for u in new if u[0] in " \n" and u[-1] not in " \n"]
        for i in range(0, len(spaced), 2000):
            part = spaced[i : i + 2000]
            self.seen.update(zip(part, self._units(part), strict=True))
        rest = [u for u in new if u not in self.seen]
        self.seen.update(zip(rest, self._plain(rest), strict=True))

    def _by_units(self, texts: list[str]) -> list[bytes]:
        """Encodings of texts that are plain and not empty."""
        coded = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        firsts = np.cumsum(sizes) - sizes
        starts = unit_starts(raw, firsts)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        names = units.dictionary.to_pylist()
        found = list(map(self.seen.get, names))
        if new := [u for u, x in zip(names, found, strict=True) if x is None]:
            self._learn(new)
            found = [self.seen[u] if x is None else x for u, x in zip(names, found, strict=True)]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 2
        index = units.indices.to_numpy()
        n = lengths[index]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(lengths) - lengths)[index] - (ends - n), n) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), "<u2")[at].tobytes()
        bounds = np.append((2 * (ends - n))[np.searchsorted(starts, firsts)], len(ids)).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(t) and not NOT_PLAIN.search(t) and not any(a in t for a in self.added) for t in texts]
        try:
            by_units = iter(self._by_units([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        except Seam:
            return self._plain(texts)
        whole = iter(self._plain([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(by_units if p else whole) for p in plain]


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(1)
def gear() -> np.ndarray:
    """A 32-bit number for each 16-bit id, by the splitmix64 rule."""
    x = (np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


def cuts(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
    """Chunk ends of each [start, end) of ids; they depend on the ids of that range alone."""
    h = gear()[ids]
    for s in WINDOW_STEPS:
        low = h[:-s] << np.uint32(s)
        h[s:] += low
    places = np.flatnonzero(h < np.uint32(1 << (32 - MASK_BITS))) + 1
    lo, hi = np.searchsorted(places, starts), np.searchsorted(places, ends)
    for start, end, a, b in zip(starts.tolist(), ends.tolist(), lo.tolist(), hi.tolist(), strict=True):
        out, last = [], start
        for p in [*places[a:b].tolist(), end]:
            while p - last > MAX_IDS:
                last += MAX_IDS
                out.append(last)
            if p == end or p - last >= MIN_IDS:
                if p > last:
                    out.append(p)
                last = p
        yield out


def sub_batches(batches: Iterable[pa.RecordBatch], chars: int = 8_000_000) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of a bounded number of characters; a longer text comes alone."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            t = t or ""
            if texts and size + len(t) > chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
        if texts:
            yield ids, texts


def _cutter(tokenizer: str, store: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, base = filesystem(store)
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u2").tobytes()
        remembers("token_store", enc.seen.clear)
        task, row, out, name, places = TaskContext.get().partitionId(), 0, None, "", {}
        for ids, texts in sub_batches(batches):
            coded = [x + end for x in enc.encode(texts)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 2
            ends = np.cumsum(sizes)
            stream = np.frombuffer(b"".join(coded), dtype="<u2")
            raw = memoryview(stream).cast("B")
            got: dict[str, list] = {k: [] for k in ("row_no", "doc_id", "seq", "digest", "n_ids", "seg", "off", "len", "fresh")}
            for doc, start, doc_cuts in zip(ids, (ends - sizes).tolist(), cuts(stream, ends - sizes, ends), strict=True):
                row_no, last = task << 33 | row, start
                row += 1
                for seq, p in enumerate(doc_cuts):
                    chunk = raw[2 * last : 2 * p]
                    digest = hashlib.sha256(chunk).digest()
                    fresh = digest not in places
                    if fresh:
                        if out is None or out.tell() > SEGMENT_BYTES:
                            if out:
                                out.close()
                            name, places = f"seg-{uuid.uuid4().hex}", {}
                            out = fs.open_output_stream(f"{base}/segments/{name}")
                        packed = press.compress(chunk)
                        places[digest] = (name, out.tell(), len(packed))
                        out.write(packed)
                    for k, v in zip(got, (row_no, doc, seq, digest, p - last, *places[digest], fresh), strict=True):
                        got[k].append(v)
                    last = p
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("digest", pa.binary()), ("n_ids", pa.int32()), ("seg", pa.string()), ("off", pa.int64()), ("len", pa.int32()), ("fresh", pa.bool_())]))
        if out:
            out.close()

    return run


def _compactor(store: str):
    """Owned chunks, sorted by segment and place, copied to one pack per segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(store)
        seg, src, out, name = None, None, None, ""
        for batch in batches:
            cols = batch.to_pydict()
            got = {"digest": cols["digest"], "pack": [], "off": [], "len": cols["len"]}
            run_at = run_end = 0  # what is to be copied in one piece
            for s, off, n in zip(cols["seg"], cols["off"], cols["len"], strict=True):
                if s != seg or off != run_end:
                    if run_end > run_at:
                        out.write(src.read_at(run_end - run_at, run_at))
                    if s != seg:
                        for f in (src, out):
                            if f:
                                f.close()
                        seg, name = s, f"pack-{uuid.uuid4().hex}"
                        src, out = fs.open_input_file(f"{base}/segments/{seg}"), fs.open_output_stream(f"{base}/packs/{name}")
                        out.write(PACK_MAGIC)
                    shift, run_at = out.tell() - off, off
                got["pack"].append(name)
                got["off"].append(off + shift)
                run_end = off + n
            if run_end > run_at:
                out.write(src.read_at(run_end - run_at, run_at))
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("digest", pa.binary()), ("pack", pa.string()), ("off", pa.int64()), ("len", pa.int32())]))
        for f in (src, out):
            if f:
                f.close()

    return run


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary tree over the leaves; a lone node moves up unchanged."""
    level = leaves or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def leaf(doc_id: int, no_id: int, digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"\0" + int(doc_id).to_bytes(8, "little", signed=True) + bytes([no_id]) + b"".join(digests)).digest()


class _Recipes:
    """One recipe file in the making."""

    def __init__(self):
        self.docs, self.refs, self.leaves, self.packs, self.n_ids = [], [], [], {}, 0

    def add(self, doc_id: int | None, rows: list[tuple]) -> None:
        no_id, n = int(doc_id is None), sum(r[0] for r in rows)
        for n_ids, digest, pack, off, size in rows:
            self.refs.append((self.packs.setdefault(pack, len(self.packs)), off, size, n_ids, digest))
        self.docs.append((doc_id or 0, no_id, n, 0, len(rows)))
        self.leaves.append(leaf(doc_id or 0, no_id, [r[1] for r in rows]))
        self.n_ids += n

    def save(self, fs, base: str, first: tuple) -> dict:
        root, buf = merkle(self.leaves), io.BytesIO()
        head = json.dumps({"docs": len(self.docs), "refs": len(self.refs), "packs": list(self.packs), "root": root.hex()}).encode()
        buf.write(RECIPE_MAGIC + len(head).to_bytes(4, "little") + head)
        buf.write(np.array(self.docs, dtype=DOC).tobytes())
        buf.write(np.array(self.refs, dtype=REF).tobytes())
        path = f"recipes/{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{base}/{path}") as f:
            f.write(buf.getbuffer())
        return {"path": path, "first_doc": first[0], "first_row": first[1], "n_docs": len(self.docs), "n_ids": self.n_ids, "root": root}


def _recipe_writer(store: str):
    schema = pa.schema([("path", pa.string()), ("first_doc", pa.int64()), ("first_row", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("root", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(store)
        files, now, first, key, rows = [], None, None, None, []
        for batch in batches:
            c = batch.to_pydict()
            for doc, row, *rest in zip(c["doc_id"], c["row_no"], c["n_ids"], c["digest"], c["pack"], c["off"], c["len"], strict=True):
                if (doc, row) != key:
                    if rows:
                        now.add(key[0], rows)
                    if now is None or now.n_ids >= RECIPE_IDS:
                        if now:
                            files.append(now.save(fs, base, first))
                        now, first = _Recipes(), (doc, row)
                    key, rows = (doc, row), []
                rows.append(tuple(rest))
        if rows:
            now.add(key[0], rows)
            files.append(now.save(fs, base, first))
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=schema)

    return run


def write_store(docs: DataFrame, tokenizer: str, store: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> str:
    """Write docs as a store; returns the hex root of the store. tokenizer: path of a tokenizers file, the same on all machines."""
    spark = docs.sparkSession
    arrow_rows(spark, 10_000)
    fs, base = filesystem(store)
    for d in ("segments", "packs", "recipes"):
        fs.create_dir(f"{base}/{d}", recursive=True)
    light = f"{store}/light"
    chunks = written(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_cutter(tokenizer, store, end_id), CHUNK_SCHEMA), "chunks", f"{light}/chunks")
    owners = chunks.where("fresh").groupBy("digest").agg(F.min(F.struct("seg", "off", "len")).alias("o")).select("digest", "o.*")
    packs = written(owners.repartition("seg").sortWithinPartitions("seg", "off").mapInArrow(_compactor(store), PACK_SCHEMA), "packs", f"{light}/packs")
    delete(spark, f"{store}/segments")
    recipes = chunks.select("doc_id", "row_no", "seq", "n_ids", "digest").join(packs, "digest").repartitionByRange("doc_id", "row_no").sortWithinPartitions("doc_id", "row_no", "seq")
    files = written(recipes.select("doc_id", "row_no", "n_ids", "digest", "pack", "off", "len").mapInArrow(_recipe_writer(store), FILE_SCHEMA), "files", f"{light}/files")
    start, listed = 0, []  # one entry for each recipe file of up to 8 million ids
    for r in files.orderBy("first_doc", "first_row").collect():
        listed.append({"path": r.path, "start": start, "n_docs": r.n_docs, "n_ids": r.n_ids, "root": bytes(r.root).hex()})
        start += r.n_ids
    root = merkle([bytes.fromhex(x["root"]) for x in listed]).hex()
    with fs.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps({"root": root, "end_id": end_id, "ids": start, "files": listed}).encode())
    delete(spark, light)
    return root


def _reader(store: str, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, base = filesystem(store)
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for path, start, root in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with fs.open_input_file(f"{base}/{path}") as f:
                    data = f.read()
                if data[:8] != RECIPE_MAGIC:
                    raise ValueError(f"{path}: not a recipe file")
                n = int.from_bytes(data[8:12], "little")
                head, at = json.loads(data[12 : 12 + n]), 12 + n
                docs = np.frombuffer(data, DOC, head["docs"], at)
                refs = np.frombuffer(data, REF, head["refs"], at + docs.nbytes)
                digests = [x.ljust(32, b"\0") for x in refs["digest"].tolist()]
                places = list(zip(refs["pack"].tolist(), refs["off"].tolist(), strict=True))
                sizes, counts = refs["len"].tolist(), refs["n_ids"].tolist()
                chunks: dict[tuple, bytes] = {}
                pack, src, seen, seen_at = -1, None, b"", 0
                for i in np.lexsort((refs["off"], refs["pack"])).tolist():
                    key = places[i]
                    if key in chunks:
                        continue
                    if key[0] != pack:
                        if src:
                            src.close()
                        pack, src, seen = key[0], fs.open_input_file(f"{base}/packs/{head['packs'][key[0]]}"), b""
                    at = key[1] - seen_at
                    if not seen or at + sizes[i] > len(seen):
                        seen, seen_at, at = src.read_at(max(READ_BYTES, sizes[i]), key[1]), key[1], 0
                    raw = unpress.decompress(seen[at : at + sizes[i]])
                    if hashlib.sha256(raw).digest() != digests[i] or len(raw) != 2 * counts[i]:
                        raise ValueError(f"{path}: a chunk of {head['packs'][key[0]]} at {key[1]} is damaged")
                    chunks[key] = raw
                if src:
                    src.close()
                got: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)}
                leaves, k = [], 0
                for doc, no_id, n_ids, _, m in docs.tolist():
                    ids = np.frombuffer(b"".join(chunks[p] for p in places[k : k + m]), "<u2").astype("<u4")
                    leaves.append(leaf(doc, no_id, digests[k : k + m]))
                    k += m
                    if len(ids) != n_ids:
                        raise ValueError(f"{path}: a document has {len(ids)} ids, not {n_ids}")
                    for c, v in zip(got, (None if no_id else doc, start, n_ids, zlib.crc32(ids.tobytes()), ids), strict=False):
                        got[c].append(v)
                    start += n_ids
                if merkle(leaves) != bytes.fromhex(root):
                    raise ValueError(f"{path}: the Merkle root differs from the manifest's")
                yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *[("ids", pa.list_(pa.int64()))] * with_ids]))

    return run


def read_store(spark: SparkSession, store: str, with_ids: bool = False) -> DataFrame:
    """Documents of a store, every hash verified: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    fs, base = filesystem(store)
    with fs.open_input_file(f"{base}/manifest.json") as f:
        m = json.loads(f.read())
    if merkle([bytes.fromhex(x["root"]) for x in m["files"]]).hex() != m["root"]:
        raise ValueError("the manifest's Merkle root is wrong")
    rows = [(x["path"], x["start"], x["root"]) for x in m["files"]]
    files = spark.createDataFrame(rows, "path string, start long, root string").repartition(max(1, len(rows)))
    return files.mapInArrow(_reader(store, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def encode_to_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write a new store in the shared folder and read it back."""
    store = new_dir(docs.sparkSession, "store")
    write_store(docs, tokenizer, store)
    return read_store(docs.sparkSession, store)
