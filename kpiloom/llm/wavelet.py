"""Token files: a wavelet matrix per shard.

A shard file holds the token ids of consecutive documents as a wavelet matrix: one bit-plane per bit of the largest id,
each in the order that the planes above it sort the ids into, with its number of zeros and a rank directory.  From the
one file, any token can be read, counted up to a place, and its occurrences found, without the ids being stored as such.

Layout: magic, length of the header, header (JSON: sizes and places of the blocks), then zstd-compressed blocks: document
ids, their null marks, their token counts, and for each plane the bits and its directory (ones before each 512 bits).

Writing: documents in order of their id are split into ranges, each task encodes its range in slices of 8 MB and writes a
file whenever enough tokens have gathered; a file appears under its name only when whole, and a task that is run again
writes the same bytes.  Reading: Spark hands out the files.  The memory of a task is that of one shard, set by
``tokens_per_shard`` (and by the longest single document).
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize, scratch_path
from kpiloom.llm.textbytes import SLICE_BYTES, Bytes, slices

MAGIC = b"WVMX0001"
BLOCK = 512
RUN = 1 << 15
TOKENS_PER_SHARD = 3_000_000
BYTES_PER_RANGE = 24 << 20
MAX_RANGES = 20_000                        # reducers and map outputs that a driver can keep track of
END = 0


def _ones(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of 512 bits, and at the end."""
    words = np.zeros(-(-len(bits) // 64) * 8, dtype=np.uint64)
    words.view(np.uint8)[: len(bits)] = bits
    per = np.bitwise_count(words).astype(np.uint32).reshape(-1, 8).sum(axis=1, dtype=np.uint32)
    return np.concatenate([np.zeros(1, np.uint32), np.cumsum(per, dtype=np.uint32)])


def _halves(one: np.ndarray):
    """Of each run of places (as many as a processor's cache holds): the run, and which of it are zeros and which ones."""
    for i in range(0, len(one), RUN):
        some = one[i: i + RUN]
        yield slice(i, i + RUN), np.flatnonzero(~some), np.flatnonzero(some)


class WaveletMatrix:
    """``n`` ids below 2 ** len(planes); plane 0 holds the highest bit."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        s = np.asarray(ids)
        s = s.astype(np.uint16 if not len(s) or int(s.max()) < 1 << 16 else np.uint32)
        bits = max(1, int(s.max()).bit_length()) if len(s) else 1
        planes, zeros, ranks = [], [], []
        for b in range(bits - 1, -1, -1):
            one = (s & s.dtype.type(1 << b)) != 0
            packed = np.packbits(one, bitorder="little")
            planes.append(packed)
            ranks.append(_ones(packed))
            zeros.append(len(s) - int(ranks[-1][-1]))
            down, i, j = np.empty_like(s), 0, zeros[-1]
            for at, low, high in _halves(one):
                down[i: i + len(low)] = s[at][low]
                down[j: j + len(high)] = s[at][high]
                i, j = i + len(low), j + len(high)
            s = down
        return cls(len(s), planes, zeros, ranks)

    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones of plane k before each place i."""
        i = np.asarray(i, dtype=np.int64)
        byte, block = i >> 3, i // BLOCK
        plane = np.concatenate([self.planes[k], np.zeros(BLOCK // 8 + 1, np.uint8)])
        out = self.ranks[k][block].astype(np.int64)
        start = block * (BLOCK // 8)
        for j in range(BLOCK // 8):
            at = start + j
            whole = np.where(at < byte, plane[at], 0) | np.where(at == byte, plane[at] & ((1 << (i & 7)) - 1).astype(np.uint8), 0)
            out += np.bitwise_count(whole.astype(np.uint8))
        return out

    def _bit(self, k: int, i: np.ndarray) -> np.ndarray:
        return (self.planes[k][i >> 3] >> (i & 7).astype(np.uint8)) & 1

    def access(self, places) -> np.ndarray:
        """The ids at ``places``."""
        i = np.asarray(places, dtype=np.int64).copy()
        out = np.zeros(len(i), dtype=np.int64)
        for k, z in enumerate(self.zeros):
            one = self._bit(k, i).astype(bool)
            r = self._rank1(k, i)
            out = out * 2 + one
            i = np.where(one, z + r, i - r)
        return out

    def _interval(self, token: int, i: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.planes):
            return 0, 0
        lo, hi = 0, i
        for k, z in enumerate(self.zeros):
            r = self._rank1(k, np.array([lo, hi]))
            if token >> (len(self.planes) - 1 - k) & 1:
                lo, hi = z + int(r[0]), z + int(r[1])
            else:
                lo, hi = lo - int(r[0]), hi - int(r[1])
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before place i."""
        lo, hi = self._interval(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def locate(self, token: int) -> np.ndarray:
        """All places of ``token``, ascending: its interval below the last plane, led back up by select."""
        lo, hi = self._interval(token, self.n)
        at = np.arange(lo, hi, dtype=np.int64)
        for k in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[k], bitorder="little")[: self.n]
            if token >> (len(self.planes) - 1 - k) & 1:
                at = np.flatnonzero(bits)[at - self.zeros[k]]
            else:
                at = np.flatnonzero(bits == 0)[at]
        return at

    def select(self, token: int, k: int) -> int:
        """Place of the occurrence number k (from 0) of ``token``; -1 if there are fewer."""
        at = self.locate(token)
        return int(at[k]) if 0 <= k < len(at) else -1

    def decode(self) -> np.ndarray:
        """All ids: the sort of each plane undone, lowest plane first."""
        x = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[k], bitorder="little")[: self.n].view(bool)
            x[self.zeros[k]:] |= x.dtype.type(1 << (len(self.planes) - 1 - k))
            up, i, j = np.empty_like(x), 0, self.zeros[k]
            for at, low, high in _halves(one):
                up[at][low] = x[i: i + len(low)]
                up[at][high] = x[j: j + len(high)]
                i, j = i + len(low), j + len(high)
            x = up
        return x


def to_bytes(wm: WaveletMatrix, doc_ids: list, counts: np.ndarray) -> bytes:
    import zstandard
    z = zstandard.ZstdCompressor(level=1, write_checksum=True)
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    raw = [ids.tobytes(), null.tobytes(), counts.astype("<i8").tobytes()]
    for p, r in zip(wm.planes, wm.ranks):
        raw += [p.tobytes(), r.astype("<u4").tobytes()]
    blocks = [z.compress(b) for b in raw]
    head = json.dumps({"n": wm.n, "docs": len(doc_ids), "zeros": wm.zeros, "blocks": [len(b) for b in blocks]}).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *blocks])


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """(matrix, document ids, token counts) of a shard file."""
    import zstandard
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    z = zstandard.ZstdDecompressor()
    n = struct.unpack("<Q", data[8:16])[0]
    head = json.loads(data[16: 16 + n])
    at, blocks = 16 + n, []
    for size in head["blocks"]:
        blocks.append(z.decompress(data[at: at + size]) if size else b"")
        at += size
    ids, null, counts = (np.frombuffer(b, dtype=t) for b, t in zip(blocks, ("<i8", np.uint8, "<i8")))
    planes = [np.frombuffer(b, dtype=np.uint8) for b in blocks[3::2]]
    ranks = [np.frombuffer(b, dtype="<u4") for b in blocks[4::2]]
    return WaveletMatrix(head["n"], planes, head["zeros"], ranks), [None if x else int(i) for i, x in zip(ids, null)], counts


def _put(folder: str, name: str, data: bytes) -> None:
    """Write a file to the shared folder; it gets its name when it is whole."""
    from pyarrow import fs
    where, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    where.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{TaskContext.get().taskAttemptId()}"
    with where.open_output_stream(attempt) as f:
        f.write(data)
    where.move(attempt, f"{path}/{name}")


_loaded: dict = {}          # of this Python worker: tokenizer file -> Pieces
CACHED = 400_000            # pieces kept from slice to slice
LONGEST = 64                # bytes of a piece that is kept
TOGETHER = 256              # pieces encoded as one text
BEFORE = b" x\n"            # a piece after which one that begins with a visible sign is cut off
# bytes a sign begins with that is never white space: visible ASCII, and U+00C0 to U+07FF
_OPENS = np.zeros(256, bool)
_OPENS[33:127] = True
_OPENS[0xC3:0xE0] = True
_LETTER, _STOPS = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOPS[list(b".,;:!?")] = True


_VISIBLE = frozenset(np.flatnonzero(_OPENS).tolist())


class Pieces:
    """A tokenizer and the pieces of text that it was given: their bytes, their ids and how often they came, as Arrow tables."""

    def __init__(self, tokenizer: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"            # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer)
        size = {i: len(token) for token, i in self.tokenizer.get_vocab().items()}      # a byte-level token has a sign a byte
        size |= {i: len(token.content.encode()) for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.n_bytes = np.zeros(max(size, default=0) + 1, np.int64)
        self.n_bytes[list(size)] = list(size.values())
        self.dtype = np.dtype(np.uint16 if len(self.n_bytes) <= 1 << 16 else np.uint32)
        self.pieces = self.ids = pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a list of pieces, and the borders of the pieces in them; each distinct new piece is encoded once."""
        known = len(self.pieces)
        both = pa.chunked_array([self.pieces, pieces]).dictionary_encode()             # the known ones come first, in their order
        code, self.pieces = both.chunk(both.num_chunks - 1).indices, both.chunk(both.num_chunks - 1).dictionary
        new = self._encode_new(self.pieces.slice(known).to_pylist())
        self.ids = pa.concat_arrays([self.ids, new])
        self.uses = np.bincount(code, minlength=len(self.pieces)) + np.append(self.uses, np.zeros(len(new), np.int64))
        out = self.ids.take(code)
        borders = np.frombuffer(out.buffers()[1], np.int64)[: len(out) + 1] // self.dtype.itemsize
        ids = np.frombuffer(out.buffers()[2], self.dtype, int(borders[-1])) if borders[-1] else np.zeros(0, self.dtype)
        self._forget()
        return ids, borders

    def _encode_new(self, pieces: list[bytes]) -> pa.Array:
        """The ids of each piece.  Pieces that the pre-tokenizer cuts off after any other, or after ``BEFORE``, are encoded many
        in one text, and told apart by the bytes of their tokens; the rest, or all if tokens do not spell the text, one by one."""
        parts, which, alone = [], [], []
        for k, p in enumerate(pieces):
            if p[0] == 32 and len(p) > 1 and p[1] in _VISIBLE:
                parts.append(p)
                which.append(k)
            elif p[0] in _VISIBLE:
                parts += (BEFORE, p)
                which += (-1, k)
            else:
                alone.append(k)
        first = list(range(0, len(parts), TOGETHER))
        batch = [e.ids for e in self._batch([b"".join(parts[i: i + TOGETHER]) for i in first])]
        ids = np.concatenate([np.zeros(0, np.int64), *batch]).astype(np.int64)
        ends = np.cumsum([0, *map(len, parts)])
        at = np.append(0, np.cumsum(self.n_bytes[ids]))
        cut = np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[cut] != ends).any() or (cut[first] != np.cumsum([0, *map(len, batch)])[:-1]).any():
            ids, cut, which, alone = ids[:0], cut[:1], [], list(range(len(pieces)))
        cut *= self.dtype.itemsize
        joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(which), [None, pa.py_buffer(cut), pa.py_buffer(ids.astype(self.dtype))])
        rest = pa.array([np.array(e.ids, self.dtype).tobytes() for e in self._batch([pieces[k] for k in alone])], pa.large_binary())
        place = np.empty(len(pieces), np.int64)
        at = np.flatnonzero(np.array(which, np.int64) >= 0)
        place[np.array(which, np.int64)[at]] = at
        place[alone] = len(which) + np.arange(len(alone))
        return pa.concat_arrays([joined, rest]).take(pa.array(place))

    def _batch(self, texts: list[bytes]) -> list:
        return self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)

    def _forget(self) -> None:
        """Drop long pieces and, when too many are known, the half that came least often of late."""
        keep = pc.binary_length(self.pieces).to_numpy() <= LONGEST
        if len(keep) > CACHED:
            keep[np.argsort(self.uses, kind="stable")[: len(keep) - CACHED // 2]] = False
            self.uses >>= 1
        if not keep.all():
            at = pa.array(np.flatnonzero(keep))
            self.pieces, self.ids, self.uses = self.pieces.take(at), self.ids.take(at), self.uses[keep]


def _encoder(tokenizer: str) -> Pieces:
    if tokenizer not in _loaded:
        _loaded.clear()
        _loaded[tokenizer] = Pieces(tokenizer)
    return _loaded[tokenizer]


def _pieces(b: Bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of the pieces of some documents, and the borders of the documents in the list of pieces.

    A piece begins with each document, at each blank before a sign that is surely visible, at a stop after a letter, and
    after a single line end between visible signs.  A byte-level pre-tokenizer always cuts there, so tokens never reach over,
    and a piece has the same tokens wherever it stands.
    """
    n = len(b.data)
    first = np.zeros(n + 1, bool)
    if n > 1:
        after = b.data[1:]
        opens = _OPENS[after]
        first[: n - 1] = (b.data[:-1] == 32) & opens
        first[b.at[1:-1] - 1] = False                             # the sign after it is another document's
        first[1:n] |= _LETTER[b.data[:-1]] & _STOPS[after]
        first[2:n] |= _OPENS[b.data[:-2]] & (b.data[1:-1] == 10) & opens[1:]
    first[b.at[:-1]] = True
    first[n] = False
    start = np.flatnonzero(first)
    return start, np.searchsorted(start, b.at)


def encode(texts: pa.Array, tokenizer: str):
    """Token ids of slices of texts: yields (ids, borders of the documents in them).

    Pieces repeat; each distinct one is encoded once, and those that come often are kept for later slices."""
    known = _encoder(tokenizer)
    for _, _, b in slices(texts, 8 * SLICE_BYTES):
        start, borders = _pieces(b)
        if not len(start):
            yield np.zeros(0, known.dtype), np.zeros(len(b) + 1, np.int64)
            continue
        where = [None, pa.py_buffer(np.append(start, len(b.data))), pa.py_buffer(np.ascontiguousarray(b.data))]
        ids, at = known.encode(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), where))
        yield ids, at[borders]


def _writer(folder: str, tokenizer: str, end: int, per_shard: int):
    def write(batches):
        part, shard = TaskContext.get().partitionId(), 0
        ids, docs, counts, held = [], [], [], 0
        mark = np.array([end], np.uint16 if end < 1 << 16 else np.uint32)

        def flush():
            nonlocal ids, docs, counts, held, shard
            name = f"shard-{part:07d}-{shard:05d}.wvm"
            _put(folder, name, to_bytes(WaveletMatrix.build(np.concatenate(ids)), docs, np.array(counts)))
            row = pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "file": [name], "n_ids": [held], "n_docs": [len(docs)]}, schema=META)
            ids, docs, counts, held, shard = [], [], [], 0, shard + 1
            return row

        for b in batches:
            names = iter(b.column(0).to_pylist())
            for some, borders in encode(b.column(1), tokenizer):
                at = borders.tolist()
                for i, j in zip(at, at[1:]):
                    ids += [some[i:j], mark]                       # the end id after each document
                    counts.append(j - i + 1)
                    docs.append(next(names))
                    held += j - i + 1
                    if held >= per_shard:
                        yield flush()
        if docs:
            yield flush()

    return write


META = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("file", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())])


def write(docs: DataFrame, folder: str, tokenizer: str, id_name: str = "doc_id", text: str = "text", end: int = END,
          per_shard: int = TOKENS_PER_SHARD, per_range: int = BYTES_PER_RANGE) -> DataFrame:
    """Write ``docs`` in order of their id (null first, equal ids by text) to shard files; returns the list of files with
    ``start``, the number of ids before each, which is also kept beside the folder (``-index``), so that any session can
    :func:`read` it.  Null texts are empty; other columns are ignored."""
    d = docs.select(F.col(f"`{id_name}`").cast("long").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    total = d.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    ranges = min(MAX_RANGES, max(1, -(-total // per_range)))      # beyond it ranges grow; a task begins a new shard as often as needed
    meta = (d.repartitionByRange(ranges, "_id").sortWithinPartitions("_id", "_text")
            .mapInArrow(_writer(folder, tokenizer, end, per_shard), "part long, shard long, file string, n_ids long, n_docs long"))
    meta = materialize(meta, "token-files")          # the files are written here, once
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)    # a row per file
    index = f"{folder.rstrip('/')}-index"
    meta.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(index)
    return docs.sparkSession.read.parquet(index)


def _read(batches):
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            wm, docs, counts = from_bytes(content.as_py())
            ids = wm.decode().astype("<u4")
            ends = np.cumsum(counts)
            crc = [zlib.crc32(ids[e - c: e].tobytes()) for e, c in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path.rsplit("/", 1)[-1]] * len(docs), pa.string()), pa.array(docs, pa.int64()), pa.array(ends - counts, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["file", "doc_id", "at", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str, id_name: str = "doc_id") -> DataFrame:
    """One row per document in the files: id, start, n_tokens (with the end id), ids_crc32, file."""
    files = spark.read.parquet(f"{folder.rstrip('/')}-index")
    if not files.head(1):
        return spark.createDataFrame([], f"`{id_name}` long, start long, n_tokens long, ids_crc32 long, file string")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("path", "content")
    rows = raw.mapInArrow(_read, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(files.select("file", "start"), "file").select(
        F.col("doc_id").alias(id_name), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "file")


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def write_and_read(docs: DataFrame, tokenizer: str | None = None, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and return what reading them gives, a row per document.

    Null and empty texts hold the end id only; equal ids and repeated rows are documents of their own; an empty table
    writes no file and gives no rows.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    write(docs, folder, tokenizer or default_tokenizer(), id_name, text)
    return read(docs.sparkSession, folder, id_name)
