"""Token ids of a corpus, entropy-coded with static asymmetric numeral systems (rANS).

``encode`` tokenizes every whole text, counts all ids of the corpus into one shared
frequency table, sorts documents by id and writes frames; ``decode`` reads them back.

File format: a folder with two Parquet tables.

* ``table``: ``id, freq`` of every id that occurs; frequencies add up to 2**20.
* ``frames``: one row per frame, ``part`` and ``frame`` ascending with ``doc_id``, ``n_tokens``,
  ``doc_ids`` and ``lengths`` (whole documents, in order), and ``data``.

``data``, little-endian: ``RNS1``, the crc32 of the table (u32), lanes (u16), number of
blocks (u32), then a checkpoint per block:
first token in the frame (u64), first word (u64), crc32 of the block's ids as u32 values
(u32); then the lanes' states (u64) block by block, then the words (u32), then the crc32
of all that (u32). A block holds ``BLOCK`` ids, dealt to ``LANES`` interleaved coders in
turn, and depends on no other block: a reader may start at any checkpoint, and all
blocks of a frame are coded side by side as one array.
"""

from __future__ import annotations

import codecs
import gc
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import tasks_of
from marlstone.session import bounded_batches, shared_folder, staged

END_ID = 1
BITS, LOW = 20, np.uint64(1 << 31)  # frequencies add up to 2**BITS; states lie in [LOW, LOW * 2**32)
LANES, BLOCK = 128, 32768
FRAME_TOKENS = 16 * BLOCK
CACHED_WORDS = 300_000  # pieces of a generation
AT_ONCE = 1024  # texts a worker holds the words and ids of
ID = attrgetter("id")
HEAD, CHECKPOINT = "<4sIHI", np.dtype([("token", "<u8"), ("word", "<u8"), ("crc", "<u4")])

# How the tokenizer file cuts text into pieces, each coded by itself: in the characters below
# this pattern finds what the file's own (letters, single digits, the rest) finds.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\d|[^\p{L}\d\s]+"
# Texts with other characters, or with the name of a special token, go through the library whole.
OTHER, SPECIAL = r"[^\t\n\r -~¡-±´-¸º»¿-įı-ɏ]", r"<\|(?:start|end)oftext\|>"


class Generation(dict):
    """The ids of strings by string; one that is new comes from the generation before, or is coded."""

    def __init__(self, code, before: dict[str, bytes]):
        self.code, self.before = code, before

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        self[key] = found = self.code(key) if found is None else found
        return found


class Cache:
    """The ids of strings that were coded lately: what one generation did not ask for goes with the next."""

    def __init__(self, code):
        self.code = code
        self.old: dict[str, bytes] = {}
        self.young = Generation(code, self.old)

    def get(self, key: str) -> bytes:
        return self.young[key]

    def each(self, keys: Iterable[str]) -> list[bytes]:
        """The ids of every key. Generations change between calls only, so ``code`` may ask for parts of a key by ``get``."""
        if len(self.young) > CACHED_WORDS:
            self.old, self.young.before = self.young, {}
            self.young = Generation(self.code, self.old)
        return list(map(self.young.__getitem__, keys))

    def join(self, keys: Iterable[str]) -> bytes:
        return b"".join(self.each(keys))


class Encoder:
    """Ids of whole texts by a tokenizer file; pieces that were coded before come from a bounded cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Byte-level models name a byte by a visible character: itself, or the next one from 256 on.
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
        shown = {b: 256 + i for i, b in enumerate(hidden)}
        self.shown = "".join(chr(shown.get(b, b)) for b in range(256))
        self.tokens = self.tokenizer.model.tokenize
        self.coded = Cache(self._piece)

    def _bytes(self, encoding) -> bytes:
        return array(self.type.char, encoding.ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else codecs.charmap_decode(piece.encode(), "strict", self.shown)[0]
        return array(self.type.char, list(map(ID, self.tokens(shown)))).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian values of ``self.type``, without the end id."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of every text. A word is cut into pieces, and a piece looked up, once for all texts."""
        whole = pc.match_substring_regex(texts, f"{OTHER}|{SPECIAL}").to_pylist()
        known = [t or "" for t in texts.to_pylist()]
        words, said = _distinct(pa.array(["" if w else t.lower() for t, w in zip(known, whole)], pa.large_string()))
        mixed = pc.match_substring_regex(said.dictionary, r"\P{L}")  # words of letters are pieces, and no piece holds a blank
        apart = pc.replace_substring_regex(said.dictionary.filter(mixed), PIECE, r"\0 ")
        pieces, held = _distinct(pc.replace_with_mask(said.dictionary, mixed, apart))
        coded = self.coded.each(held.dictionary.to_numpy(zero_copy_only=False))
        ends = np.cumsum(np.fromiter(map(len, [b"", *coded]), np.int64)) // self.type.itemsize
        ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), self.type)))
        ids = _joined(_joined(ids, held.indices, pieces), said.indices, words)
        flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
        return [self._bytes(self.tokenizer.encode(t, add_special_tokens=False)) if w else flat[a:b].tobytes()
                for t, w, a, b in zip(known, whole, at, at[1:])]


def _distinct(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Where the strings between the blanks of each text begin among all of them, and these strings."""
    cut = pc.ascii_split_whitespace(texts)
    return cut.offsets.to_numpy(), cut.flatten().dictionary_encode()


def _joined(ids: pa.LargeListArray, places: pa.Array, begin: np.ndarray) -> pa.LargeListArray:
    """The ids at ``places``, those from one of ``begin`` to the next as one list."""
    taken = ids.take(places)
    return pa.LargeListArray.from_arrays(pa.array(taken.offsets.to_numpy()[begin]), taken.flatten())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker, whose caches serve the tasks that follow."""
    return Encoder(path)


@dataclass
class Table:
    """The shared frequencies. ``freq`` and ``start`` are indexed by id."""

    freq: np.ndarray
    start: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        """Counts scaled to add up to 2**BITS, every id that occurs at least 1."""
        counts = np.asarray(counts, dtype=np.float64)
        total, room = counts.sum(), 1 << BITS
        if (counts > 0).sum() > room:
            raise ValueError(f"more than {room} different ids")
        freq = np.where(counts > 0, np.maximum(1, np.floor(counts * (room / max(total, 1)))), 0).astype(np.int64)
        while (rest := room - int(freq.sum())) and total:
            order = np.argsort(-freq, kind="stable")
            for i in order[: max(1, len(order) // 8)]:  # the most frequent ids give or take a little each
                step = int(np.sign(rest)) * min(abs(rest), max(1, int(freq[i]) // 8))
                if freq[i] + step >= 1:
                    freq[i] += step
                    rest -= step
                if not rest:
                    break
        return cls.of_freq(freq)

    @classmethod
    def of_freq(cls, freq: np.ndarray) -> Table:
        freq = np.asarray(freq, dtype=np.uint64)
        return cls(freq, np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64))

    @property
    def crc(self) -> int:
        return zlib.crc32(np.trim_zeros(self.freq, "b").astype("<u4").tobytes())

    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def _shape(n: int) -> tuple[int, int, np.ndarray]:
    """Blocks, steps of the longest block, ids of each block."""
    sizes = np.full(max(1, -(-n // BLOCK)), BLOCK, dtype=np.int64)
    sizes[-1] = n - BLOCK * (len(sizes) - 1)
    return len(sizes), -(-int(sizes.max()) // LANES), sizes


def pack(ids: np.ndarray, table: Table) -> bytes:
    """One frame of ids."""
    blocks, steps, sizes = _shape(len(ids))
    grid = np.full(blocks * BLOCK, ids[0] if len(ids) else 0, dtype=np.int64)
    grid[: len(ids)] = ids
    crcs = [zlib.crc32(ids[b * BLOCK:(b + 1) * BLOCK].astype("<u4").tobytes()) for b in range(blocks)]
    grid = grid.reshape(blocks, BLOCK // LANES, LANES)
    freq, start = table.freq[grid[:, :steps]], table.start[grid[:, :steps]]
    lane, state = np.arange(LANES), np.full((blocks, LANES), LOW, dtype=np.uint64)
    out, owner = [], []
    for s in range(steps - 1, -1, -1):
        f, live = freq[:, s], (s * LANES + lane)[None, :] < sizes[:, None]
        full = live & (state >= f << np.uint64(63 - BITS))
        out.append((state[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        owner.append(np.nonzero(full)[0])
        state = np.where(full, state >> np.uint64(32), state)
        high, low = np.divmod(state, np.maximum(f, 1))
        state = np.where(live, (high << np.uint64(BITS)) + low + start[:, s], state)
    words = np.concatenate([*out[::-1], np.zeros(0, "<u4")])
    owner = np.concatenate([*owner[::-1], np.zeros(0, np.int64)]).astype(np.int64)
    words = words[np.argsort(owner, kind="stable")]
    marks = np.zeros(blocks, CHECKPOINT)
    marks["token"] = np.arange(blocks) * BLOCK
    marks["word"] = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=blocks))[:-1]])
    marks["crc"] = crcs
    body = b"".join([struct.pack(HEAD, b"RNS1", table.crc, LANES, blocks), marks.tobytes(), state.astype("<u8").tobytes(),
                     words.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(data: bytes, n: int, table: Table, symbols: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a frame of ``n``, or of its blocks ``first`` to ``last`` only (from their checkpoints)."""
    magic, crc, lanes, blocks = struct.unpack_from(HEAD, data)
    if magic != b"RNS1" or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("a frame is damaged")
    if crc != table.crc:
        raise ValueError("a frame was written with another frequency table")
    marks = np.frombuffer(data, CHECKPOINT, blocks, struct.calcsize(HEAD))
    at = struct.calcsize(HEAD) + marks.nbytes
    state = np.frombuffer(data, "<u8", blocks * lanes, at).reshape(blocks, lanes).astype(np.uint64)
    words = np.frombuffer(data[at + blocks * lanes * 8:-4], "<u4").astype(np.uint64)
    _, _, sizes = _shape(n)
    chosen = slice(first, blocks if last is None else last)
    state, sizes, marks = state[chosen].copy(), sizes[chosen], marks[chosen]
    at, steps = marks["word"].astype(np.int64), -(-int(sizes.max()) // lanes)
    grid, lane = np.zeros((len(sizes), max(steps, 1), lanes), dtype=np.uint32), np.arange(lanes)
    mask = np.uint64((1 << BITS) - 1)
    for s in range(steps):
        live = (s * lanes + lane)[None, :] < sizes[:, None]
        slot = state & mask
        found = symbols[slot]
        grid[:, s] = found
        moved = table.freq[found] * (state >> np.uint64(BITS)) + slot - table.start[found]
        state = np.where(live, moved, state)
        low = live & (state < LOW)
        places = at[:, None] + np.cumsum(low, axis=1) - 1
        state[low] = state[low] << np.uint64(32) | words[places[low]]
        at = at + low.sum(axis=1)
    parts = [g.reshape(-1)[:k] for g, k in zip(grid, sizes)]
    for part, mark in zip(parts, marks):
        if zlib.crc32(part.astype("<u4").tobytes()) != mark["crc"]:
            raise ValueError("ids of a block do not match their checksum")
    return np.concatenate(parts)


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n_tokens, crc, ids, counts``: a row for every document, and one row for each task.

    ``ids`` is zstandard over fixed-width values, the end id last. The row of a task has
    ``counts`` only: how often it met each id of the vocabulary, as longs.
    """
    bounded_batches(docs.sparkSession)
    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("crc", "long").add("ids", "binary").add("counts", "binary")
    names = schema.names

    def run(parts):
        import zstandard

        own = encoder(tokenizer)
        squeeze = zstandard.ZstdCompressor(1)
        end = np.array([end_id], dtype=own.type).tobytes()
        counts, id_type = np.zeros(vocabulary(own, end_id), dtype="<i8"), None
        for part in parts:
            id_type = part.column(0).type
            for at in range(0, part.num_rows, AT_ONCE):
                some = part.slice(at, AT_ONCE)
                gc.disable()  # strings and bytes have no cycles, and looking for them takes a fifth of the time
                try:
                    raw = [r + end for r in own.encode_all(some.column(1))]
                finally:
                    gc.enable()
                counts += np.bincount(np.frombuffer(b"".join(raw), own.type), minlength=len(counts))
                crcs = [zlib.crc32(np.frombuffer(r, own.type).astype("<u4").tobytes()) for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(r) // own.type.itemsize for r in raw], pa.int64()),
                     pa.array(crcs, pa.int64()), pa.array(list(map(squeeze.compress, raw)), pa.binary()), pa.nulls(len(raw), pa.binary())],
                    names=names)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                              pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _plain(packed: bytes, kind: np.dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def vocabulary(own: Encoder, end_id: int) -> int:
    return max(own.tokenizer.get_vocab_size(), end_id + 1)


def described(spark, tokenizer: str, end_id: int) -> tuple[np.dtype, int]:
    """The type of an id and the size of the vocabulary, asked of an executor: the driver never loads the tokenizer."""
    def run(parts):
        for part in parts:
            own = encoder(tokenizer)
            yield pa.record_batch([pa.array([own.type.str]), pa.array([vocabulary(own, end_id)])], names=["kind", "size"])

    kind, size = spark.range(0, 1, 1, 1).mapInArrow(run, "kind string, size long").first()
    return np.dtype(kind), size


def count_ids(ids: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in the corpus, from the ``counts`` of the tasks that coded it. What
    reaches the driver is one number per entry of the vocabulary."""
    def run(parts):
        counts = np.zeros(size, dtype=np.int64)
        for part in parts:
            for own in part.column(0):
                counts += np.frombuffer(own.as_py(), "<i8")
        seen = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    counts = np.zeros(size, dtype=np.int64)
    for row in ids.where("counts is not null").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    return counts


def encode(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of all ``docs`` (``doc_id``, ``text``) to ``folder`` in ascending ``doc_id`` order.

    A null text is empty and becomes the end id alone; null ids come first; rows
    alike are written as often as they occur; other columns are ignored. Documents
    are dealt into ranges of ids, so no task sorts more than its range.
    """
    kind, size = described(docs.sparkSession, tokenizer, end_id)
    ids = staged(token_ids(docs, tokenizer, end_id), compression="uncompressed")
    table = Table.of_counts(count_ids(ids, size))
    ids = ids.where("counts is null").drop("counts")
    spark = docs.sparkSession
    seen = np.nonzero(table.freq)[0]
    spark.createDataFrame([(int(i), int(table.freq[i])) for i in seen], "id int, freq int").coalesce(1).write.parquet(
        f"{folder}/table")
    freq = table.freq.astype(np.int32)

    def run(parts):
        shared, held, frame, part_id = Table.of_freq(freq), [], 0, None

        def flush():
            whole = np.concatenate([h[1] for h in held])
            row = [[part_id], [frame], [len(whole)], [[h[0] for h in held]], [[len(h[1]) for h in held]], [pack(whole, shared)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                                                      pa.list_(pa.int64()), pa.binary()))],
                names=["part", "frame", "n_tokens", "doc_ids", "lengths", "data"])

        tokens = 0
        for part in parts:
            for doc, packed, at in zip(*part.columns):
                part_id = at.as_py()
                held.append((doc.as_py(), _plain(packed.as_py(), kind)))
                tokens += len(held[-1][1])
                if tokens >= FRAME_TOKENS:
                    yield flush()
                    held, frame, tokens = [], frame + 1, 0
        if held:
            yield flush()

    ranged = ids.repartitionByRange(tasks_of(ids), "doc_id", "crc", "n_tokens").sortWithinPartitions("doc_id", "crc", "n_tokens")
    frames = ranged.select("doc_id", "ids", F.spark_partition_id().alias("part")).mapInArrow(
        run, "part int, frame int, n_tokens long, doc_ids array<long>, lengths array<long>, data binary")
    frames.write.option("compression", "uncompressed").parquet(f"{folder}/frames")


def decode(spark, folder: str) -> DataFrame:
    """What the files hold, one row per document: ``doc_id, start, n_tokens, ids_crc32, ids``.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian
    unsigned 32-bit values. Every frame and block is checked against its checksum.
    """
    frames = spark.read.parquet(f"{folder}/frames")
    table = spark.read.parquet(f"{folder}/table").collect()  # at most one row per entry of the vocabulary
    freq = np.zeros(max((r.id for r in table), default=0) + 1, dtype=np.int32)
    for r in table:
        freq[r.id] = r.freq

    def run(parts):
        shared = Table.of_freq(freq)
        symbols = shared.symbols()
        for part in parts:
            for p, frame, n, docs, lengths, data in zip(*part.columns):
                ids = unpack(data.as_py(), n.as_py(), shared, symbols).astype("<u4")
                sizes = np.array(lengths.as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                pieces = [ids[e - s:e].tobytes() for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.as_py()] * len(sizes), pa.int32()), pa.array([frame.as_py()] * len(sizes), pa.int32()),
                     docs.values, pa.array(ends - sizes), pa.array(sizes),
                     pa.array(list(map(zlib.crc32, pieces)), pa.int64()), pa.array(pieces, pa.binary())],
                    names=["part", "frame", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"])

    rows = frames.select("part", "frame", "n_tokens", "doc_ids", "lengths", "data").mapInArrow(
        run, "part int, frame int, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary")
    by_part = frames.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = by_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("from"))  # one row per range
    within = Window.partitionBy("part").orderBy("frame")
    starts = frames.select("part", "frame", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("offset"))
    starts = starts.join(parts, "part").select("part", "frame", (F.col("from") + F.col("offset")).alias("before"))
    return rows.join(starts, ["part", "frame"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``encode`` to a new folder under the shared one, then the digest of ``decode``, without the ids."""
    folder = f"{shared_folder(docs.sparkSession)}/token-files/{uuid.uuid4().hex}"
    encode(docs, folder, tokenizer, end_id)
    return decode(docs.sparkSession, folder).drop("ids")
