"""Token ids in a binary format of shuffled planes, written and read back by Spark.

A container holds the ids of consecutive documents. Its ids are cut into blocks of BLOCK_IDS; each block is transposed
into byte planes (or bit planes), and each plane is compressed with zstandard on its own. A chunk index at the end has
the place of every plane, so a range of ids is read without the rest.

    "BPS1" | planes | index: (offset u64, size u32) per plane | n_ids u64, block_ids u32, planes u8, 3 spare bytes | index size u64
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityflow.llm.common import id_and_text, id_type, per_process, steps, tokenizer
from entityflow.session import settle

MAGIC = b"BPS1"
BLOCK_IDS = 1 << 16
CONTAINER_IDS = 1 << 20
ZSTD_LEVEL = 3
INDEX = np.dtype([("offset", "<u8"), ("size", "<u4")])
FOOT = np.dtype([("n_ids", "<u8"), ("block_ids", "<u4"), ("planes", "u1"), ("spare", "u1", 3), ("index_size", "<u8")])
BYTE_PLANES, BIT_PLANES = 4, 32


def to_planes(block: np.ndarray, planes: int) -> list[bytes]:
    by_byte = np.ascontiguousarray(block.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == BYTE_PLANES:
        return [p.tobytes() for p in by_byte]
    return [np.packbits(p >> bit & 1, bitorder="little").tobytes() for p in by_byte for bit in range(8)]


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    if len(parts) == BYTE_PLANES:
        by_byte = np.stack([np.frombuffer(p, np.uint8) for p in parts])
    else:
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts]
        by_byte = np.stack([sum(bits[8 * k + i] << np.uint8(i) for i in range(8)) for k in range(4)]).astype(np.uint8)
    return np.ascontiguousarray(by_byte.T).view("<u4").ravel()


def pack(ids: np.ndarray, planes: int = BYTE_PLANES, block_ids: int = BLOCK_IDS) -> bytes:
    press = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
    parts, entries, at = [MAGIC], [], len(MAGIC)
    for k in range(0, len(ids), block_ids):
        for plane in to_planes(ids[k:k + block_ids], planes):
            parts.append(press.compress(plane))
            entries.append((at, len(parts[-1])))
            at += len(parts[-1])
    index = np.array(entries, INDEX).tobytes()
    foot = np.array([(len(ids), block_ids, planes, 0, len(index))], FOOT)
    return b"".join([*parts, index, foot.tobytes()])


def unpack(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids from ``start`` to ``stop``; only their blocks are decompressed."""
    foot = np.frombuffer(data[-FOOT.itemsize:], FOOT)[0]
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token container")
    n, size, planes = int(foot["n_ids"]), int(foot["block_ids"]), int(foot["planes"])
    end = len(data) - FOOT.itemsize
    index = np.frombuffer(data[end - int(foot["index_size"]):end], INDEX).reshape(-1, planes)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, "<u4")
    expand = zstandard.ZstdDecompressor()
    blocks = range(start // size, -(-stop // size))
    ids = [from_planes([expand.decompress(data[int(e["offset"]):int(e["offset"]) + int(e["size"])]) for e in index[b]],
                       min(size, n - b * size)) for b in blocks]
    first = blocks[0] * size
    return np.concatenate(ids)[start - first:stop - first]


# Letters that stay letters, one for one, when they are composed and put in lower case.
SAFE = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"
# A word of such letters with full stops and commas behind it.
SAFE_WORD = f"^[{SAFE}]+[.,]*$"


class Encoder:
    """Ids of whole text columns. Texts are cut at ASCII separators, which no token crosses; each distinct word is encoded by the
    library once and then looked up. Words of SAFE letters are read in lower case, as the tokenizer does, apart from the full
    stops and commas behind them, with which they never merge; all others as they are written."""

    PARTS = 400_000
    LONGEST = 64
    TOGETHER = 256  # words that the library encodes as one text

    def __init__(self, path: str):
        self.library = tokenizer(path)
        ends = {i for token, i in self.library.get_vocab().items() if token.endswith("</w>")}
        self.ends = np.isin(np.arange(self.library.get_vocab_size()), list(ends))
        self.reset()

    def reset(self):
        self.place: dict[str, int] = {"": 0}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def coded(self, parts: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts, and their number per part; ``words`` are runs of letters in lower case."""
        if words:
            # One text for many words: each ends with the only token that says so.
            texts = [" ".join(parts[k:k + self.TOGETHER]) for k in range(0, len(parts), self.TOGETHER)]
            flat = np.fromiter(chain.from_iterable(e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)), np.uint32)
            ends = np.flatnonzero(self.ends[flat]) + 1
            if len(ends) == len(parts) and ends[-1] == len(flat):
                return flat, np.diff(ends, prepend=0)
        found = [e.ids for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def places(self, parts: list[str], words: bool = False) -> np.ndarray:
        """Where each part's ids are; new parts are encoded first."""
        new = [p for p in parts if p not in self.place]
        if new:
            flat, sizes = self.coded(new, words)
            self.place.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, flat])
        found = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
        for p in new:
            if len(p) > self.LONGEST:
                del self.place[p]
        return found

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids per text, each with ``end_id`` at its end."""
        if len(self.starts) > self.PARTS or len(self.ids) > 8 * self.PARTS:
            self.reset()
        words = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.string()), ""))
        bounds = np.asarray(words.offsets, np.int64)
        coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        # Per distinct word: the place of the word itself, and of what follows its letters.
        core_at, tail_at = (np.zeros(len(coded.dictionary), np.int64) for _ in range(2))
        safe = pc.match_substring_regex(coded.dictionary, SAFE_WORD)
        is_safe = np.asarray(safe)
        if is_safe.any():
            mine = coded.dictionary.filter(safe)
            core = pc.utf8_rtrim(mine, characters=".,")
            rest = np.asarray(pc.subtract(pc.binary_length(mine), pc.binary_length(core)), np.int64)
            core = pc.utf8_lower(core).dictionary_encode()
            core_at[is_safe] = self.places(core.dictionary.to_pylist(), words=True)[np.asarray(core.indices, np.int64)]
            with_tail = np.flatnonzero(rest)
            if len(with_tail):
                names = mine.take(pa.array(with_tail)).to_pylist()
                tail_at[np.flatnonzero(is_safe)[with_tail]] = self.places([w[-int(n):] for w, n in zip(names, rest[with_tail])])
        if not is_safe.all():
            core_at[~is_safe] = self.places(coded.dictionary.filter(pc.invert(safe)).to_pylist())
        size_of, start_of = np.append(self.sizes, 1), np.append(self.starts, len(self.ids))
        index = np.asarray(coded.indices, np.int64)
        # Pieces in order: each word, its tail if there is one, and the end of each text.
        tailed = (tail_at > 0)[index]
        n_pieces = 1 + tailed
        before = np.concatenate([[0], np.cumsum(n_pieces)])
        piece_bounds = before[bounds - bounds[0]] + np.arange(len(bounds))  # where each text's pieces begin
        text_of = np.repeat(np.arange(len(column)), np.diff(bounds))
        at = before[:-1] + text_of
        seq = np.empty(len(index) + int(tailed.sum()) + len(column), np.int64)
        seq[at] = core_at[index]
        seq[at[tailed] + 1] = tail_at[index[tailed]]
        seq[piece_bounds[1:] - 1] = len(self.sizes)
        sizes = size_of[seq]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        out = np.append(self.ids, np.uint32(end_id))[np.repeat(start_of[seq] - ends + sizes, sizes) + np.arange(total)]
        return out, np.diff(np.concatenate([[0], ends[piece_bounds[1:] - 1]]))


def _containers(path: str, end_id: int, planes: int):
    """Ordered (id, text) rows -> containers of this partition, numbered in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("encoder", path), lambda: Encoder(path))
        part, number = TaskContext.get().partitionId(), 0
        ids, keys, sizes = [], [], []

        def container():
            key = pa.concat_arrays(keys)
            n = np.concatenate(sizes)
            flat = np.concatenate(ids)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), v) for v in (key, pa.array(n))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(flat)]), *lists, pa.array([pack(flat, planes)], pa.binary())],
                ["part", "number", "n_ids", "ids", "sizes", "data"])

        for batch in steps(batches, keep=True):
            out, n = encoder.encode(batch.column(1), end_id)
            ids.append(out), keys.append(batch.column(0)), sizes.append(n)
            if sum(map(len, ids)) >= CONTAINER_IDS:
                yield container()
                ids, keys, sizes, number = [], [], [], number + 1
        if ids:
            yield container()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, id_col: str = "doc_id", text_col: str = "text",
                 planes: int = BYTE_PLANES) -> None:
    """Encode every text and write the containers below ``path`` in ascending order of the id.

    Null texts are empty and hold the end id alone. Rows that share an id follow each other in the order of their
    texts' hash and text; null ids come first. The files are Parquet rows of one container each, so any store
    that Spark writes can hold them; ``data`` is the container. A partition numbers its containers, partitions follow
    the order of the ids, and a task that runs again writes the same containers.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    kind = id_type(docs, id_col)
    schema = f"part int, number int, n_ids long, ids array<{kind}>, sizes array<long>, data binary"
    rows.mapInArrow(_containers(tokenizer_path, end_id, planes), schema).write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            keys, sizes = row.column(2).flatten(), np.asarray(row.column(3).flatten())
            ids = unpack(row.column(4)[0].as_py()).astype("<u4")
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.full(n, row.column(0)[0].as_py(), np.int32)), pa.array(np.full(n, row.column(1)[0].as_py(), np.int32)),
                 pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                ["id", "part", "number", "offset", "n_tokens", "crc32"])


def read_tokens(spark, path: str) -> DataFrame:
    """(id, start, n_tokens, crc32) of every document, read back from the containers below ``path``.

    ``start`` is the number of ids of all documents before it. Container sizes add up in two steps, per partition and
    within each, and join the documents' narrow rows, so no container moves.
    """
    table = spark.read.parquet(path)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    heads = table.select("part", "number", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = settle(heads.withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
                    .select("part", "number", (F.col("base") + F.col("inner")).alias("first")), "container-starts")
    kind = table.schema["ids"].dataType.elementType.simpleString()
    rows = table.select("part", "number", "ids", "sizes", "data").mapInArrow(
        _documents, f"id {kind}, part int, number int, offset long, n_tokens long, crc32 long")
    return rows.join(starts, ["part", "number"]).select("id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "crc32")
