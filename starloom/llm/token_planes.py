"""Token ids on disk as compressed bit or byte planes.

A chunk holds the ids of whole documents, one after the other, in blocks of a fixed
number of ids. Each block is transposed: the lowest bits (or bytes) of all its ids, then
the next ones, and so on. Each plane is compressed with zstandard on its own, and the
chunk begins with an index of all planes, so one block can be read without the others:

    "IDPL" | unit u8 (1 bits, 8 bytes) | planes u8 | ids per block u32 | ids u64
    | length of each plane u32 (block by block) | planes

Spark sorts the documents into ranges, and each task writes chunks of its range as rows
of a Parquet table with the documents' ids and lengths; the order of the rows is
(shard, chunk). Reading is one pass without any order; the starts come from sums.
"""

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.bpe import CachedEncoder, chunks

HEAD = struct.Struct("<4sBBIQ")
CHUNKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("n_ids", T.LongType()),
        T.StructField("planes", T.BinaryType()),
    ]
)
BLOCK_IDS = 16_384
CHUNK_IDS = 262_144


def pack(ids, block_ids=BLOCK_IDS, unit="bit", level=1):
    """The bytes of a chunk of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    bits = int(ids.max()).bit_length() if len(ids) else 0
    step = 1 if unit == "bit" else 8
    planes = -(-bits // step)
    narrow = ids.astype("<u2") if bits <= 16 else ids
    press = zstandard.ZstdCompressor(level=level)
    lengths, body = [], []
    for start in range(0, len(ids), block_ids):
        table = narrow[start : start + block_ids].view(np.uint8).reshape(-1, narrow.itemsize)
        if unit == "bit":
            flat = np.unpackbits(table, axis=1, bitorder="little")[:, :planes]
            rows = np.packbits(np.ascontiguousarray(flat.T), axis=1, bitorder="little")
        else:
            rows = np.ascontiguousarray(table.T)
        for row in rows[:planes]:
            data = press.compress(row.tobytes())
            lengths.append(len(data))
            body.append(data)
    index = np.array(lengths, "<u4").tobytes()
    return b"".join([HEAD.pack(b"IDPL", step, planes, block_ids, len(ids)), index, *body])


def unpack(data, blocks=None):
    """The ids of a chunk, or of the given range of its blocks."""
    magic, step, planes, block_ids, n = HEAD.unpack_from(data)
    if magic != b"IDPL":
        raise ValueError("not a chunk of id planes")
    n_blocks = -(-n // block_ids)
    lengths = np.frombuffer(data, "<u4", n_blocks * planes, HEAD.size)
    ends = HEAD.size + lengths.nbytes + np.cumsum(lengths, dtype=np.int64)
    press = zstandard.ZstdDecompressor()
    out = []
    for block in range(n_blocks) if blocks is None else blocks:
        size = min(block_ids, n - block * block_ids)
        width = 2 if planes * step <= 16 else 4
        rows = []
        for plane in range(block * planes, (block + 1) * planes):
            row = press.decompress(data[ends[plane] - int(lengths[plane]) : ends[plane]])
            rows.append(np.frombuffer(row, np.uint8))
        table = np.zeros((size, width), np.uint8)
        if planes and step == 1:
            flat = np.zeros((size, width * 8), np.uint8)
            flat[:, :planes] = np.unpackbits(np.array(rows), axis=1, count=size, bitorder="little").T
            table = np.packbits(flat, axis=1, bitorder="little")
        elif planes:
            table[:, :planes] = np.array(rows).T
        out.append(np.ascontiguousarray(table).view(f"<u{width}").ravel().astype("<u4"))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


@lru_cache(maxsize=2)
def _library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class LibraryEncoder(CachedEncoder):
    """Ids by the tokenizers library, which sees each new word of a chunk once.

    The words go to the library in one string; each word's ids end with a token that
    closes a word, and so are told apart.
    """

    def __init__(self, path):
        super().__init__(path)
        self.library = _library(path)
        self.closes = np.array([n.endswith(self.vocabulary.suffix) for n in self.vocabulary.names])

    def encode_words(self, words):
        new = list(words)
        ids = np.array(self.library.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the library cuts words differently")
        data, found, start = ids.tobytes(), {}, 0
        for word, end in zip(new, (4 * ends).tolist()):
            found[word] = data[start:end]
            start = end
        return found


@lru_cache(maxsize=1)
def library_encoder(path):
    """The encoder of this worker process; its cache serves task after task."""
    return LibraryEncoder(path)


def written(df, path, tokenizer, end_id=None, key="doc_id", text="text", unit="bit",
            block_ids=BLOCK_IDS, chunk_ids=CHUNK_IDS):
    """Writes the ids of `df`'s texts, in ascending order of `key`, to the folder `path`.

    `end_id` is added to each document. A NULL text is empty; a NULL key comes first;
    rows with the same key follow each other in the order of their texts.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    ranges = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, shard, number = library_encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, parts, held = [], [], 0

        def chunk():
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [[shard], [number], [keys], [[len(p) // 4 for p in parts]], [len(ids)], [pack(ids, block_ids, unit)]]
            types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=CHUNKS.names)

        for batch in batches:
            for part, texts in chunks(batch, "text"):
                for k, ids in zip(part.column("key").to_pylist(), encoder.encode(texts)):
                    keys.append(k)
                    parts.append(ids + tail)
                    held += len(parts[-1]) // 4
                    if held >= chunk_ids:
                        yield chunk()
                        keys, parts, held, number = [], [], 0, number + 1
        if keys:
            yield chunk()

    ranges.mapInArrow(run, CHUNKS).write.mode("overwrite").parquet(path)


def documents(spark, path):
    """The documents of a written folder: key, start, n_tokens, ids (binary).

    `start` counts the ids of all documents before it. Sums by chunk give it: one row
    per shard is ordered in one place, and one row per chunk within its shard.
    """
    table = spark.read.schema(CHUNKS).parquet(path)
    sizes = table.select("shard", "chunk", "n_ids")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.join(shards, "shard").select(
        "shard", "chunk", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"))
    out = "shard int, chunk bigint, key bigint, at bigint, n_tokens bigint, ids binary"

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, chunk, keys, lengths, _, data = (c[row].as_py() for c in batch.columns)
                ids, ends = unpack(data), np.cumsum([0, *lengths])
                raw = ids.tobytes()
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * n, pa.int32()), pa.array([chunk] * n, pa.int64()),
                        pa.array(keys, pa.int64()), pa.array(ends[:-1], pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary()),
                    ],
                    names=["shard", "chunk", "key", "at", "n_tokens", "ids"],
                )

    return table.mapInArrow(run, out), starts


def read(spark, path):
    """Documents with their starts: key, start, n_tokens, ids (binary)."""
    rows, starts = documents(spark, path)
    return rows.join(starts, ["shard", "chunk"]).select(
        "key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def digests(spark, path):
    """key, start, n_tokens and the CRC-32 of each document's ids; ids stay where they are read."""
    rows, starts = documents(spark, path)
    small = rows.select("shard", "chunk", "key", "at", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return small.join(starts, ["shard", "chunk"]).select(
        "key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
