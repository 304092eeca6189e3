"""Token ids in fixed-width bit-packed files.

Each id takes as many bits as the vocabulary's largest id needs.  Documents are
dealt to ranges of ascending ids; a range is written as one or more files:

    magic 8s | bits u4 | ids in a block u4 | documents u8 | ids u8     little-endian
    doc_id i8, is null u1, ids u8           for each document, as three arrays
    byte offset of each block in the payload, u8, and the payload's length
    payload: blocks of BLOCK_IDS ids, bit k of the payload is bit k % 8 of byte k // 8

A block starts at a byte of its own, so any of them is read and unpacked alone.
Writers hold one file's ids at most, write under a name of their own attempt
and rename, and report (range, file number, path, documents, ids); a task that
runs again writes the same bytes under the same name.

Defined cases: a null or empty text is its end id alone.  Null ids come first.
Rows with the same id follow one another, ordered by a hash of the text, then the text.  No documents, no
files, no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, long_array, plain_id, release, shared_dir, table
from spanloom.llm.tokens import encoded

MAGIC = b"SPANBIT1"
HEAD = struct.Struct("<8sIIQQ")
BLOCK_IDS = 4096
FILE_IDS = 1 << 22
FILES_A_TASK = 4
BYTE_VOCABULARY = 50257


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids fill ``bits`` bytes; the last of them are padded with zeros."""
    groups = -(-len(ids) // 8)
    own = np.zeros((groups * 8,), np.uint64)
    own[: len(ids)] = ids
    own = own.reshape(groups, 8)
    words = np.zeros((groups, -(-8 * bits // 64)), np.uint64)
    for j in range(8):
        w, s = divmod(j * bits, 64)
        words[:, w] |= own[:, j] << np.uint64(s)
        if s + bits > 64:
            words[:, w + 1] |= own[:, j] >> np.uint64(64 - s)
    return np.ascontiguousarray(words.view(np.uint8).reshape(groups, -1)[:, :bits]).tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    groups = -(-n // 8)
    wide = -(-8 * bits // 64)
    padded = np.zeros((groups, wide * 8), np.uint8)
    padded[:, :bits] = np.frombuffer(data, np.uint8, groups * bits).reshape(groups, bits)
    words, out, mask = padded.view(np.uint64), np.empty((groups, 8), np.uint64), np.uint64((1 << bits) - 1)
    for j in range(8):
        w, s = divmod(j * bits, 64)
        x = words[:, w] >> np.uint64(s)
        if s + bits > 64:
            x = x | words[:, w + 1] << np.uint64(64 - s)
        out[:, j] = x & mask
    return out.reshape(-1)[:n].astype(np.uint32)


def write_file(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    blocks = [pack_bits(flat[a : a + BLOCK_IDS], bits) for a in range(0, len(flat), BLOCK_IDS)]
    at = np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype=np.int64))).astype("<u8")
    return b"".join(
        [
            HEAD.pack(MAGIC, bits, BLOCK_IDS, len(ids), len(flat)),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], "u1").tobytes(),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            at.tobytes(),
            *blocks,
        ]
    )


class BitFile:
    """A written file, opened; ``f`` can seek and read."""

    def __init__(self, f) -> None:
        self.f = f
        magic, self.bits, self.block_ids, n_docs, self.n_ids = HEAD.unpack(f.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a bit-packed token file")
        doc_ids, nulls = np.frombuffer(f.read(8 * n_docs), "<i8"), np.frombuffer(f.read(n_docs), "u1")
        self.doc_ids = [None if n else x for x, n in zip(doc_ids.tolist(), nulls.tolist(), strict=True)]
        self.sizes = np.frombuffer(f.read(8 * n_docs), "<u8").astype(np.int64)
        self.at = np.frombuffer(f.read(8 * (-(-self.n_ids // self.block_ids) + 1)), "<u8").astype(np.int64)
        self.payload = HEAD.size + 17 * n_docs + 8 * len(self.at)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from position ``start`` on; reads the blocks that hold them only."""
        if not n:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        self.f.seek(self.payload + int(self.at[first]))
        data = self.f.read(int(self.at[last + 1] - self.at[first]))
        held = [unpack_bits(data[self.at[b] - self.at[first] : self.at[b + 1] - self.at[first]], self.bits, min(self.block_ids, self.n_ids - b * self.block_ids)) for b in range(first, last + 1)]
        skip = start - first * self.block_ids
        return np.concatenate(held)[skip : skip + n]


def opened(uri: str):
    """(file system, path) for a URI of the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> None:
    """Writes a whole file; half-written ones never bear its name."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own) as f:
        f.write(data)
    store.move(own, path)


def write_tokens(docs: DataFrame, tokenizer: str, cut: str, vocabulary: int, end_id: int) -> DataFrame:
    """Writes the ids of all documents; part, turn, path, n_docs, n_ids of each file."""
    spark, bits = docs.sparkSession, bits_for(vocabulary)
    folder = shared_dir(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, turn, names, held, n = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/tokens/{part:06d}-{turn:06d}.bits"
            put(path, write_file(names, held, bits))
            return pd.DataFrame({"part": [part], "turn": [turn], "path": [path], "n_docs": [len(names)], "n_ids": [n]})

        for b in batches:
            for doc_id, no_id, ids in zip(b["doc_id"].tolist(), b["no_id"].tolist(), encoded(b["text"].tolist(), tokenizer, cut, end_id), strict=True):
                names.append(None if no_id else doc_id)
                held.append(ids)
                n += len(ids)
                if n >= FILE_IDS:
                    yield flush()
                    turn, names, held, n = turn + 1, [], [], 0
        if names:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text")).withColumn("salt", F.xxhash64("text"))
    # the text's hash parts ranges of one id, or none; rows with one id follow its order
    ranged = own.repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt", "text").select(*plain_id(), "text")
    ranged.mapInPandas(run, "part long, turn long, path string, n_docs long, n_ids long").write.parquet(f"{folder}/manifest")
    del ranged
    release(spark)
    return spark.read.parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for uri, first in zip(b["path"], b["first"].tolist(), strict=True):
                store, path = opened(uri)
                with store.open_input_file(path) as f:
                    own = BitFile(f)
                    rows, at, window, base = [], 0, np.empty(0, np.uint32), 0
                    for doc_id, n in zip(own.doc_ids, own.sizes.tolist(), strict=True):
                        if at + n > base + len(window):
                            base, window = at, own.ids(at, min(max(n, 1 << 18), own.n_ids - at))
                        ids = window[at - base : at - base + n]
                        rows.append((doc_id, first + at, n, zlib.crc32(ids.astype("<u4").tobytes())))
                        at += n
                    out = pd.DataFrame([r[1:] for r in rows], columns=["start", "n_tokens", "ids_crc32"])
                    out.insert(0, "doc_id", long_array([r[0] for r in rows]))
                    yield out

    before = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    tasks = max(1, manifest.count() // FILES_A_TASK)  # a number of its own: the rows are too small for Spark to see the work
    return placed.repartition(tasks, "path").mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), byte_tokenizer(), "spaces", BYTE_VOCABULARY, 0))
