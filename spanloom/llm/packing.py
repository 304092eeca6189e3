"""Packing token sequences into windows by Karmarkar-Karp differencing.

A document's ids, closed by an end id, are cut into whole windows and a tail,
the tail into even pieces of at most ``PIECE`` ids and a sliver, one of its
``SLIVER`` parts; slivers let the windows come out even.  Where cuts fall depends on
the document's length alone, so ids never leave the task that made them; only
(start, length) go on.  Tails are dealt to blocks of about ``BLOCK`` pieces.
In a block, multiway differencing starts with one partial partition for each
piece and keeps merging the two with the largest imbalance, the fullest window
of one with the emptiest of the other, which leaves windows of nearly equal
content.  Their number starts at the least possible and rises by one whenever a
window exceeds the capacity.

Defined cases: a null or empty text is its end id alone.  A document of exactly
k windows has no tail.  Repeated rows are packed each for itself; pieces are
dealt by id, place and content, so documents without an id don't meet in one block.
A null id is kept as null.  An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, long_array, materialize, own_id, plain_id, table
from spanloom.llm.tokens import encoded

WINDOW = 2048
PIECE = 1024
SLIVER = 16
BLOCK = 2048
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(n: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with n ids."""
    out = [(a, window) for a in range(0, n - window + 1, window)]
    first, tail = len(out) * window, n - len(out) * window
    if tail:
        main = tail - tail // SLIVER
        parts = -(-main // piece)
        at = [first + main * i // parts for i in range(parts + 1)] + [n]
        out += [(a, b - a) for a, b in zip(at, at[1:], strict=False) if b > a]
    return out


def differencing(sizes: list[int], bins: int) -> list[tuple[int, list[int]]]:
    """(sum, positions) of at most ``bins`` groups with nearly equal sums.

    A partial partition is its sums, largest first, each with a tree of the
    positions; sums of 0 aren't stored.
    """
    heap = [(-s, k, [(s, k)]) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - bins
        if over > 0:  # the largest of b take a's empty windows, the others a's least full ones
            keep, alone = len(a) - over, len(b) - over
            both = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(reversed(a[keep:]), b[alone:], strict=True)]
            merged = a[:keep] + both + b[:alone]
        else:
            merged = a + b
        merged.sort(key=lambda x: -x[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == bins else 0)
        heapq.heappush(heap, (-spread, turn, merged))
        turn += 1
    return [(s, _leaves(tree)) for s, tree in heap[0][2]] if heap else []


def _leaves(tree) -> list[int]:
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo.extend(x)
        else:
            out.append(x)
    return sorted(out)


def balanced(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Positions in ``sizes`` of each window; no window holds over ``capacity``."""
    bins = max(1, -(-sum(sizes) // capacity))
    while sizes:
        groups = differencing(sizes, bins)
        if max(s for s, _ in groups) <= capacity:
            return [g for _, g in groups]
        bins += 1
    return []


def piece_rows(docs: DataFrame, path: str, cut: str, end_id: int = END_ID, window: int = WINDOW, piece: int = PIECE, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document; ``ids`` too if asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, kept = [], []
            for doc_id, no_id, ids in zip(b["doc_id"].tolist(), b["no_id"].tolist(), encoded(b["text"].tolist(), path, cut, end_id), strict=True):
                doc_id = None if no_id else doc_id
                for start, length in cuts(len(ids), window, piece):
                    own = ids[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(own.astype("<u4").tobytes()), len(ids)))
                    if with_ids:
                        kept.append(own.astype(np.int64))
            out = pd.DataFrame([r[1:] for r in rows], columns=["start", "length", "ids_crc32", "doc_tokens"])
            out.insert(0, "doc_id", long_array([r[0] for r in rows]))
            yield out.assign(ids=kept) if with_ids else out

    return docs.select(*plain_id(), full_text().alias("text")).mapInPandas(run, PIECES + ", ids array<long>" * with_ids)


def pack(pieces: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``pieces`` with sequence_id and offset added."""
    blocks = max(1, -(-pieces.count() // block))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["no_id", "doc_id", "start", "length", "ids_crc32"], kind="stable").reset_index(drop=True)
        sizes = pdf["length"].tolist()
        whole = [[k] for k, s in enumerate(sizes) if s == window]
        parts = [k for k, s in enumerate(sizes) if s < window]
        windows = whole + sorted([parts[i] for i in g] for g in balanced([sizes[k] for k in parts], window))
        sequence, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        for j, group in enumerate(windows):
            at = 0
            for k in group:
                sequence[k], offset[k] = j, at
                at += sizes[k]
        return pdf.assign(sequence_id=sequence * blocks + pdf["__block"], offset=offset).drop(columns="__block")

    block = F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "ids_crc32"), F.lit(blocks)).alias("__block")
    dealt = pieces.select(*plain_id(), *(c for c in pieces.columns if c != "doc_id"), block)
    schema = "doc_id long, no_id boolean, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "doc_id")
    packed = dealt.groupBy("__block").applyInPandas(run, schema + ", sequence_id long, offset long")
    return packed.select(own_id(), *(c for c in packed.columns if c not in ("doc_id", "no_id")))


def pack_documents(docs: DataFrame, tokenizer: str, cut: str = "words", end_id: int = END_ID, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset."""
    return pack(materialize(piece_rows(docs, tokenizer, cut, end_id, window, with_ids=with_ids), "pieces"), window)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())
