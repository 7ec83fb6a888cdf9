"""Hierarchical multi-length packing of token sequences."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galenus.llm.shared import bounded_batches

#: Context sizes, longest first. A sequence that fills one of them exactly has no padding.
TIERS = (2048, 1024, 512, 256)

#: The id after each document.
END_ID = 1

#: Waiting pieces of a task beyond this number of tokens or of pieces are packed; bounds the task's memory.
POOL_TOKENS, POOL_PIECES = 4_000_000, 100_000

#: Pieces of one batch that a task returns.
BATCH_PIECES = 20_000

#: Tokens of one step group; sequences of a group have one length, so that every group is equal work.
STEP_TOKENS = 16_384

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


@cache
def _encoders(vocabulary: str, ranks: str) -> tuple[Tokenizer, tiktoken.Encoding, tuple[str, ...]]:
    slow = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    with open(public_tokenizers.path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = tuple(t.content for t in slow.get_added_tokens_decoder().values())
    return slow, tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}), special


def encode(text: str, vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken") -> np.ndarray:
    """Ids of ``text`` with END_ID appended. The rank file is the same vocabulary, several times faster; texts that hold a special token's string go by the first."""
    slow, fast, special = _encoders(vocabulary, ranks)
    ids = slow.encode(text, add_special_tokens=False).ids if any(s in text for s in special) else fast.encode_ordinary(text)
    return np.array([*ids, END_ID], dtype="<u4")


class Packer:
    """Packs the documents of one task; ``add`` and ``finish`` yield (piece, sequence, offset, tier) once a sequence is closed.

    A document's whole 2048-windows are sequences of their own. Its rest is
    routed to the shortest tier that holds it. Rests of the longest tier open a
    window each; its gap is filled from the shorter tiers, the longest rest that
    fits first, and the last gap by cutting one. What is left of the shorter
    tiers fills windows of its own tier the same way.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS, pool_pieces: int = POOL_PIECES):
        self.tiers, self.pool_tokens, self.pool_pieces = tiers, pool_tokens, pool_pieces
        self.rests: list[tuple[int, int]] = []  # (length, number), ascending
        self.pieces: dict[int, tuple] = {}
        self.number = self.sequence = self.waiting = 0

    def _piece(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        self.number += 1
        self.pieces[self.number] = (doc, start, ids.copy(), total)
        insort(self.rests, (len(ids), self.number))
        self.waiting += len(ids)

    def _take(self, i: int) -> tuple:
        n, number = self.rests.pop(i)
        self.waiting -= n
        return self.pieces.pop(number)

    def _close(self, parts: list[tuple], tier: int) -> Iterator[tuple]:
        at = 0
        for p in parts:
            yield p, self.sequence, at, tier
            at += len(p[2])
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        top, n = self.tiers[0], len(ids)
        for at in range(0, n - n % top, top):
            yield from self._close([(doc, at, ids[at : at + top], n)], top)
        if n % top:
            self._piece(doc, n - n % top, ids[n - n % top :], n)
        if self.waiting > self.pool_tokens or len(self.rests) > self.pool_pieces:
            yield from self._pack(self.pool_tokens // 2, self.pool_pieces // 2)

    def _pack(self, tokens: int, pieces: int) -> Iterator[tuple]:
        """Close full windows, longest rest first, until at most so many tokens and pieces wait or none can be filled."""
        while self.rests and (self.waiting > tokens or len(self.rests) > pieces):
            longest = self.rests[-1][0]
            tier = next(t for t in reversed(self.tiers) if t >= longest)
            if self.waiting < tier:
                tier = next((t for t in self.tiers if t <= self.waiting), 0)
                if not tier:
                    return
            yield from self._fill(tier)

    def _fill(self, tier: int) -> Iterator[tuple]:
        parts, gap = [], tier
        while gap:
            i = bisect_right(self.rests, (gap, self.number + 1)) - 1
            if i >= 0:
                parts.append(self._take(i))
            else:  # all are longer: cut the shortest
                doc, start, ids, total = self._take(0)
                parts.append((doc, start, ids[:gap], total))
                self._piece(doc, start + gap, ids[gap:], total)
            gap -= len(parts[-1][2])
        yield from self._close(parts, tier)

    def finish(self) -> Iterator[tuple]:
        """All that waits; only the last sequence, shorter than the shortest tier, is padded."""
        yield from self._pack(0, 0)
        if self.rests:
            yield from self._close([self._take(len(self.rests) - 1) for _ in range(len(self.rests))], self.tiers[0])


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 32
    packer, seen, group_of, groups = Packer(), {}, {}, 0
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    kinds = [pa.int32() if n == "tier" else pa.int64() for n in names]

    def row(closed: tuple) -> tuple:
        """What is returned of a piece: its ids are let go at once."""
        nonlocal groups
        (doc, start, ids, total), sequence, offset, tier = closed
        if sequence not in seen.get(tier, ()):  # a new sequence of this tier
            count, group = group_of.get(tier, (0, None))
            if group is None or count * tier >= STEP_TOKENS:
                count, group, groups = 0, groups, groups + 1
            group_of[tier], seen[tier] = (count + 1, group), (sequence,)
        return doc, start, len(ids), zlib.crc32(ids.tobytes()), total, base + sequence, offset, tier, base + group_of[tier][1]

    def closed() -> Iterator[tuple]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from packer.add(doc, encode(text))
        yield from packer.finish()

    out = map(row, closed())
    while cut := list(islice(out, BATCH_PIECES)):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*cut, strict=True), kinds, strict=True)], names=names)


def pack(docs: DataFrame) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text) into sequences of at most 2048 tokens; one row per piece.

    Each task packs the rows that it reads, so nothing is shuffled and at most
    one sequence per task is padded; a repeated task packs the same rows alike.
    Columns: see SCHEMA; start counts a document's ids before the piece, offset
    those of the sequence; step_group names groups of sequences with equal
    length and at most STEP_TOKENS tokens. A null text is empty, and an empty
    text is its END_ID; a null doc_id stays null; repeated rows are packed each;
    no rows, no pieces.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_pack_task, SCHEMA)
