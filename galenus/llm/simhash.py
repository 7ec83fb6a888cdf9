"""SimHash near-duplicates: Golay-code fuzzy hashing finds fingerprints at 4 or fewer differing bits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.llm.components import connected_components
from galenus.llm.golay import ball_masks, fingerprint_keys
from galenus.llm.shared import as_table, bounded_batches, maybe_broadcast, partitions

SHINGLE_WORDS, SEED, MAX_BITS = 4, 42, 4

#: A key that more distinct fingerprints share is resolved by exact ball keys instead of comparisons. So many comparisons take
#: less than the 2,081 ball keys a member. A key holds 2e-8 of n evenly spread fingerprints (116 keys each, 85 of them of three
#: kinds with 2^30 values), so this is reached on average only beyond 4e10 distinct fingerprints.
DENSE_KEY = 1024

#: Bytes of a key row, and of them in one shuffle partition.
KEY_BYTES, PARTITION_BYTES, KEYS_EACH = 16, 64 << 20, 117

#: Sorted rows that a verifying task holds at a time, besides one key's. Up to so many members, keys are compared side by side, with
#: all links of the rows held at a time; the links of larger keys are a tree each, as those of all pairs can take gigabytes.
HELD_ROWS, SHORT_RUN = 1 << 17, 16


def fingerprint(text: bytes | None) -> int:
    """Bit i is 1 if it is set in over half the XXH64 values of the text's word shingles; no words: 0."""
    words = (text or b"").lower().split()  # bytes: A-Z, and the white space is x20 and x09 to x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    last = ends[SHINGLE_WORDS - 1 :] if len(words) >= SHINGLE_WORDS else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, block = np.zeros(64, dtype=np.int64), 1 << 15
    for at in range(0, n, block):
        cut = zip(starts[at : min(n, at + block)].tolist(), last[at : at + block].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in cut], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bits = np.array([fingerprint(t) for t in b.column(1).cast(pa.binary()).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of every row's whole text as a signed long."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, fp long")


def _pairs(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["key", "fp"])


def _golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 2000):
            part = fps[at : at + 2000]
            rows, keys = fingerprint_keys(part)
            yield _pairs(keys, part[rows])


def _ball_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = ball_masks(radius=MAX_BITS // 2)
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 100):
            part = fps[at : at + 100]
            yield _pairs((part[:, None] ^ masks).ravel(), np.repeat(part, len(masks)))


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["u", "v"])


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same fingerprints as all of them do: those that join two groups when they come up."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p] if p in parent else p
        return x

    keep = []
    for i, (x, y) in enumerate(zip(u.tolist(), v.tolist(), strict=True)):
        a, b = root(x), root(y)
        if a != b:
            parent[a] = b
            keep.append(i)
    return u[keep], v[keep]


def _tree(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``len(fps) - 1`` links that connect the fingerprints as all pairs within MAX_BITS do: what is reached leaves the rest."""
    left = np.unique(fps).view(np.uint64)
    us, vs = [left[:0]], [left[:0]]
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= MAX_BITS
            if near.any():
                us.append(left[near])
                vs.append(np.full(len(us[-1]), x))
                reached.extend(us[-1])
                left = left[~near]
    return np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: verified links that connect what all those within the keys do, and the members of dense keys as loops (u, u)."""
    keys = fps = np.zeros(0, dtype=np.int64)
    dense = None

    def resolve(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
        run = np.diff(np.concatenate((first, [len(keys)])))
        of_row = np.repeat(run, run)
        loops = fps[of_row > DENSE_KEY]
        us, vs = [fps[:0]], [fps[:0]]
        for at in np.flatnonzero((run > SHORT_RUN) & (run <= DENSE_KEY)):
            u, v = _tree(fps[first[at] : first[at] + run[at]])
            us.append(u)
            vs.append(v)
        keep = (of_row > 1) & (of_row <= min(SHORT_RUN, DENSE_KEY))
        k, f, n = keys[keep], fps[keep], of_row[keep]
        for d in range(1, SHORT_RUN):
            if d & (d - 1) == 0:  # short runs are done
                left = n > d
                k, f, n = k[left], f[left], n[left]
            same = k[d:] == k[:-d] if len(k) > d else np.zeros(0, dtype=bool)
            if not same.any():
                break
            u, v = f[d:][same], f[:-d][same]
            near = (np.bitwise_count((u ^ v).view(np.uint64)) <= MAX_BITS) & (u != v)
            us.append(u[near])
            vs.append(v[near])
        u, v = _forest(np.concatenate(us), np.concatenate(vs))
        return _edges(np.concatenate((u, loops)), np.concatenate((v, loops)))

    for b in batches:
        k, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if dense is not None:
            n = int(np.searchsorted(k, dense, "right"))
            if n:
                yield _edges(f[:n], f[:n])
            if n < len(k):
                dense = None
            k, f = k[n:], f[n:]
        keys, fps = np.concatenate((keys, k)), np.concatenate((fps, f))
        if len(keys) < HELD_ROWS and not (len(keys) > DENSE_KEY and keys[0] == keys[-1]):
            continue
        tail = int(np.searchsorted(keys, keys[-1]))
        yield resolve(keys[:tail], fps[:tail])
        keys, fps = keys[tail:], fps[tail:]
        if len(keys) > DENSE_KEY:
            yield _edges(fps, fps)
            dense, keys, fps = keys[0], keys[:0], fps[:0]
    yield resolve(keys, fps)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ball centre: a link from each member to the next. Members of a ball are within MAX_BITS."""
    keys = fps = np.zeros(0, dtype=np.int64)
    for b in batches:
        keys = np.concatenate((keys[-1:], b.column(0).to_numpy(zero_copy_only=False)))
        fps = np.concatenate((fps[-1:], b.column(1).to_numpy(zero_copy_only=False)))
        same = (keys[1:] == keys[:-1]) & (fps[1:] != fps[:-1])
        yield _edges(fps[1:][same], fps[:-1][same])


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``fps`` (fp) exactly as all pairs within MAX_BITS do.

    A key's members are compared where they stand side by side after one shuffle
    on the key; only verified links that join two groups leave the task. A key with over DENSE_KEY
    members yields no pairs: its members get the centres of all balls of radius
    2 that hold them, and meet exactly where they are within 4 bits, as a chain.
    """
    count = fps.count()
    n = max(partitions(fps.sparkSession), math.ceil(count * KEYS_EACH * KEY_BYTES / PARTITION_BYTES))
    bounded_batches(fps.sparkSession)
    keyed = fps.select("fp").mapInArrow(_golay_keys, "key long, fp long").repartition(n, "key").sortWithinPartitions("key", "fp")
    found = as_table(keyed.mapInArrow(_verify, "u long, v long").distinct(), "links", count)
    dense = found.filter("u = v").select(F.col("u").alias("fp")).repartition(n, "fp")
    balls = dense.mapInArrow(_ball_keys, "key long, fp long").repartition(n, "key").sortWithinPartitions("key", "fp")
    return found.filter("u <> v").unionByName(balls.mapInArrow(_chain, "u long, v long"))


def _classes(docs: DataFrame) -> tuple[DataFrame, int]:
    """What ``near_duplicates`` returns, and its number of rows."""
    spark = docs.sparkSession
    rows = as_table(fingerprints(docs), "fingerprints")
    count = rows.count()
    nodes = as_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).repartition(partitions(spark), "fp"), "nodes", count)
    distinct = nodes.count()
    roots = as_table(connected_components(fingerprint_links(nodes), distinct), "roots", distinct)
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    table = as_table(named.join(ids, "root").select("fp", "component_id"), "classes", distinct)
    out = rows.join(maybe_broadcast(table, 32, distinct), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"), count


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are not read).

    Fingerprints link at MAX_BITS or fewer differing bits; component_id is the
    smallest doc_id reachable over links. Copies meet in one fingerprint before
    any pair is formed. A null or blank text has fingerprint zero and links like
    any other; a null doc_id gets its component and never names one unless the
    component has no other, then component_id is null; repeated rows stay.
    """
    return _classes(docs)[0]


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate class: that of the smallest doc_id. Columns stay as they are.

    Rows that repeat a doc_id are one document, of which one row stays. Rows
    without a doc_id can't be named and stay.
    """
    classes, count = _classes(docs)
    ids = classes.filter("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("least"), F.count("*").alias("n"))
    ids = as_table(ids.filter("doc_id <> least or n > 1"), "gone", count)
    gone, again = ids.filter("doc_id <> least").select("doc_id"), ids.filter("doc_id = least").select("doc_id")
    kept = docs.join(maybe_broadcast(gone, 32), "doc_id", "left_anti").select(*docs.columns)
    if not again.head(1):
        return kept
    again = maybe_broadcast(again, 32)
    return kept.join(again, "doc_id", "left_anti").unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
