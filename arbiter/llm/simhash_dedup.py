"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has 8 byte positions. Two fingerprints that differ in at most ``max_bits`` bits agree in
at least 8 - max_bits positions: the guaranteed minimum. A posting list per single byte would hold
1/256 of all fingerprints, so a list's key here is the bytes of ``key_bytes`` positions at once, fewer than the
minimum: every pair in question meets in several lists. It is taken up in the first that it shares, the
positional bytes that it shares are tallied, pairs below the minimum are left, and the bits of the others are
counted. More positions a key make shorter lists (four suit more than about 10^9 fingerprints), with the same links.
Lists longer than ``list_limit`` (dense groups of near copies, whose pairs would grow with their square) aren't paired:
their members' links are found through shared neighbours instead (see ``_neighbour_links``), which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import hot_join, map_rows, row_key, stage, utf8
from arbiter.llm.components import components

BITS, BYTES = 64, 8


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all shingles of ``words`` words (A-Z lower-cased, repeats included)."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - words + 1].tolist()
    stops = (ends[words - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 15):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + (1 << 15)], stops[at:at + (1 << 15)])],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """id, fp (the 64 bits as a signed long) and key (of id and text) for every row; null and empty texts get 0."""
    def one(doc, key, text):
        f = fingerprint(text, words)
        return ((doc, f - (1 << 64) if f >> 63 else f, key),)
    rows = docs.select(F.col(id_col).cast("long"), row_key(id_col, text_col), utf8(F.col(text_col)))
    return map_rows(rows, one, "id long, fp long, key binary", rows=64)


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in rows:
        if b.num_rows:
            yield b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)


def _out(a: np.ndarray, b: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(a), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(a[at:at + (1 << 16)], pa.int64()),
                                          pa.array(b[at:at + (1 << 16)], pa.int64())], names=names)


def _postings(fps: DataFrame, positions: list[tuple[int, ...]]) -> DataFrame:
    """key, fp: one row for each set of byte positions; the key is the set's number and its bytes."""
    def make(rows):
        for b in rows:
            if not b.num_rows:
                continue
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, at in enumerate(positions):
                key = np.full(len(fp), k, np.uint64)
                for p in at:
                    key = (key << np.uint64(8)) | ((fp >> np.uint64(8 * p)) & np.uint64(255))
                yield from _out(key.view(np.int64), fp.view(np.int64), ["key", "fp"])
    return fps.select("fp").mapInArrow(make, "key long, fp long")


def _list_links(postings: DataFrame, positions: list[tuple[int, ...]], max_bits: int, list_limit: int) -> DataFrame:
    """a, b: pairs whose tally of shared positional bytes reaches the minimum and whose bits then fit, within the lists
    of at most ``list_limit`` members; for longer lists rows (member, null)."""
    first = {sum(1 << p for p in at): k for k, at in enumerate(positions)}
    size, minimum = len(positions[0]), BYTES - max_bits
    # the number of the first list that fingerprints with these equal byte positions share
    shared = np.full(1 << BYTES, -1, np.int64)
    for equal in range(1 << BYTES):
        at = [p for p in range(BYTES) if equal >> p & 1][:size]
        if len(at) == size:
            shared[equal] = first[sum(1 << p for p in at)]

    def pairs(key, fp):
        """Links of whole lists, all short enough."""
        for d in range(1, list_limit):
            same = np.flatnonzero(key[d:] == key[:-d]) if d < len(key) else np.empty(0, np.int64)
            if not len(same):
                return
            a, b, k = fp[same], fp[same + d], key[same] >> (8 * size)
            x = (a ^ b).view(np.uint64)
            equal = (x[:, None] >> np.arange(0, BITS, 8, dtype=np.uint64) & np.uint64(255)) == 0
            enough = equal.sum(axis=1) >= minimum
            a, b, k, x, equal = a[enough], b[enough], k[enough], x[enough], equal[enough]
            fit = (shared[(equal * (1 << np.arange(BYTES))).sum(axis=1)] == k) & (np.bitwise_count(x) <= max_bits)
            yield from _out(np.maximum(a, b)[fit], np.minimum(a, b)[fit], ["a", "b"])

    def hot(fp):
        for at in range(0, len(fp), 1 << 16):
            part = fp[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.nulls(len(part), pa.int64())], names=["a", "b"])

    def sweep(key, fp):
        """Rows of whole lists, sorted by key."""
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        length = np.repeat(np.diff(np.append(heads, len(key))), np.diff(np.append(heads, len(key))))
        yield from hot(fp[length > list_limit])
        keep = (length > 1) & (length <= list_limit)
        yield from pairs(key[keep], fp[keep])

    def run(rows):
        key = fp = np.empty(0, np.int64)
        long_key = None
        for k, f in _batches(rows):
            if long_key is not None:  # a list already known as long goes on
                n = int(np.searchsorted(k, long_key, side="right"))
                yield from hot(f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                long_key = None
            key, fp = np.concatenate((key, k)), np.concatenate((fp, f))
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield from sweep(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
            if len(key) > list_limit:
                long_key = key[0]
                yield from hot(fp)
                key = fp = np.empty(0, np.int64)
        if len(key):
            yield from sweep(key, fp)

    return postings.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _neighbour_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """a, b: links that connect ``fps`` (fp) as all pairs of at most ``max_bits`` bits would, without pairing them.

    Two fingerprints within 2r bits have a common neighbour within r bits of both, and whatever shares
    one lies within 2r. Each emits its neighbours (2,081 for r = 2); the members of a neighbour are
    linked in a chain, so the work is linear in the fingerprints. For an odd max_bits the chained
    members are those of pairs that pass the bit count, checked against each neighbour's first member.
    """
    if max_bits % 2:
        raise ValueError("an even max_bits is needed")
    masks = np.array([sum(1 << b for b in at) for r in range(max_bits // 2 + 1) for at in combinations(range(BITS), r)],
                     dtype=np.uint64)

    def near(rows):
        for b in rows:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 32):
                part = fp[at:at + 32]
                yield from _out((part[:, None] ^ masks).ravel().view(np.int64),
                                np.repeat(part, len(masks)).view(np.int64), ["near", "fp"])

    def chain(rows):
        last = None
        for k, f in _batches(rows):
            if last is not None:
                k, f = np.concatenate(([last[0]], k)), np.concatenate(([last[1]], f))
            same = np.flatnonzero(k[1:] == k[:-1])
            a, b = f[same], f[same + 1]
            pair = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b))), axis=1)
            yield from _out(pair[0], pair[1], ["a", "b"])
            last = (k[-1], f[-1])

    spread = fps.select("fp").mapInArrow(near, "near long, fp long")
    return spread.repartition("near").sortWithinPartitions("near", "fp").mapInArrow(chain, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4,
                    key_bytes: int = 3, list_limit: int = 64) -> DataFrame:
    """One row per input row: ``id_col``, fp, component_id, root, key.

    Texts are A-Z lower-cased and cut into shingles of ``words`` words; fewer words make one shingle, none
    make fingerprint 0, which links like any other. Rows with fingerprints that differ in at most
    ``max_bits`` (even) bits are linked; component_id is the smallest id reachable, the row's own included
    (null only if no row of the component has an id), ``root`` the component's smallest fingerprint. Equal
    fingerprints are one node, so copies are never paired. Null texts count as empty, repeated rows come
    out as often as they came in, an empty table gives no rows, and other columns aren't looked at.
    """
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "fingerprint-nodes")
    positions = list(combinations(range(BYTES), min(key_bytes, BYTES - max_bits)))
    found = stage(_list_links(_postings(nodes, positions), positions, max_bits, list_limit), "fingerprint-links")
    dense = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    links = found.filter("b is not null").unionByName(_neighbour_links(dense, max_bits))
    roots = components(links).withColumnRenamed("node", "fp")
    hung = stage(nodes.join(roots.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "fingerprint-roots")
    least = stage(hung.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members")), "fingerprint-parts")
    named = hot_join(hung, least, ["root"], "members", hung.count()).select("fp", "n", "component_id", "root")
    return hot_join(rows, stage(named, "fingerprint-named"), ["fp"], "n", rows.count()).select(
        F.col("id").alias(id_col), "fp", "component_id", "root", "key")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each component the one with the smallest id (a null id
    only if there is no other; on a tie the least key), once when it is repeated."""
    found = near_duplicates(docs, id_col, text_col, words, max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("key"))).alias("least"))
    kept = first.select(F.col("least.key").alias("_key"))
    marked = docs.withColumn("_key", row_key(id_col, text_col))
    return marked.join(kept.hint("merge"), "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
