"""Katz backoff language model of words: Good-Turing discounted counts, exactly normalised backoff weights.

A token's probability is asked recursively: of the pair (context, word) when training held it, else of the word alone times
the context's backoff weight, and of an unknown word at last. Counts lie in tables dealt by key into parts.

Documents are packed into shards of bounded size. A shard sends each of its distinct words, and then each of its distinct
pairs, once to the part that owns the key; the owner adds up what all shards sent, keeps the sums as its
part of the model, and answers every shard in the order asked. So what is shuffled follows distinct keys per shard,
no frequent word or pair is hot, and a shard's answers meet its tokens in one row. Columns of numbers travel
as compressed blocks.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import shard_count, stage

#: Tokens of a shard (a longer text goes over several), bytes of text split at once, and bytes of input per part of the tables.
SHARD_TOKENS, CHUNK_BYTES, PART_BYTES = 1_000_000, 1 << 20, 8 << 20
#: Counts up to this one are discounted.
MOST_DISCOUNTED = 5
#: The token that ends a text, and the context of its first token. Words are never empty.
END, START = b"", 0
WHITE = re.compile(rb"[\x20\x09-\x0D]")

PACKED = ("shard long, docs array<long>, ids array<{}>, held array<boolean>, leads array<int>, sizes array<int>, tokens binary, "
          "home binary, asked array<struct<part:int,words:binary,train:binary>>")


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as a compressed block: bytes of one place together, so that the many zero bytes vanish."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


class _Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self)
        return made


def _chunks(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, of about ``size`` bytes at a time. bytes.split() splits at exactly the white space of a word's definition."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            found = WHITE.search(text, end)
            end = found.start() if found else len(text)
        words = text[at:end].split()
        if words:
            yield words
        at = end


def pack(parts: int, shard_tokens: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, held, text) rows to shards. ``docs`` numbers the rows; ``leads`` is the word before a piece's first token, -1 at a text's start."""
    shard = key = TaskContext.get().partitionId() << 33
    ids, tokens, docs = _Ids(), array("i"), []

    def made(id_type: pa.DataType) -> pa.RecordBatch:
        words = list(ids)
        home = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
        own = np.frombuffer(tokens, np.int32)
        train = np.repeat([not d[2] for d in docs], [d[4] for d in docs])
        seen = np.bincount(own[train], minlength=len(words))
        order = np.argsort(home, kind="stable")
        asked, bounds = [], np.searchsorted(home[order], np.arange(parts + 1))
        for part, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b > a:
                block = b"\n".join([words[i] for i in order[a:b].tolist()])
                asked.append({"part": part, "words": zstandard.ZstdCompressor(level=1).compress(block), "train": squeeze(seen[order[a:b]])})
        keys, doc_ids, held, lead, size = zip(*docs, strict=True)
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([doc_ids], pa.list_(id_type)),
            pa.array([held], pa.list_(pa.bool_())), pa.array([lead], pa.list_(pa.int32())), pa.array([size], pa.list_(pa.int32())), pa.array([squeeze(own)], pa.binary()),
            pa.array([squeeze(home)], pa.binary()),
            pa.array([asked], pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary()), ("train", pa.binary())])))],
            names=["shard", "docs", "ids", "held", "leads", "sizes", "tokens", "home", "asked"])

    for batch in batches:
        for at in range(batch.num_rows):
            doc_id, held, text = (c[at].as_py() for c in batch.columns)
            key, lead, start, last = key + 1, -1, len(tokens), None
            for words in _chunks((text or "").encode().lower(), min(CHUNK_BYTES, 4 * shard_tokens)):
                if len(tokens) >= shard_tokens:  # the text goes on in the next shard
                    if len(tokens) > start:
                        docs.append((key, doc_id, held, lead, len(tokens) - start))
                    yield made(batch.schema.field(0).type)
                    shard, ids, tokens, docs, start = shard + 1, _Ids(), array("i"), [], 0
                    lead = -1 if last is None else ids[last]
                tokens.extend(map(ids.__getitem__, words))
                last = words[-1]
            tokens.append(ids[END])
            docs.append((key, doc_id, held, lead, len(tokens) - start))
            if len(tokens) >= shard_tokens:
                yield made(batch.schema.field(0).type)
                shard, ids, tokens, docs = shard + 1, _Ids(), array("i"), []
    if docs:
        yield made(batch.schema.field(0).type)


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return np.bincount(n[n <= MOST_DISCOUNTED + 1], minlength=MOST_DISCOUNTED + 2)[1:].tolist()


def merge_words(parts: int, table: pa.Table) -> pa.Table:
    """One part of the words: their counts over all shards. Answers every shard with numbers and counts of its words; the part
    itself goes out with shard -1. A word that training lacks gets number 0."""
    part, index, asked = table["part"][0].as_py(), _Ids(), []
    for block in table["words"]:
        words = zstandard.ZstdDecompressor().decompress(block.as_py()).split(b"\n")
        asked.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
    n = np.zeros(len(index), np.int64)
    for at, train in zip(asked, table["train"], strict=True):
        n[at] += expand(train.as_py())  # a shard asks a word once
    order = np.lexsort((np.array(list(index), dtype=object), -n))
    number = np.empty(len(n), np.int64)
    number[order] = np.arange(len(n)) * parts + part + 1
    number[n == 0] = 0
    known, words = order[n[order] > 0], list(index)
    stats = [len(known), int(n.sum()), int(n[index[END]]) if END in index else 0, *_counts_of_counts(n)]
    rows = {"kind": ["word"] * len(asked) + ["model"], "part": [part] * (len(asked) + 1),
            "shard": [*table["shard"].to_pylist(), -1], "a": [squeeze(number[x]) for x in asked], "b": [squeeze(n[x]) for x in asked],
            "stats": [None] * len(asked) + [stats]}
    rows["a"].append(zstandard.ZstdCompressor(level=1).compress(b"\n".join([words[i] for i in known.tolist()])))
    rows["b"].append(squeeze(n[known]))
    return pa.table({"kind": pa.array(rows["kind"]), "part": pa.array(rows["part"], pa.int32()), "shard": pa.array(rows["shard"], pa.int64()),
                     "a": pa.array(rows["a"], pa.binary()), "b": pa.array(rows["b"], pa.binary()),
                     "c": pa.nulls(len(rows["a"]), pa.binary()), "d": pa.nulls(len(rows["a"]), pa.binary()),
                     "stats": pa.array(rows["stats"], pa.list_(pa.int64()))})


ANSWERS = "kind string, part int, shard long, a binary, b binary, c binary, d binary, stats array<long>"


def good_turing(n: list[int]) -> list[float]:
    """The factor for counts 0 to MOST_DISCOUNTED from n[r - 1] = number of keys that occur r times (0's factor is unused).

    Katz's formula; where it gives nothing between 0 and 1, as in small or copied corpora, (r - D) / r with
    D = n1 / (n1 + 2 n2), kept within 0.1 and 0.9.
    """
    k, out = MOST_DISCOUNTED, [1.0]
    spare = min(0.9, max(0.1, n[0] / (n[0] + 2 * n[1]))) if n[0] else 0.5
    for r in range(1, k + 1):
        d = -1.0
        if n[0] and n[r - 1] and (k + 1) * n[k] != n[0]:
            over = (k + 1) * n[k] / n[0]
            d = ((r + 1) * n[r] / n[r - 1] / r - over) / (1 - over)
        out.append(d if 0 < d < 1 else (r - spare) / r)
    return out


@dataclass(frozen=True)
class Words:
    """The one-word model. ``total`` is N, or N + 1 when no count is discounted, so that unknown words always have a share."""

    n_types: int
    n_tokens: int
    n_docs: int
    counts: list[int]

    @property
    def factors(self) -> list[float]:
        return good_turing(self.counts)

    @property
    def spared(self) -> float:
        """What discounting takes away from the known words, in tokens."""
        return sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.factors[1:], self.counts, strict=False), 1))

    @property
    def total(self) -> int:
        return self.n_tokens if self.spared else self.n_tokens + 1

    @property
    def unseen_types(self) -> float:
        """Chao's estimate of the number of words that training lacks, one at least."""
        one, two = self.counts[0], self.counts[1]
        return max(1.0, one * one / (2 * two) if two else one * (one - 1) / 2)

    def unknown(self) -> float:
        return (self.spared or 1.0) / self.total / self.unseen_types

    def probability(self, n: np.ndarray) -> np.ndarray:
        """Of words that occur n times in training; n = 0: of one unknown word."""
        factor = np.array(self.factors)[np.minimum(n, MOST_DISCOUNTED)]
        return np.where(n > 0, np.where(n > MOST_DISCOUNTED, 1.0, factor) * n / self.total, self.unknown())

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.1) / (self.n_tokens + 0.1 * (self.n_types + 1)))


def unique_pairs(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and for every pair its place among them."""
    if not len(v) or max(int(v.max()), int(w.max())) < 1 << 31:
        key, at = np.unique(v << 32 | w, return_inverse=True)
        return key >> 32, key & 0xFFFFFFFF, at
    order = np.lexsort((w, v))
    first = np.ones(len(v), bool)
    first[1:] = (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0)
    at = np.empty(len(v), np.int64)
    at[order] = np.cumsum(first) - 1
    return v[order][first], w[order][first], at


def _mixed(x: np.ndarray) -> np.ndarray:
    return ((x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)).astype(np.int64)


class Shard:
    """One shard with the answers to its words: tokens, contexts, and its distinct pairs in the order in which they are asked."""

    def __init__(self, row: dict, words: Words, parts: int):
        answers = sorted((x for x in row["answers"] if x["kind"] == "word"), key=lambda x: x["part"])
        home = expand(row["home"])
        order = np.argsort(home, kind="stable")
        number, count = np.empty(len(home), np.int64), np.empty(len(home), np.int64)
        number[order] = np.concatenate([expand(x["a"]) for x in answers])
        count[order] = np.concatenate([expand(x["b"]) for x in answers])
        tokens = expand(row["tokens"])
        self.starts = np.concatenate(([0], np.cumsum(row["sizes"])[:-1])).astype(np.int64)
        self.held = np.repeat(np.array(row["held"], bool), row["sizes"])
        before = np.concatenate(([0], tokens[:-1]))
        leads = np.array(row["leads"], np.int64)
        before[self.starts] = leads
        #: Per token: the count and number of the word, the number of its context (-1: unknown) and how often that was a context.
        self.n, self.w = count[tokens], number[tokens]
        self.v, self.seen = number[before], count[before]
        self.v[self.v == 0] = -1
        first = self.starts[leads < 0]
        self.v[first], self.seen[first] = START, words.n_docs
        self.known = (self.v >= 0) & (self.w > 0)
        v, w, at = unique_pairs(self.v[self.known], self.w[self.known])
        pair_seen, pair_n = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        pair_seen[at], pair_n[at] = self.seen[self.known], self.n[self.known]
        train = np.bincount(at[~self.held[self.known]], minlength=len(v))
        # a context with a large share of the tokens goes to several parts, by the word
        spread = np.minimum(parts, 1 + pair_seen * 4 * parts // max(1, words.n_tokens))
        part = (_mixed(v) + _mixed(w) % spread) % parts
        order = np.argsort(part, kind="stable")
        place = np.empty(len(v), np.int64)
        place[order] = np.arange(len(v))
        self.at = place[at]
        self.pairs = part[order], v[order], w[order], train[order], pair_n[order]
        # contexts to ask about: for their weight those of held-out texts, and for their total those that may hold no discounted count
        wants = np.unique(self.v[self.held & (self.v >= 0)])
        asked = np.union1d(wants, self.v[(self.v >= 0) & (self.seen > MOST_DISCOUNTED)])
        home = _mixed(asked) % parts
        order = np.argsort(home, kind="stable")
        self.contexts = home[order], asked[order], np.isin(asked[order], wants)


def _cut(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(part[a]), slice(a, b)


def ask(words: Words, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's distinct pairs and contexts, one row per part that owns them."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("kind", pa.string()),
                        *((c, pa.binary()) for c in "abcd")])
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            s, out = Shard(row, words, parts), []
            part, v, w, train, n = s.pairs
            for p, cut in _cut(part):
                out.append((p, row["shard"], "pair", squeeze(np.diff(v[cut], prepend=0)), squeeze(w[cut]), squeeze(train[cut]), squeeze(n[cut])))
            part, v, wants = s.contexts
            for p, cut in _cut(part):
                out.append((p, row["shard"], "ask", squeeze(np.diff(v[cut], prepend=0)), squeeze(wants[cut]), None, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def merge_pairs(table: pa.Table) -> pa.Table:
    """One part of the pairs: their counts over all shards, answered in the order asked. Per context what its weight needs goes
    on in whole numbers; the part itself is kept with shard -1; questions about contexts go on as they are."""
    k, part = MOST_DISCOUNTED, table["part"][0].as_py()
    kinds = np.array(table["kind"].to_pylist(), dtype=object)
    pairs = table.take(pa.array(np.flatnonzero(kinds == "pair")))
    out = [("ask", part, r["shard"], r["a"], r["b"], None, None, None)
           for r in table.take(pa.array(np.flatnonzero(kinds == "ask"))).to_pylist()]
    if pairs.num_rows:
        vs = [np.cumsum(expand(x.as_py())) for x in pairs["a"]]
        sizes = list(map(len, vs))
        v, w, at = unique_pairs(np.concatenate(vs), np.concatenate([expand(x.as_py()) for x in pairs["b"]]))
        del vs
        n = np.zeros(len(v), np.int64)
        np.add.at(n, at, np.concatenate([expand(x.as_py()) for x in pairs["c"]]))
        word_n = np.zeros(len(v), np.int64)
        word_n[at] = np.concatenate([expand(x.as_py()) for x in pairs["d"]])
        for shard, mine in zip(pairs["shard"].to_pylist(), np.split(at, np.cumsum(sizes)[:-1]), strict=True):
            out.append(("pair", part, shard, squeeze(n[mine]), None, None, None, None))
        v, w, n, word_n = (x[n > 0] for x in (v, w, n, word_n))
        out.append(("model", part, -1, squeeze(np.diff(v, prepend=0)), squeeze(w), squeeze(n), None, [len(v), int(n.sum()), 0, *_counts_of_counts(n)]))
        if len(v):
            first = np.flatnonzero(np.diff(v, prepend=-1))
            add = lambda x: np.add.reduceat(x.astype(np.int64), first)
            sums = [add(n), *(add(n == r) for r in range(1, k + 1)),
                    add(np.where(word_n > k, word_n, 0)), *(add(word_n == r) for r in range(1, k + 1))]
            home = v[first]
            out.append(("context", part, -1, squeeze(np.diff(home, prepend=0)), squeeze(np.concatenate(sums)), None, None, None))
    kind, parts, shard, a, b, c, d, stats = zip(*out, strict=True)
    blob = lambda x: pa.array(x, pa.binary())
    return pa.table({"kind": pa.array(kind, pa.string()), "part": pa.array(parts, pa.int32()), "shard": pa.array(shard, pa.int64()),
                     "a": blob(a), "b": blob(b), "c": blob(c), "d": blob(d), "stats": pa.array(stats, pa.list_(pa.int64()))})


def split_contexts(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of contexts to the part that owns the context; few go elsewhere, those of spread contexts."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["kind"] == "ask":
                out.append((r["part"], r["shard"], r["a"], r["b"]))
                continue
            v = np.cumsum(expand(r["a"]))
            sums, home = expand(r["b"]).reshape(-1, len(v)), _mixed(v) % parts
            order = np.argsort(home, kind="stable")
            for p, cut in _cut(home[order]):
                mine = order[cut]
                out.append((p, -1, squeeze(np.diff(v[mine], prepend=0)), squeeze(sums[:, mine].ravel())))
        part, shard, a, b = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(shard, pa.int64()), pa.array(a, pa.binary()),
                                          pa.array(b, pa.binary())], names=["part", "shard", "a", "b"])


def backoff(words: Words, factors: list[float], sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(total, weight) per context from its whole sums, as ``merge_pairs`` makes them: a column per context.

    The words not seen after the context share what discounting its pairs spares, in proportion to their own
    probabilities; both masses are added up from whole numbers, without cancellation. A context none of whose pairs is discounted
    counts one more in total, so that some is left.
    """
    k = MOST_DISCOUNTED
    r, d, d1 = np.arange(1, k + 1)[:, None], np.array(factors[1:])[:, None], np.array(words.factors[1:])[:, None]
    spared = ((1 - d) * r * sums[1:k + 1]).sum(axis=0)
    total = sums[0] + (spared == 0)
    left = np.where(spared == 0, 1.0, spared) / total
    few = sums[k + 2:]
    others = (words.total - sums[k + 1] - (r * few).sum(axis=0)) + ((1 - d1) * r * few).sum(axis=0)
    return total, left / (others / words.total)


def weigh(words: Words, factors: list[float], table: pa.Table) -> pa.Table:
    """One part of the contexts: totals and backoff weights, and the answers to the shards that asked."""
    part, rows = table["part"][0].as_py(), table.select(["shard", "a", "b"]).to_pylist()
    made = [(np.cumsum(expand(x["a"])), expand(x["b"])) for x in rows if x["shard"] < 0]
    v = np.unique(np.concatenate([a for a, _ in made])) if made else np.zeros(0, np.int64)
    sums = np.zeros((2 * MOST_DISCOUNTED + 2, len(v)), np.int64)
    for a, b in made:
        sums[:, np.searchsorted(v, a)] += b.reshape(len(sums), -1)
    total, weight = backoff(words, factors, sums)
    out = [("context", part, -1, squeeze(np.diff(v, prepend=0)), squeeze(total), weight.tobytes())] if len(v) else []
    for x in rows:
        if x["shard"] >= 0:
            asked, wants = np.cumsum(expand(x["a"])), expand(x["b"]) > 0
            at = np.minimum(np.searchsorted(v, asked), max(0, len(v) - 1))
            there = v[at] == asked if len(v) else np.zeros(len(asked), bool)
            more = there & (total[at] > sums[0][at]) if len(v) else there
            mine = np.where(there, weight[at], 1.0) if len(v) else np.ones(len(asked))
            out.append(("weight", part, x["shard"], squeeze(more), zstandard.ZstdCompressor(level=1).compress(mine[wants].tobytes()), None))
    kind, parts, shard, a, b, c = zip(*out, strict=True)
    blob = lambda y: pa.array(y, pa.binary())
    return pa.table({"kind": pa.array(kind, pa.string()), "part": pa.array(parts, pa.int32()), "shard": pa.array(shard, pa.int64()),
                     "a": blob(a), "b": blob(b), "c": blob(c), "d": pa.nulls(len(a), pa.binary()), "stats": pa.nulls(len(a), pa.list_(pa.int64()))})


def evaluate(words: Words, factors: list[float], parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of a document: tokens, known tokens, base score and score."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            s = Shard(row, words, parts)
            blocks = lambda kind: sorted((x for x in row["answers"] if x["kind"] == kind), key=lambda x: x["part"])  # noqa: E731, B023
            whole = lambda made: np.concatenate(made) if made else np.zeros(0, np.int64)
            pair_n = np.zeros(len(s.n), np.int64)
            pair_n[s.known] = whole([expand(x["a"]) for x in blocks("pair")])[s.at]
            _, asked, wants = s.contexts
            more, weight = np.zeros(len(asked)), np.ones(len(asked))
            if len(asked):
                more = whole([expand(x["a"]) for x in blocks("weight")])
                weight[wants] = whole([np.frombuffer(zstandard.ZstdDecompressor().decompress(x["b"])) for x in blocks("weight")])
            by_number = np.argsort(asked)
            place = np.minimum(np.searchsorted(asked[by_number], s.v), max(0, len(asked) - 1))
            place = by_number[place] if len(asked) else place
            there = (asked[place] == s.v) if len(asked) else np.zeros(len(s.v), bool)
            single = words.probability(s.n)
            lower = single * np.where(there, weight[place], 1.0) if len(asked) else single
            total = np.maximum(1, s.seen + (np.where(there, more[place], 0) if len(asked) else 0))
            factor = np.where(pair_n > MOST_DISCOUNTED, 1.0, np.array(factors)[np.minimum(pair_n, MOST_DISCOUNTED)])
            p = np.where(pair_n > 0, factor * pair_n / total, lower)
            add = lambda x: np.add.reduceat(x, s.starts)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([
                pa.array(row["docs"], pa.int64()), batch.column("ids").slice(at, 1).flatten(), pa.array(row["held"], pa.bool_()),
                pa.array(row["sizes"], pa.int64()), pa.array(add((s.n > 0).astype(np.int64))),
                pa.array(add(words.base(s.n))), pa.array(add(np.log10(p)))], names=["doc", "id", "held", "n_tokens", "n_known", "base_score", "score"])


@dataclass
class KatzScores:
    """``scores`` per document and the model's tables, one row per part: ``words`` (a: words, b: counts), ``pairs`` (a: steps of
    the context's number, b: the word's, c: counts) and ``contexts`` (a: steps of the number, b: totals, c: backoff weights)."""

    scores: DataFrame
    unigram: Words
    pair_factors: list[float]
    words: DataFrame
    pairs: DataFrame
    contexts: DataFrame


def katz(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_share: int = 10,
         shard_tokens: int = SHARD_TOKENS) -> KatzScores:
    """Train on the documents whose CRC-32 of the id's text isn't divisible by ``held_share`` and score all.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, then one end. ``scores``: id_col, held_out, n_tokens,
    n_known (tokens that training holds), train_tokens, base_score (add-0.1 estimate of single words) and score (this
    model), both log10. Null texts are empty (one token, the end); a null id counts as an empty text, so it is
    held out. Rows come out as often as they came in, and repeated rows of training count each time; a text of any length is
    scored whole. An empty table gives no rows; with nothing to train on every token is unknown. Other columns aren't looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    parts = shard_count(docs, PART_BYTES, 32)
    hashed = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), (hashed % held_share == 0).alias("held"), F.col(text_col).cast("string").alias("text"))
    shards = stage(rows.mapInArrow(lambda b: pack(parts, shard_tokens, b), PACKED.format(kind)), "katz-shards")
    tokens = shards.drop("asked")

    asked = shards.select("shard", F.explode("asked").alias("x")).select("x.part", "shard", "x.words", "x.train")
    answers = stage(asked.groupBy("part").applyInArrow(lambda t: merge_words(parts, t), ANSWERS), "katz-words")
    words = Words(*_stats(answers))

    def answered(more: DataFrame | None = None) -> DataFrame:
        rows = answers.filter("shard >= 0")
        rows = rows if more is None else rows.unionByName(more.filter("shard >= 0"))
        return (rows.groupBy("shard").agg(F.collect_list(F.struct("kind", "part", "a", "b")).alias("answers"))
                .join(tokens.hint("merge"), "shard"))

    pairs = answered().mapInArrow(lambda b: ask(words, parts, b), "part int, shard long, kind string, a binary, b binary, c binary, d binary")
    merged = stage(pairs.groupBy("part").applyInArrow(merge_pairs, ANSWERS), "katz-pairs")
    factors = good_turing(_stats(merged)[3])
    sums = merged.filter("kind in ('context', 'ask')").select("kind", "part", "shard", "a", "b").mapInArrow(
        lambda b: split_contexts(parts, b), "part int, shard long, a binary, b binary")
    weights = stage(sums.groupBy("part").applyInArrow(lambda t: weigh(words, factors, t), ANSWERS), "katz-contexts")
    pieces = answered(merged.filter("kind = 'pair'").unionByName(weights)).mapInArrow(
        lambda b: evaluate(words, factors, parts, b), f"doc long, id {kind}, held boolean, n_tokens long, n_known long, base_score double, score double")
    scores = (pieces.groupBy("doc").agg(F.first("id").alias(id_col), F.first("held").alias("held_out"),
                                        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
              .select(id_col, "held_out", "n_tokens", "n_known", F.lit(words.n_tokens).cast("long").alias("train_tokens"),
                      "base_score", "score"))
    model = [x.filter(f"kind = '{k}' and shard < 0").select("part", "a", "b", "c")
             for x, k in ((answers, "model"), (merged, "model"), (weights, "context"))]
    return KatzScores(scores, words, factors, *model)


def _stats(rows: DataFrame) -> tuple[int, int, int, list[int]]:
    """Types, tokens, texts and counts of counts, added up over the parts."""
    width = 3 + MOST_DISCOUNTED + 1
    found = rows.filter("kind = 'model'").agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    all_ = [int(x or 0) for x in found]
    return all_[0], all_[1], all_[2], all_[3:]


def perplexity(score: float, n_tokens: int) -> float:
    """Of a text by its log10 probability."""
    return math.pow(10.0, -score / max(1, n_tokens))
