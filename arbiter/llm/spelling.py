"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One edit changes the letter counts of a word little: a replaced letter takes one from a letter and adds one to another
(L1 distance two), an inserted letter adds one. So a word's neighbours lie in a small box around its
vector. Per length, the upper levels of a k-d tree (built on a bounded sample, splitting by "at least t times this
letter") deal the words into cells; a word is data in its own cell and a query in every cell whose box an edit
can reach, for its own length and for the next one. A task builds the tree of its cell's words further down, walks it with
all queries at once, pruning boxes by what is left of the edit, and verifies the order of the letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import stage

#: Words a task counts before it hands them on.
COUNTED_WORDS = 200_000
#: Words on which the upper trees are built (they only set the cells' sizes); words and bytes of letters a cell is meant to hold.
SAMPLE_WORDS, CELL_WORDS, CELL_BYTES = 100_000, 20_000, 32 << 20
#: Splits considered in a cell; words below which a box isn't split; pairs compared at once.
FEATURES, LEAF_WORDS, PAIRS = 192, 16, 1 << 18
#: Classes of letters: a-z, U+00C0 to U+00FF, and six for all others, which only makes boxes coarser.
CLASSES = 96

HOME, SAME, SHORTER = 0, 1, 2


def letter_codes(words: list[str], length: int) -> np.ndarray:
    """Code points, one row per word of that length."""
    return np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """The letter-count vector of every row."""
    c = codes.astype(np.int64)
    kind = np.where((c >= 97) & (c <= 122), c - 97, np.where((c >= 192) & (c <= 255), c - 166, 90 + c % 6))
    rows = np.arange(len(c))[:, None] * CLASSES
    return np.bincount((rows + kind).ravel(), minlength=len(c) * CLASSES).reshape(len(c), CLASSES)


def count_words(docs: DataFrame, id_col: str, text_col: str, min_chars: int, thin: int) -> DataFrame:
    """word, n over all whole texts; see ``variant_forms``. Tasks count before the shuffle, so no frequent word is hot."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_chars)).findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for at in range(batch.num_rows):
                doc, text = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                if not text:
                    continue
                start, kept = zlib.crc32(f"{doc or ''}:".encode()), []
                for run in runs(text.encode().lower().decode()):
                    h = zlib.crc32(run.encode(), start)
                    if h % thin == 0:
                        gone = h % len(run)
                        run = run[:gone] + run[gone + 1:]
                        if len(run) < min_chars:
                            continue
                    kept.append(run)
                found.update(kept)
                if len(found) >= COUNTED_WORDS:
                    yield made()
        if found:
            yield made()

    texts = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_tree(counts: np.ndarray, rows: float, most: float) -> list[tuple]:
    """The upper tree for about ``rows`` words, of which ``counts`` is a sample: nodes (class, times, low, high), where words
    with fewer than ``times`` letters of the class go low, and leaves (first cell, cells).

    A leaf is meant to hold ``most`` words. Words that no split tells apart are dealt to several cells of one leaf.
    """
    nodes: list[tuple] = []
    cells = 0

    def grow(part: np.ndarray) -> int:
        nonlocal cells
        at, size = len(nodes), rows * len(part) / max(1, len(counts))
        nodes.append(())
        best = None
        if size > most and len(part) > 1:
            for c in range(CLASSES):
                values = counts[part, c]
                for t in range(int(values.min()) + 1, int(min(values.max(), values.min() + 16)) + 1):
                    off = abs(2 * int((values >= t).sum()) - len(part))
                    if best is None or off < best[0]:
                        best = (off, c, t)
        if best is None:
            nodes[at] = (cells, max(1, int(-(-size // most))))
            cells += nodes[at][1]
        else:
            high = counts[part, best[1]] >= best[2]
            low_at = grow(part[~high])
            nodes[at] = (best[1], best[2], low_at, grow(part[high]))
        return at

    grow(np.arange(len(counts)))
    return nodes


def reached(tree: list[tuple], counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first cell, cells, rows) of every leaf whose box a row's vector reaches by ``up`` letters more and ``down`` fewer."""
    every = np.arange(len(counts))
    stack = [(0, every, np.full(len(counts), up, np.int8), np.full(len(counts), down, np.int8))]
    while stack:
        at, rows, more, fewer = stack.pop()
        node = tree[at]
        if len(node) == 2:
            yield node[0], node[1], rows
            continue
        c, t, low, high = node
        have = counts[rows, c]
        above = have >= t
        rise, fall = (have == t - 1) & (more > 0), (have == t) & (fewer > 0)
        for child, inside, over, spent in ((high, above, rise, (1, 0)), (low, ~above, fall, (0, 1))):
            go = inside | over
            if go.any():
                cost = over[go].astype(np.int8)
                stack.append((child, rows[go], more[go] - spent[0] * cost, fewer[go] - spent[1] * cost))


def deal(trees: dict[int, list[tuple]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words to (length, cell, role): data at home, queries in later cells of the same length and in the next length's."""
    whole = [(0, 1)]
    for batch in batches:
        length = batch.column(2).to_numpy(zero_copy_only=False)
        for size in np.unique(length):
            at = np.flatnonzero(length == size)
            words = batch.column(0).take(pa.array(at))
            text = words.to_pylist()
            counts = letter_counts(letter_codes(text, int(size)))
            block = np.array([zlib.crc32(w.encode()) for w in text], np.int64)
            own, out = np.zeros(len(at), np.int64), []
            tree = trees.get(int(size), whole)
            for first, cells, rows in reached(tree, counts, 0, 0):
                own[rows] = first + block[rows] % cells
            out.append((np.arange(len(at)), size, own, HOME))
            if tree is not whole:
                for first, cells, rows in reached(tree, counts, 1, 1):
                    for cell in range(first, first + cells):
                        later = rows[own[rows] < cell]
                        out.append((later, size, np.full(len(later), cell), SAME))
            for first, cells, rows in reached(trees.get(int(size) + 1, whole), counts, 1, 0):
                for cell in range(first, first + cells):
                    out.append((rows, size + 1, np.full(len(rows), cell), SHORTER))
            taken = np.concatenate([rows for rows, *_ in out])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.full(len(r), s, np.int32) for r, s, _, _ in out])),
                pa.array(np.concatenate([c for _, _, c, _ in out]).astype(np.int64)),
                pa.array(np.concatenate([np.full(len(r), k, np.int8) for r, _, _, k in out])),
                words.take(pa.array(taken)), batch.column(1).take(pa.array(at[taken]))], names=["length", "cell", "role", "word", "n"])


def _features(counts: np.ndarray) -> list[tuple[int, int]]:
    """(class, times) splits of a cell, the most even ones; any choice of them gives the same pairs."""
    out = []
    for c in np.flatnonzero(counts.any(axis=0)):
        low, high = int(counts[:, c].min()), int(counts[:, c].max())
        for t in range(low + 1, min(high, low + 24) + 1):
            share = float((counts[:, c] >= t).mean())
            out.append((share * (1 - share), int(c), t))
    return [(c, t) for _, c, t in sorted(out, reverse=True)[:FEATURES]]


def _pack(counts: np.ndarray, features: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    bits = np.zeros((len(counts), FEATURES), np.uint8)
    for i, (c, t) in enumerate(features):
        bits[:, i] = counts[:, c] >= t
    return bits, np.packbits(bits, axis=1).view(np.uint64)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer row is the shorter one with one letter put in: equal heads and tails cover the shorter one."""
    size = short.shape[1]
    head, tail = short == long[:, :-1], short[:, ::-1] == long[:, :0:-1]
    heads = np.where(head.all(axis=1), size, head.argmin(axis=1))
    tails = np.where(tail.all(axis=1), size, tail.argmin(axis=1))
    return heads + tails >= size


def near_pairs(data: np.ndarray, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``data``, rows of ``queries``) one edit apart, each pair once, by a range search of a k-d tree over ``data``.

    Rows are code points. ``up`` and ``down`` say how many letters the data may have more and fewer: 1 and 1 for words
    of one length (a letter replaced), 1 and 0 for data one letter longer.
    """
    if not len(data) or not len(queries):
        return
    counts = letter_counts(data)
    features = _features(counts)
    bits, packed = _pack(counts, features)
    asked, asked_packed = _pack(letter_counts(queries), features)
    verify = _replaced if down else _inserted
    few = max(1, PAIRS // max(1, data.shape[1]))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def verified() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if held:
            p, q = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            for at in range(0, len(p), few):
                a, b = p[at:at + few], q[at:at + few]
                good = verify(queries[b], data[a])
                yield a[good], b[good]

    stack = [(np.arange(len(data)), np.arange(len(queries)), np.full(len(queries), up, np.int8), np.full(len(queries), down, np.int8))]
    waiting = 0
    while stack:
        points, rows, more, fewer = stack.pop()
        split = -1
        if len(points) > LEAF_WORDS and len(points) * len(rows) > 2048 and features:
            ones = bits[points].sum(axis=0, dtype=np.int64)
            split = int(np.abs(2 * ones - len(points)).argmin())
            if ones[split] in (0, len(points)):
                split = -1
        if split >= 0:
            side, mine = bits[points, split] > 0, asked[rows, split] > 0
            for inside, part, left, spent in ((mine, points[side], more, (1, 0)), (~mine, points[~side], fewer, (0, 1))):
                go = inside | (left > 0)
                cost = (~inside[go]).astype(np.int8)
                if go.any():
                    stack.append((part, rows[go], more[go] - spent[0] * cost, fewer[go] - spent[1] * cost))
            continue
        step = max(1, PAIRS // len(rows))
        for at in range(0, len(points), step):
            part = points[at:at + step]
            gain, loss = np.zeros((len(rows), len(part)), np.uint8), np.zeros((len(rows), len(part)), np.uint8)
            for k in range(packed.shape[1]):
                p, q = packed[part, k][None, :], asked_packed[rows, k][:, None]
                gain += np.bitwise_count(p & ~q)
                loss += np.bitwise_count(q & ~p)
            q, p = np.nonzero((gain <= up) & (loss <= down))
            held.append((part[p], rows[q]))
            waiting += len(p)
            if waiting >= 4 * few:
                yield from verified()
                waiting = 0
    yield from verified()


def search(table: pa.Table) -> pa.Table:
    """One cell: per word found in it, the near words found here and the best of them (most frequent, then smallest)."""
    length = table["length"][0].as_py()
    role = table["role"].to_numpy()
    words, n = np.array(table["word"].to_pylist(), dtype=object), table["n"].to_numpy()
    order = np.argsort(role, kind="stable")
    words, n, role = words[order], n[order], role[order]
    split = int((role < SHORTER).sum())
    home = int((role == HOME).sum())
    same = letter_codes(words[:split].tolist(), length)
    short = letter_codes(words[split:].tolist(), length - 1) if split < len(words) else np.zeros((0, max(0, length - 1)), np.uint32)
    # the place of every word in the order of preference: rare ones first, of equally frequent ones the smallest last
    by_word = sorted(range(len(words)), key=words.__getitem__, reverse=True)
    preference = np.array(sorted(by_word, key=n.__getitem__), np.int64)
    place = np.empty(len(words), np.int64)
    place[preference] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)

    def take(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in ((a, b), (b, a)):
            near[:] += np.bincount(x, minlength=len(near))
            np.maximum.at(best, x, place[y])

    for p, q in near_pairs(same[:home], same, 1, 1):
        once = p < q  # queries of other cells come after the home words, which meet each other twice
        take(p[once], q[once])
    if length > 1:
        for p, q in near_pairs(same[:home], short, 1, 0):
            take(p, q + split)
    shown = np.flatnonzero((role == HOME) | (near > 0))
    form = [preference[i] if i >= 0 else -1 for i in best[shown].tolist()]
    return pa.table({
        "word": pa.array(words[shown].tolist(), pa.string()), "n": pa.array(n[shown], pa.int64()),
        "n_near": pa.array(near[shown], pa.int64()),
        "best_n": pa.array([int(n[i]) if i >= 0 else None for i in form], pa.int64()),
        "best": pa.array([words[i] if i >= 0 else None for i in form], pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """``words``: distinct word, n. Adds n_near (words one edit away), best and best_n (the most frequent of them, on a tie the
    smallest; null without any). Words are of one letter at least."""
    sized = words.select("word", "n", F.length("word").alias("size"))
    large = {r["size"]: r["count"] for r in sized.groupBy("size").count()
             .filter(F.col("count") > _cell_words(F.col("size"))).collect()}  # fewer than words / CELL_WORDS rows
    trees: dict[int, list[tuple]] = {}
    if large:
        total = sum(large.values())
        share = min(1.0, SAMPLE_WORDS / total)
        some = sized.filter(F.col("size").isin(list(large))).filter(
            F.xxhash64("word", F.lit("tree")).cast("double") / 2.0 ** 64 + 0.5 < share).select("word", "size").collect()
        by_size: dict[int, list[str]] = {}
        for r in some:
            by_size.setdefault(r["size"], []).append(r["word"])
        for size, sample in by_size.items():
            most = max(1, min(CELL_WORDS, CELL_BYTES // (4 * size)))
            trees[size] = build_tree(letter_counts(letter_codes(sorted(sample), size)), large[size], most)
    dealt = (sized.sortWithinPartitions("size").mapInArrow(
        partial(deal, trees), "length int, cell long, role byte, word string, n long"))
    found = dealt.groupBy("length", "cell").applyInArrow(search, "word string, n long, n_near long, best_n long, best string")
    top = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))))
    return (found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n", "n_near", F.col("top.w").alias("best"), (-F.col("top.n")).alias("best_n")))


def _cell_words(size: Column) -> Column:
    return F.least(F.lit(CELL_WORDS), F.lit(CELL_BYTES) / (4 * size))


def roots(links: DataFrame) -> DataFrame:
    """``links``: word, form, without cycles. Returns word, root: where following the forms ends.

    Every round doubles the steps that a row has gone. A form is ten times as frequent as its word, so that
    five rounds go beyond every chain of 64-bit counts.
    """
    gone = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = gone.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        gone = stage(gone.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        if gone.filter("moved").isEmpty():
            return gone.select("word", "root")
        gone = gone.select("word", "root")


def variant_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2,
                  thin: int = 31, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Words are maximal runs of ``[A-Za-zÀ-ÿ]`` with only A-Z lower-cased. Where the CRC-32 h of ``<id>:<run>`` is
    divisible by ``thin``, the run loses its code point at h modulo its length. Kept are results of at least ``min_chars`` code
    points that occur ``min_count`` times or more (n). ``form`` is the most frequent word one edit away (inserted, deleted or replaced
    code point; ties: the smallest by code point) when it is at least ``times`` times as frequent, else null. ``root`` follows the forms to the last.

    Null and empty texts have no words and a null id counts as empty text; texts of any length are read whole.
    Rows repeated with one id and text count each time. An empty table gives no rows. Other columns aren't looked at.
    """
    words = stage(count_words(docs, id_col, text_col, min_chars, thin).filter(F.col("n") >= min_count), "spelling-words")
    near = stage(near_words(words), "spelling-near")
    is_form = F.col("best_n") >= times * F.col("n")
    formed = near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near",
                         F.when(is_form, F.col("best_n")).alias("form_n"))
    ends = roots(formed.filter("form is not null").select("word", "form"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
