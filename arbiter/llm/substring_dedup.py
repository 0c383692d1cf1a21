"""Substring de-duplication: repeated-phrase automata.

A passage is a window of ``window`` consecutive words; a word goes when a window over it also starts
anywhere else. The way there:

1. Recurring phrases. Of every window the phrase of ``phrase`` words with the least hash is taken (a
   minimiser: equal windows choose equal phrases, about one word in fifteen starts one). Phrases taken twice or
   more in the corpus are confirmed as recurring; a window whose phrase isn't among them is unique.
2. Automata. Documents are dealt to shards; each shard gets the recurring phrases that its documents
   hold, compiles them into one Aho-Corasick automaton over word numbers, and streams all its documents through it
   to locate every occurrence. A shard's automaton is bounded by the shard's own text.
3. Exact check. Windows whose phrase was located are counted by two independent hashes (64 and 32 bits); those that start once are
   taken back, with the place that the count itself carries, so nothing is joined window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.llm.common import map_rows, shard_count, utf8

#: Bytes of input per shard, by Catalyst's estimate.
SHARD_BYTES = 8 << 20
CHUNK = 1 << 16
NONE = np.uint64(2 ** 64 - 1)
#: Stands between documents; no word is a space.
GAP = b" "


def word_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word, the halves of one of 128 bits.

    Hashed anew each time: on the supplied texts that takes a third of the time of a dictionary of 100,000 words.
    """
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


@lru_cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    up = np.cumprod(np.full(n, base, np.uint64))
    return up, np.cumprod(np.full(n, pow(base, -1, 2 ** 64), np.uint64))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of k words (polynomial modulo 2^64, then mixed)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(CHUNK + k)
    out = np.empty(n, np.uint64)
    for at in range(0, n, CHUNK):
        part = hashes[at:at + CHUNK + k - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)], dtype=np.uint64)))
        m = len(part) - k + 1
        out[at:at + m] = (sums[k:] - sums[:-k]) * down[:m]
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(29)
    return out


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` neighbours, by doubling."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = pick(out[:-step], out[step:])
        span += step
    return out


def chosen(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least phrase hash of every window, and the positions of phrases that are the least of some window."""
    least = sliding(grams, width, np.minimum)
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return least, np.flatnonzero(sliding(padded, width, np.maximum) == grams)


def _phrases(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """shard, phrase: the phrases that the windows of every document choose (words joined by a space)."""
    def choose(shard, text):
        words = text.split()
        if len(words) < window:
            return
        _, at = chosen(rolling(word_hashes(words)[0], phrase), window - phrase + 1)
        for i in at.tolist():
            yield shard, b" ".join(words[i:i + phrase])

    return map_rows(docs.select("shard", "body"), choose, "shard int, phrase binary", rows=64)


class PhraseAutomaton:
    """Aho-Corasick over words: a known word is spelled by a few letters, each place from an alphabet of its own.

    Small alphabets keep the branches of a node few (pyahocorasick goes through them one by one), and
    letters of different places can't be mistaken, so every match starts and ends with a word. Words are known by
    their hash: where two share one, occurrences are found for both, which the count of windows takes back.
    """

    BASE = 64

    def __init__(self, phrases: list[bytes]):
        split = [p.split(b" ") for p in phrases]
        hashed = word_hashes(list(dict.fromkeys(w for p in split for w in p)))[0]
        self.known = np.unique(hashed)
        self.places = 1
        while self.BASE ** self.places < len(self.known):
            self.places += 1
        # as the last row: an unknown word is one letter, which no phrase holds
        number = np.arange(len(self.known))[:, None] // self.BASE ** np.arange(self.places) % self.BASE
        self.letters = np.vstack((1 + number + self.BASE * np.arange(self.places), np.zeros((1, self.places)))).astype("<u4")
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        text, after = self._text(word_hashes([w for p in split for w in p])[0])
        ends = after[np.cumsum([len(p) for p in split]) - 1].tolist()
        for a, b in zip([0, *ends], ends):
            self.machine.add_word(text[a:b], 1)
        self.machine.make_automaton()

    def _text(self, hashed: np.ndarray) -> tuple[str, np.ndarray]:
        """The letters of all words, and where each word's letters end."""
        at = np.searchsorted(self.known, hashed)
        at[at == len(self.known)] = 0
        known = self.known[at] == hashed
        at[~known] = len(self.known)
        letters = self.letters[at]
        there = np.ones(letters.shape, bool)
        there[:, 1:] = known[:, None]
        return letters[there].tobytes().decode("utf-32-le"), np.cumsum(np.where(known, self.places, 1))

    def ends(self, hashed: np.ndarray) -> np.ndarray:
        """The index of the last word of every occurrence of a phrase in the words of these hashes."""
        text, after = self._text(hashed)
        return np.searchsorted(after, np.array([at + 1 for at, _ in self.machine.iter(text)], np.int64))


def _locate(window: int, phrase: int):
    """One shard: its rows and its recurring phrases -> key, mark, h, h2.

    A mark is pos << 32 | len. With len 0 a candidate window at ``pos`` and its two hashes; otherwise ``len``
    candidate windows in a row from ``pos``. A candidate is a window whose own phrase was located.
    """
    width = window - phrase + 1

    def spans(keys, gaps, words, machine):
        """Documents one after the other, a gap after each: what holds a gap is no window."""
        first, second = word_hashes(words)
        found = machine.ends(first) - (phrase - 1)
        if not len(found):
            return None
        grams = rolling(first, phrase)
        there = np.full(len(grams), NONE, np.uint64)
        there[found] = grams[found]
        fit = sliding(there, width, np.minimum) == sliding(grams, width, np.minimum)
        for gap in gaps:
            fit[gap - window + 1:gap + 1] = False
        edge = np.diff(np.concatenate(([0], fit.view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.flatnonzero(fit)
        none = np.zeros(len(starts), np.int64)
        second = rolling(second, window)[at] >> np.uint64(32)  # zeros beside the empty column compress
        h, h2 = (np.concatenate((x.view(np.int64), none)) for x in (rolling(first, window)[at], second))
        # places count from the document's first word
        doc = np.searchsorted(gaps, np.concatenate((at, starts)))
        pos = np.concatenate((at, starts)) - np.concatenate(([0], np.array(gaps[:-1], np.int64) + 1))[doc]
        h[len(at):] = pos[len(at):]
        return np.array(keys)[doc], pos << 32 | np.concatenate((np.zeros(len(at), np.int64), ends - starts)), h, h2

    def run(rows: pa.Table, phrases: pa.Table) -> pa.Table:
        made = [[np.empty(0, np.int64)] for _ in range(4)]
        if phrases.num_rows:
            machine = PhraseAutomaton(phrases["phrase"].to_pylist())
            for part in _batches(rows, window):
                if (found := spans(*part, machine)) is not None:
                    for column, values in zip(made, found, strict=True):
                        column.append(values)
        return pa.table([np.concatenate(c) for c in made], names=["key", "mark", "h", "h2"])

    return run


def _batches(table: pa.Table, window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Keys, places of gaps and words of a shard's rows that hold a window, about 2 * CHUNK words at a time."""
    keys, gaps, words = [], [], []
    for key, text in _rows(table):
        split = text.split()
        if len(split) < window:
            continue
        words += split
        keys.append(key)
        gaps.append(len(words))
        words.append(GAP)
        if len(words) > 2 * CHUNK:
            yield keys, gaps, words
            keys, gaps, words = [], [], []
    if keys:
        yield keys, gaps, words


def _rows(table: pa.Table) -> Iterator[tuple[int, bytes]]:
    """(key, text) of a shard's rows, some at a time."""
    for at in range(0, table.num_rows, 256):
        part = table.slice(at, 256)
        texts = part["_row"].combine_chunks().field("text").cast(pa.binary())
        yield from zip(part["_key"].to_pylist(), (t or b"" for t in texts.to_pylist()), strict=True)


def _kept(words: list[bytes], marks: np.ndarray, window: int) -> list[bytes]:
    """The words that no repeated window covers. marks: pos << 32 | len, runs of candidates and (len 0) windows
    that start only once."""
    pos, length = marks >> 32, marks & 0xFFFFFFFF
    again = np.zeros(len(words) + 1, np.int64)
    runs = length > 0
    np.add.at(again, pos[runs], 1)
    np.add.at(again, pos[runs] + length[runs], -1)
    again = np.cumsum(again)[:-1] > 0
    again[pos[~runs]] = False
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    cover[at] += 1
    cover[at + window] -= 1
    return [w for w, c in zip(words, np.cumsum(cover)[:-1].tolist()) if not c]


def _cut(names: list[str], window: int):
    """One shard: its rows and the marks on them -> the rows with their texts cut."""
    def run(rows: pa.Table, marks: pa.Table) -> pa.Table:
        order = np.argsort(keys := marks["key"].to_numpy(), kind="stable")
        keys, values = keys[order], marks["mark"].to_numpy()[order]
        total, stay, texts = [], [], []
        for key, text in _rows(rows):
            words = text.split()
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            kept = _kept(words, values[low:high], window) if high > low else words
            total.append(len(words))
            stay.append(len(kept))
            texts.append(b" ".join(kept))
        whole = rows["_row"].combine_chunks()
        columns = [pa.array(texts, pa.binary()).cast(pa.string()) if c == "text" else whole.field(c) for c in names]
        return pa.table([*columns, pa.array(total, pa.int64()), pa.array([t - s for t, s in zip(total, stay)], pa.int64())],
                        names=[*names, "n_words", "n_removed"])

    return run


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                    phrase: int = 6) -> DataFrame:
    """``docs`` with ``text_col`` cut to the words that stay, joined by one space; adds n_words and n_removed.

    Words are parted by ASCII white space and compared unchanged. Every word goes that a repeated window
    covers: a window of ``window`` words whose sequence also starts anywhere else, in another row or the
    same. Windows are judged on the input. Null and empty texts have no words and come out empty; texts
    shorter than a window lose nothing; rows repeated with one id and text count as two documents, both of
    which lose what they share. An empty table gives no rows. Columns with other names pass through.
    Windows are compared by 96 bits of two independent hashes (10^10 candidate windows: one false meeting in 10^9 corpora); a
    row's marks find it by a 64-bit hash of id and text.
    """
    base = docs.drop("n_words", "n_removed").withColumnRenamed(text_col, "text")
    names, shards = base.columns, shard_count(docs, SHARD_BYTES, 64)
    shard = lambda key: F.pmod(F.hash(key), F.lit(shards)).cast("int")
    keyed = base.withColumn("_key", F.xxhash64(F.col(id_col), F.col("text")))
    # both uses of the dealt rows read one shuffle: the row travels as one value
    dealt = keyed.select(shard(F.col("_key")).alias("_shard"), "_key", F.struct(*names).alias("_row")).repartition(shards, "_shard")
    chosen_ = _phrases(keyed.select(shard(F.col("_key")).alias("shard"), utf8(F.col("text")).alias("body")), window, phrase)
    recurring = chosen_.groupBy("phrase").agg(F.count("*").alias("n"), F.collect_set("shard").alias("shards")).filter("n > 1")
    held = recurring.select(F.explode("shards").alias("_of"), "phrase")
    located = (dealt.groupBy("_shard").cogroup(held.groupBy("_of"))
               .applyInArrow(_locate(window, phrase), "key long, mark long, h long, h2 long"))
    # a window that starts once carries its place in the count; rows of runs are groups of their own
    run = F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF)) > 0
    counted = (located.groupBy("h", "h2", F.when(run, F.col("key")).alias("of"))
               .agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("mark").alias("mark")).filter("of is not null or n = 1"))
    marks = counted.select(shard(F.col("key")).alias("_of"), "key", "mark")
    made = dealt.groupBy("_shard").cogroup(marks.groupBy("_of")).applyInArrow(_cut(names, window), T.StructType(
        [*base.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]))
    return made.withColumnRenamed("text", text_col)
