"""SentencePiece encoding and decoding through a relational lattice.

Words (a run of spaces and what follows it, up to a character that no piece joins to the ones before) are told apart
per shard of documents. Words that aren't frequent are cut once more, into parts: between neighbours that no piece
holds side by side. Every substring of a part that may be a piece by its length and first characters is exploded and
equi-joined to the table of pieces that a best path may hold: the edges of the part's lattice. Edges are grouped by part, and a Viterbi fold with
Spark's higher-order ``aggregate`` finds the path of the highest total score. Documents are then spelled with
their shard's parts.

The segmentation is the one of the highest score over the model's pieces, as SentencePiece's unigram models
define it, with byte pieces for characters that have none. Pieces never hold a space after another character,
and none crosses a cut, so every path passes there: words and parts are independent of each other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import shard_count, stage

#: The model file of the registered queries; any SentencePiece model with byte pieces will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of the bounded sample that are spelled once for all shards.
COMMON_WORDS, SAMPLE_DOCS = 200_000, 20_000
#: Bytes of input per shard, by Catalyst's estimate.
SHARD_BYTES = 3 << 19
#: Longer words are folded by the same recurrence in a UDF: the fold copies its state at every step.
LONG_WORD = 256
SPACE = "▁"
#: The first HEAD characters of a substring bound its length as a piece; the bounds lie in BUCKETS places by CRC-32.
HEAD, BUCKETS = 3, 1 << 16


def _chars(chars: set[str]) -> str:
    """The inside of a regular expression's character class, in runs of neighbours."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join("-".join(re.escape(chr(c)) for c in dict.fromkeys(run)) for run in runs)


class Pieces:
    """The piece table of a model file: read once on the driver, 32,000 rows or so."""

    def __init__(self, model_file: str = MODEL):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.byte, self.ids, self.text = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = (i, float(model.get_score(i)))
                self.text[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids))
        #: Score of spelling one character with byte pieces: below every piece.
        self.fallback = min(s for _, s in self.ids.values()) - 10.0

    @cached_property
    def useful(self) -> dict[str, tuple[int, float]]:
        """The pieces that a best path may hold: those whose own text no other pieces spell at a higher score. Any path
        through one of the rest scores less than the same path with that spelling instead, so no best path is lost."""
        kept: dict[str, tuple[int, float]] = {}
        # sums of scores along a path may be off by so much: a lead must be larger
        slack = LONG_WORD ** 2 * 2.0 ** -52 * max(abs(self.fallback), *(abs(s) for _, s in self.ids.values()))
        for piece in sorted(self.ids, key=len):
            best = [0.0]  # the score of every beginning, spelled by shorter useful pieces
            for end in range(1, len(piece) + 1):
                found = ((best[start], kept.get(piece[start:end])) for start in range(end))
                best.append(max([best[end - 1] + self.fallback, *(before + f[1] for before, f in found if f)]))
            if len(piece) == 1 or best[-1] <= self.ids[piece][1] + slack:
                kept[piece] = self.ids[piece]
        return kept

    def table(self, spark: SparkSession) -> DataFrame:
        """The useful pieces."""
        return spark.createDataFrame([(p, i, s) for p, (i, s) in self.useful.items()], "piece string, id int, score double")

    @cached_property
    def word(self) -> str:
        """A word: spaces and the characters after them that pieces join, directly or through others (a Java and Python pattern)."""
        group: dict[str, set[str]] = {}
        for piece in self.ids:
            chars = set(piece.lstrip(SPACE))
            if len(piece.lstrip(SPACE)) > 1 and not chars <= group.get(min(chars), set()):
                joined = chars.union(*(group.get(c, ()) for c in chars))
                group.update(dict.fromkeys(joined, joined))
        groups = sorted({min(g): g for g in group.values()}.values(), key=lambda g: (-len(g), min(g)))
        some = [f"[{_chars(g)}]+" for g in groups]
        return f"{SPACE}*(?:{'|'.join([*some, f'[^{SPACE}{_chars(set(group))}]'])})|{SPACE}+"

    @cached_property
    def part(self) -> str:
        """A part of a word: characters of which any two neighbours lie side by side in a piece."""
        after, uses = defaultdict(set), Counter()
        for piece in self.ids:
            uses.update(piece[:-1])
            for a, b in zip(piece, piece[1:]):
                after[a].add(b)
        alike: dict[frozenset, set[str]] = defaultdict(set)
        for a, bs in after.items():
            alike[frozenset(bs)].add(a)
        # no character is in two ways, so their order is free: those of which most pieces are made are tried first
        ways = sorted(alike.items(), key=lambda x: (-sum(uses[a] for a in x[1]), min(x[1])))
        return f"(?:{'|'.join(f'[{_chars(a)}](?=[{_chars(set(bs))}])' for bs, a in ways)})*(?s:.)" if ways else "(?s:.)"

    def bounds(self) -> Column:
        """By bucket of a substring's first HEAD characters: the longest useful piece that may begin so, HEAD - 1 at least."""
        most = [HEAD - 1] * BUCKETS
        for piece in self.useful:
            if len(piece) >= HEAD:
                at = zlib.crc32(piece[:HEAD].encode()) % BUCKETS
                most[at] = max(most[at], len(piece))
        return F.split(F.lit(",".join(map(str, most))), ",").cast("array<int>")

    def spell(self, word: str) -> list[int]:
        """The best path of one word by plain dynamic programming."""
        best, back = [0.0], [(0, -1)]
        for end in range(1, len(word) + 1):
            top, at = best[end - 1] + self.fallback, (end - 1, -1)
            for start in range(end - 1, max(-1, end - self.longest - 1), -1):
                found = self.ids.get(word[start:end])
                if found and best[start] + found[1] >= top:
                    top, at = best[start] + found[1], (start, found[0])
            best.append(top)
            back.append(at)
        out, end = [], len(word)
        while end:
            start, i = back[end]
            out.append([i] if i >= 0 else [self.byte[b] for b in word[start:end].encode()])
            end = start
        return [i for part in reversed(out) for i in part]

    def decode(self, ids) -> str:
        """The text of ids: byte pieces joined to characters, the leading space of the first word dropped."""
        text = b"".join(self.text.get(i, b"") for i in ids).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache
def _pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _words(text: Column, pieces: Pieces) -> Column:
    """The words of a text with its leading space; an empty text has none."""
    return F.when(F.length(text) > 0, F.regexp_extract_all(
        F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))), F.lit(pieces.word), 0)).otherwise(F.array().cast("array<string>"))


def _runs(text: Column) -> Column:
    """A text with its leading space, parted before every space that follows something else: each run's words are the text's."""
    parted = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(" " + SPACE)))  # a blank before every space ...
    first = F.replace(parted, F.lit(SPACE + " "), F.lit(SPACE))  # ... but not between two
    return F.when(F.length(text) > 0, F.split(first, " ")).otherwise(F.array().cast("array<string>"))


def _parts(word: Column, pieces: Pieces) -> Column:
    """The parts of a word; a word over LONG_WORD is left out."""
    return F.when(F.length(word) <= LONG_WORD, F.regexp_extract_all(word, F.lit(pieces.part), 0)).otherwise(
        F.array().cast("array<string>"))


def _viterbi(edges: Column) -> Column:
    """Piece ids of the best path; negative ids are kept as they are.

    ``edges``: (end, start, id, score) sorted by end, start. One fold keeps the best score to every place of the word,
    a second one goes back from the end along edges that reach theirs with that score; on a tie the longest piece.
    Paths aren't carried along, so a step of the first fold copies scores alone, and only where a place's score changes.
    """
    def best(scores, e):
        score = F.get(scores, e["start"]) + e["score"]
        return (F.when(F.size(scores) <= e["end"], F.array_append(scores, score))
                .when(score > F.get(scores, e["end"]), F.array_append(F.slice(scores, F.lit(1), e["end"]), score))
                .otherwise(scores))

    def path(scores):
        def step(at, e):
            tight = F.get(scores, e["start"]) + e["score"] == F.get(scores, e["end"])
            by = lambda ids: F.struct(e["start"].alias("place"), e["end"].alias("left"), F.array_append(ids, e["id"]).alias("ids"))
            return (F.when((e["end"] == at["place"]) & tight, by(at["ids"]))
                    # a longer piece to the place just left
                    .when((e["end"] == at["left"]) & tight, by(F.slice(at["ids"], F.lit(1), F.size(at["ids"]) - 1)))
                    .otherwise(at))
        zero = F.struct((F.size(scores) - 1).alias("place"), F.lit(-1).alias("left"), F.array().cast("array<int>").alias("ids"))
        return F.aggregate(F.reverse(edges), zero, step, lambda at: F.reverse(at["ids"]))

    return F.aggregate(edges, F.array(F.lit(0.0)), best, path)


def spell_words(words: DataFrame, pieces: Pieces, by: list[str]) -> DataFrame:
    """``by``, word -> ``by``, word, ids. Rows are distinct in ``by`` and word, and partitioned by ``by``, which the
    lattice keeps: edges are grouped where the words lie. Words over LONG_WORD are left out.

    Substrings meet the pieces by their 64-bit hash and are compared then: a join by one long is the cheapest. Pieces of
    one hash would only add edges of the fallback's score, which no path prefers."""
    table = F.broadcast(pieces.table(words.sparkSession).select(  # as many rows as the model has pieces, at most
        F.xxhash64("piece").alias("key"), F.col("piece").alias("held"), "id", "score"))
    numbered = words.filter(F.length("word") <= LONG_WORD).withColumn("_w", F.monotonically_increasing_id())
    starts = (numbered.select("*", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
              .withColumn("rest", F.substring("word", F.col("start") + 1, F.lit(max(map(len, pieces.useful))))))
    bucket = F.pmod(F.crc32(F.substring("rest", 1, HEAD)), F.lit(BUCKETS)).cast("int")
    room = F.least(F.get(pieces.bounds(), bucket), F.length("rest"))
    first = F.when(F.col("start") == 0, F.col("word")).alias("word")  # the other edges needn't carry it
    spans = starts.select("_w", *by, first, "start", "rest", F.explode(F.sequence(F.lit(1), room)).alias("n"))
    piece = F.substring("rest", F.lit(1), F.col("n"))
    found = spans.withColumn("piece", piece).withColumn("key", F.xxhash64("piece")).join(table, "key", "left")
    same = F.col("held").eqNullSafe(F.col("piece"))
    # a single character without a piece is spelled by bytes: -1 - start
    edge = F.struct((F.col("start") + F.col("n")).alias("end"), F.col("start"), F.when(same, F.col("id")).otherwise(-1 - F.col("start")).alias("id"),
                    F.when(same, F.col("score")).otherwise(pieces.fallback).alias("score"))
    edges = found.filter(same | (F.col("n") == 1)).select("_w", *by, "word", edge.alias("edge"))
    lattice = edges.groupBy("_w", *by).agg(F.first("word", ignorenulls=True).alias("word"),
                                           F.sort_array(F.collect_list("edge")).alias("edges"))
    return lattice.select(*by, "word", _viterbi(F.col("edges")).alias("ids"))


def _spelled(words: list[str], ids: pa.ListArray, pieces: Pieces) -> dict[str, bytes]:
    """The ids of every word's path as 32-bit integers, places spelled by bytes filled in."""
    if not words:
        return {}
    values, edges = ids.flatten().to_numpy().astype("<i4"), ids.offsets.to_numpy() - ids.offsets[0].as_py()
    whole, out = values.tobytes(), {}
    spare = np.add.reduceat(values < 0, edges[:-1]) > 0  # every word has a piece
    for word, a, b, fill in zip(words, edges[:-1].tolist(), edges[1:].tolist(), spare.tolist(), strict=True):
        if fill:
            path = [j for i in values[a:b].tolist() for j in ([i] if i >= 0 else [pieces.byte[c] for c in word[-1 - i].encode()])]
            out[word] = np.array(path, "<i4").tobytes()
        else:
            out[word] = whole[4 * a:4 * b]
    return out


def _one(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return whole.chunk(0) if isinstance(whole, pa.ChunkedArray) and whole.num_chunks else whole


def common_words(docs: DataFrame, pieces: Pieces, sample_docs: int, most: int) -> DataFrame:
    """word, ids of the words most frequent in about ``sample_docs`` documents, ``most`` at most (ties by word). A part counts
    once for every different word that it is cut from."""
    total = docs.count()
    share = min(1.0, sample_docs / total) if total else 1.0
    some = docs.filter(F.xxhash64("_id", F.lit("sample")).cast("double") / 2.0 ** 64 + 0.5 < share)
    counted = some.select(F.explode(_words(F.col("_text"), pieces)).alias("word")).groupBy("word").count()
    parts = F.transform(_parts(F.col("word"), pieces), lambda part: F.struct(part.alias("word"), F.lit(1).cast("long").alias("count")))
    each = counted.select(F.inline(F.concat(F.array(F.struct("word", "count")), F.when(F.size(parts) > 1, parts).otherwise(F.slice(parts, 1, 0)))))
    top = stage(each.groupBy("word").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "word").limit(most).select("word"),
                "common-words")
    return stage(spell_words(top, pieces, []), "common-spelled")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL,
           common: int = COMMON_WORDS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``id_col``, n_tokens, ids (array of ints) per input row.

    Null and empty texts have no tokens. Of paths of equal score the one with the longest last piece is
    taken, then the longest before it. Words and parts among the ``common`` most frequent of a bounded sample are spelled
    once and broadcast; the parts of every other word are spelled in its shard; the result is the same. Rows repeat as they
    came; an empty table gives no rows; other columns aren't looked at. A text that holds U+2581 decodes
    with a space in its place, as SentencePiece does it.
    """
    pieces = _pieces(model_file)
    shards = shard_count(docs, SHARD_BYTES, 64)
    slim = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    known = common_words(slim, pieces, sample_docs, common)
    # id and text travel as one array: both uses of the dealt documents then read one and the same shuffle
    dealt = slim.select(F.pmod(F.xxhash64("_id", "_text"), F.lit(shards)).cast("int").alias("_part"),
                        F.array(F.col("_id").cast("string"), F.col("_text")).alias("_doc")).repartition(shards, "_part")
    rare = lambda words: words.distinct().join(F.broadcast(known.select("word")), "word", "left_anti").select("_part", "word")
    # a run is searched for words once a shard, not wherever it stands, and not at all if it is a known word
    runs = rare(dealt.select("_part", F.explode(_runs(F.get("_doc", F.lit(1)))).alias("word")))
    words = rare(runs.select("_part", F.explode(F.regexp_extract_all("word", F.lit(pieces.word), F.lit(0))).alias("word")))
    words = rare(words.select("_part", F.explode(_parts(F.col("word"), pieces)).alias("word")))
    spelled = spell_words(words, pieces, ["_part"]).withColumnRenamed("_part", "_of")
    rows = known.toArrow().combine_chunks()  # at most ``common`` rows
    shared = docs.sparkSession.sparkContext.broadcast(_spelled(rows["word"].to_pylist(), _one(rows["ids"]), pieces))
    id_type = docs.schema[id_col].dataType.simpleString()

    def spell(texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        model = _pieces(model_file)
        own = _spelled(dictionary["word"].to_pylist(), _one(dictionary["ids"]), model)
        split, cut, common_ids = re.compile(model.word).findall, re.compile(model.part).findall, shared.value

        def part_ids(part: str) -> bytes:
            found = own.get(part) or common_ids.get(part)
            if found is None:
                raise KeyError(f"the lattice has no path for {part!r}")
            return found

        def ids_of(word: str) -> bytes:
            found = common_ids.get(word) or own.get(word)
            if found is None:
                found = own[word] = (b"".join(map(part_ids, cut(word))) if len(word) <= LONG_WORD
                                     else np.array(model.spell(word), "<i4").tobytes())
            return found

        flat, sizes, docs = [], [], _one(texts["_doc"]).flatten()
        for at in range(1, len(docs), 512):
            for text in docs.slice(at, 511)[::2].to_pylist():
                made = b"".join(map(ids_of, split(SPACE + text.replace(" ", SPACE)))) if text else b""
                flat.append(made)
                sizes.append(len(made) // 4)
        values = pa.array(np.frombuffer(b"".join(flat), "<i4"))
        edges = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        return pa.table({"id": docs[::2], "n_tokens": pa.array(sizes, pa.int64()),
                         "ids": pa.ListArray.from_arrays(edges, values)})

    return (dealt.groupBy("_part").cogroup(spelled.groupBy("_of"))
            .applyInArrow(spell, "id string, n_tokens long, ids array<int>")
            .select(F.col("id").cast(id_type).alias(id_col), "n_tokens", "ids"))


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text", model_file: str = MODEL) -> DataFrame:
    """``encoded`` with ``out_col``, the text of its ids; null ids give null, ids that the model lacks nothing.

    Column expressions only: the pieces' bytes are one constant array, so no Python worker runs.
    """
    pieces = _pieces(model_file)
    table = F.split(F.lit(",".join(pieces.text.get(i, b"").hex() for i in range(max(pieces.text) + 1))), ",")
    whole = F.array_join(F.transform(F.col(ids_col), lambda i: F.when(i >= 0, F.get(table, i))), "")
    text = F.make_valid_utf8(F.unhex(whole).cast("string"))
    return encoded.withColumn(out_col, F.regexp_replace(text, "^ ", ""))
