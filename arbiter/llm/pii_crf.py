"""Personal data by base patterns and a skip-chain conditional random field.

Base spans come from four patterns. The field then labels the document's other tokens that carry a digit or
an ``@`` (tokens without either can't be personal data here, so they are fixed to "none"). Its potentials:

* token: weights of the token's shape;
* chain: between neighbouring tokens of the text;
* skip: between a token and the hub of all tokens that repeat or resemble it (the same letters and digits, or
  the same last seven digits), which makes labels agree across the document, at any distance.

Tokens within base spans are evidence; they settle the label of their hub. Loopy belief propagation spreads it
until the messages settle; a token whose belief in a kind reaches ``sure`` becomes a span of that kind. Weights are
trained by pseudo-likelihood on a bounded sample of documents, with the base spans as labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import map_rows, stage

#: Documents the field is fitted on, about (taken by a hash of the id).
FIT_DOCS = 20_000
KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)  # the label of every other token

# The base patterns. Parts that can't give back are possessive, which finds the same matches
# without going over a long run again from each of its characters.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
CANDIDATE = re.compile(r"[0-9@]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base span, by start, then kind as listed."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if CANDIDATE.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                  if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


SHAPES = ["bias", "at", "dots", "plus", "bracket", "hyphen", "letters", "equals", "digits_1", "digits_2_3", "digits_4_6",
          "digits_7_8", "digits_9_11", "digits_12_19", "digits_20", "only_digits", "grouped", "domain"]


def shape(token: str) -> list[float]:
    """The token's features, in the order of SHAPES."""
    n = sum(c.isdigit() for c in token)
    core = token.strip(".,;:!?()[]\"'")
    return [1.0, "@" in token, token.count(".") >= 3, token.startswith("+"), "(" in token or ")" in token, "-" in token,
            any(c.isalpha() for c in token), "=" in token, n == 1, 2 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11,
            12 <= n <= 19, n >= 20, core.isdigit(), bool(re.fullmatch(r"\d{3}-\d{4}", core)),
            "@" in core and "." in core.rpartition("@")[2]]


class Field:
    """The candidate tokens of one document with their ties and evidence."""

    def __init__(self, text: str, spans: list[tuple[str, int, int]]):
        self.tokens, order, at = [], [], 0
        for i, m in enumerate(TOKEN.finditer(text)):
            if CANDIDATE.search(m.group()):
                self.tokens.append((m.start(), m.end(), m.group()))
                order.append(i)
        self.labels = np.full(len(self.tokens), NONE)
        for k, (a, b, _) in enumerate(self.tokens):
            while at < len(spans) and spans[at][2] <= a:
                at += 1
            for kind, start, end in spans[at:at + len(KINDS) + 1]:
                if start < b and end > a:
                    self.labels[k] = KINDS.index(kind)
                    break
        self.chain = [(k, k + 1) for k in range(len(order) - 1) if order[k + 1] == order[k] + 1]
        self.hub = self._hubs()
        self.x = np.array([shape(t) for _, _, t in self.tokens], float).reshape(-1, len(SHAPES))

    def _hubs(self) -> np.ndarray:
        """The number of each token's hub. A token has one key: its last seven digits, or all letters and digits when
        it has fewer digits or an ``@`` (of the others, those alike in all are alike in the last seven)."""
        hubs: dict[str, int] = {}
        out = []
        for _, _, token in self.tokens:
            digits = "".join(c for c in token if c.isdigit())
            key = digits[-7:] if len(digits) >= 7 and "@" not in token else \
                "".join(c for c in token.lower() if c.isalnum() or c == "@")
            out.append(hubs.setdefault(key, len(hubs)))
        return np.array(out, dtype=np.int64)

    def votes(self) -> np.ndarray:
        """Per hub the number of its tokens with each label."""
        n = np.zeros((int(self.hub.max(initial=-1)) + 1, NONE + 1))
        np.add.at(n, (self.hub, self.labels), 1)
        return n

    def rows(self) -> np.ndarray:
        """What every token's label is learnt from: its shape, its neighbours' labels, and the label of its hub as the
        hub's other tokens settle it (shares of the kinds among them, none without a kind, 0 without other tokens)."""
        size = NONE + 1
        near, own = np.zeros((len(self.tokens), size)), np.eye(size)[self.labels]
        for a, b in self.chain:
            near[a] += own[b]
            near[b] += own[a]
        others = self.votes()[self.hub] - own
        kinds = others[:, :NONE].sum(axis=1, keepdims=True)
        settled = np.where(kinds > 0, np.hstack([others[:, :NONE], 0 * kinds]) / np.maximum(kinds, 1), others > 0)
        return np.hstack([self.x, near, settled])

    def proven(self) -> list[set[int]]:
        """For each token the kinds of the base spans of its hub."""
        kinds = [set(np.flatnonzero(v[:NONE]).tolist()) for v in self.votes()]
        return [kinds[h] for h in self.hub.tolist()]


class SkipChainField:
    """Weights: token shape by label, and label pairs of chain ties and of hub and token."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fit(cls, fields: list[Field], rounds: int = 2000, rate: float = 0.5, ridge: float = 1e-5) -> "SkipChainField":
        """Pseudo-likelihood: every token's label given its shape and its ties' labels. For fields at hand; ``fit_field``
        learns from a table."""
        size, n = NONE + 1, sum(len(f.tokens) for f in fields)
        if not n:
            return cls(np.zeros((len(SHAPES), size)), np.zeros((size, size)), np.zeros((size, size)))
        rows, y = np.concatenate([f.rows() for f in fields]), np.concatenate([f.labels for f in fields])
        weights, want = np.zeros((rows.shape[1], size)), np.eye(size)[y]
        pace = np.full((rows.shape[1], size), 1e-8)
        for _ in range(rounds):
            score = rows @ weights
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            slope = rows.T @ (p - want) / n + ridge * weights
            pace += slope ** 2
            weights -= rate * slope / np.sqrt(pace)
        return cls.of(weights)

    @classmethod
    def of(cls, weights: np.ndarray) -> "SkipChainField":
        """From one weight per column of ``Field.rows`` and label."""
        a, b = len(SHAPES), len(SHAPES) + NONE + 1
        chain = weights[a:b]
        return cls(weights[:a], (chain + chain.T) / 2, weights[b:])  # a chain tie has no direction

    def beliefs(self, field: Field, damp: float = 0.3, still: float = 1e-4) -> np.ndarray:
        """Label beliefs by loopy sum-product, all messages at once; tokens of base spans are evidence.

        A hub with evidence is settled by it, so all its tokens hear the same, however far away. Other hubs of two
        tokens or more are nodes without a label of their own. Rounds go on until no message is ``still`` from
        its next value; messages that never settle are damped more and more, and left after 1,000 rounds and
        one per node.
        """
        node, n = field.x @ self.unary, len(field.tokens)
        known = field.labels != NONE
        votes = field.votes()
        kinds = votes[:, :NONE].sum(axis=1)
        told = kinds[field.hub] > 0
        share = votes[:, :NONE] / np.maximum(kinds, 1)[:, None]
        node[told] += share[field.hub[told]] @ self.skip[:NONE]
        node[known] = np.where(np.eye(NONE + 1)[field.labels[known]] > 0, 0.0, -50.0)
        open_ = np.flatnonzero((votes.sum(axis=1) > 1)[field.hub] & ~told)
        hubs, at = np.unique(field.hub[open_], return_inverse=True)
        node = np.vstack([node, np.zeros((len(hubs), NONE + 1))])
        chain = np.array(field.chain, dtype=np.int64).reshape(-1, 2)
        a, b = np.concatenate((chain[:, 0], n + at)), np.concatenate((chain[:, 1], open_))
        if len(a):
            table = np.concatenate((np.broadcast_to(self.chain, (len(chain), NONE + 1, NONE + 1)),
                                    np.broadcast_to(self.skip, (len(open_), NONE + 1, NONE + 1))))
            source, target = np.concatenate((a, b)), np.concatenate((b, a))
            table = np.concatenate((table, table.transpose(0, 2, 1)))
            back = np.concatenate((np.arange(len(a), 2 * len(a)), np.arange(len(a))))
            message, pace = np.zeros((len(source), NONE + 1)), 1 - damp
            for turn in range(1, 1000 + len(node)):
                total = node.copy()
                np.add.at(total, target, message)
                out = total[source] - message[back]
                new = np.logaddexp.reduce(out[:, :, None] + table, axis=1)
                new -= new.max(axis=1, keepdims=True)
                moved = np.abs(new - message).max()
                message = (1 - pace) * message + pace * new
                if moved < still:
                    break
                if turn % 100 == 0:
                    pace = max(0.1, 0.8 * pace)
            np.add.at(node, target, message)
        node = node[:n] - node[:n].max(axis=1, keepdims=True)
        p = np.exp(node)
        return p / p.sum(axis=1, keepdims=True)


def all_spans(text: str, base: list[tuple[str, int, int]], model: SkipChainField, sure: float = 0.9) -> list[tuple[str, int, int]]:
    """Base spans and those of the field, by start, then kind as listed. A token joins a kind only if its
    hub has a base span of that kind. Neighbouring tokens of one kind are one span; punctuation around a
    token stays outside; tokens that a base span touches are never added."""
    if not base or not CANDIDATE.search(text):
        return base
    field = Field(text, base)
    if not len(field.tokens) or (field.labels != NONE).all():
        return base
    p, proven = model.beliefs(field), field.proven()
    beside, added, last = set(field.chain), [], None
    for k in np.flatnonzero((field.labels == NONE) & (p[:, :NONE].max(axis=1) >= sure)).tolist():
        start, end, token = field.tokens[k]
        kind = KINDS[int(p[k, :NONE].argmax())]
        if KINDS.index(kind) not in proven[k]:
            continue
        start += len(token) - len(token.lstrip(",;:!?[]\"'"))
        end -= len(token) - len(token.rstrip(".,;:!?[]\"'"))
        if end <= start:
            continue
        if added and last is not None and (last, k) in beside and added[-1][0] == kind:
            added[-1] = (kind, added[-1][1], end)
        else:
            added.append((kind, start, end))
        last = k
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def fit_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS) -> SkipChainField:
    """The field fitted on about ``fit_docs`` documents, of which those with candidate tokens count.

    Tokens alike in label and all else they are learnt from are one row with a weight.
    """
    total = docs.count()
    share = min(1.0, fit_docs / total) if total else 1.0
    place = F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")).cast("double") / 2.0 ** 64 + 0.5

    def tokens(text):
        f = Field(text, base_spans(text))
        alike, n = np.unique(np.hstack([f.labels[:, None], f.rows()]), axis=0, return_counts=True)
        for row, count in zip(alike.tolist(), n.tolist(), strict=True):
            yield row[0], row[1:], float(count)

    sample = docs.filter((place < share) & F.col(text_col).rlike("[0-9@]")).select(text_col)
    seen = map_rows(sample, tokens, "label double, x array<double>, n double", rows=16)
    rows = stage(seen.groupBy("label", "x").agg(F.sum("n").alias("n")), "pii-tokens")
    if rows.select("label").distinct().count() < 2:  # nothing to tell apart
        return SkipChainField.of(np.zeros((len(SHAPES) + 2 * (NONE + 1), NONE + 1)))
    fitted = LogisticRegression(family="multinomial", weightCol="n", regParam=1e-5, standardization=False, maxIter=200).fit(
        rows.select("label", array_to_vector("x").alias("features"), "n"))
    weights = np.zeros((len(SHAPES) + 2 * (NONE + 1), NONE + 1))
    made = fitted.coefficientMatrix.toArray().T
    weights[:, :made.shape[1]] = made
    weights[0, :made.shape[1]] += fitted.interceptVector.toArray()  # the first shape is 1 for every token
    return SkipChainField.of(weights)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS,
             sure: float = 0.9) -> DataFrame:
    """``id_col``, base and spans per input row: arrays of (kind, start, end), code points, end exclusive.

    Null and empty texts have no spans. Whole texts are read. Spans of one start are ordered by kind as
    listed. Rows repeat as they came; an empty table gives no rows; without a document to learn from the
    field adds nothing. Other columns aren't looked at.
    """
    model = fit_field(docs, id_col, text_col, fit_docs)

    def find(doc, text):
        base = base_spans(text or "")
        yield doc, _pack(base), _pack(all_spans(text or "", base, model, sure))

    flat = map_rows(docs.select(id_col, text_col), find,
                    f"id {docs.schema[id_col].dataType.simpleString()}, base string, spans string", rows=64)
    parse = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: F.struct(
        F.split_part(x, F.lit(":"), F.lit(1)).alias("kind"), F.split_part(x, F.lit(":"), F.lit(2)).cast("int").alias("start"),
        F.split_part(x, F.lit(":"), F.lit(3)).cast("int").alias("end")))
    span = "array<struct<kind:string,start:int,end:int>>"
    return flat.select(F.col("id").alias(id_col), parse("base").cast(span).alias("base"), parse("spans").cast(span).alias("spans"))


def _pack(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every span's text replaced by its kind in angle brackets, and the columns of ``docs``."""
    found = find_pii(docs.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col))), "_key", text_col, **how)
    spans = found.dropDuplicates(["_key"]).select("_key", F.col("spans").alias("_spans"))

    @F.udf("string", useArrow=True)
    def cover(text, found):
        if text is None:
            return None
        out, at = [], 0
        for s in found or ():
            if s["start"] >= at:
                out += [text[at:s["start"]], f"<{s['kind']}>"]
            at = max(at, s["end"])
        return "".join(out) + text[at:]

    made = docs.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col))).join(spans, "_key", "left")
    return made.withColumn(text_col, cover(F.col(text_col), F.col("_spans"))).select(*docs.columns)
