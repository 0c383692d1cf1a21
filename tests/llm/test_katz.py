"""The Katz model against a plain program with dictionaries, and its probabilities' sums."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from arbiter.llm.katz import Words, expand, good_turing, katz, squeeze, unique_pairs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
K = 5


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def factors(counts):
    """Good-Turing factors, as Katz gives them, of a Counter; (r - D) / r where they aren't between 0 and 1."""
    n = Counter(counts.values())
    spare = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
    out = {}
    for r in range(1, K + 1):
        d = None
        if n[1] and n[r] and n[1] != (K + 1) * n[K + 1]:
            big = (K + 1) * n[K + 1] / n[1]
            d = ((r + 1) * n[r + 1] / (r * n[r]) - big) / (1 - big)
        out[r] = d if d is not None and 0 < d < 1 else (r - spare) / r
    return out


class Plain:
    def __init__(self, rows, share=10):
        self.share, single, pairs = share, Counter(), Counter()
        for i, t in rows:
            if not self.held(i):
                seq = tokens(t)
                single.update(seq)
                pairs.update(zip(["<s>", *[(w,) for w in seq[:-1]]], seq, strict=True))
        self.single, self.pairs, self.n = single, pairs, sum(single.values())
        self.d1, self.d2 = factors(single), factors(pairs)
        spared = sum((1 - self.d1[c]) * c for c in single.values() if c <= K)
        self.total = self.n if spared else self.n + 1
        types = Counter(single.values())
        self.unseen = max(1.0, types[1] ** 2 / (2 * types[2]) if types[2] else types[1] * (types[1] - 1) / 2)
        self.unknown = (spared or 1.0) / self.total / self.unseen
        self.after = defaultdict(dict)
        for (v, w), c in pairs.items():
            self.after[v][w] = c

    def held(self, i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % self.share == 0

    def word(self, w):
        c = self.single[w]
        return self.d1.get(c, 1.0) * c / self.total if c else self.unknown

    def probability(self, v, w):
        seen = self.after.get(v)
        if not seen:
            return self.word(w)
        total = sum(seen.values())
        if all(c > K for c in seen.values()):
            total += 1
        if w in seen:
            return self.d2.get(seen[w], 1.0) * seen[w] / total
        left = 1 - sum(self.d2.get(c, 1.0) * c for c in seen.values()) / total
        return left / (1 - sum(map(self.word, seen))) * self.word(w)

    def score(self, i, t):
        seq = tokens(t)
        context = ["<s>", *[(w,) for w in seq[:-1]]]
        types = len(self.single)
        return (i, self.held(i), len(seq), sum(self.single[w] > 0 for w in seq), self.n,
                sum(math.log10((self.single[w] + 0.1) / (self.n + 0.1 * (types + 1))) for w in seq),
                sum(math.log10(self.probability(v, w)) for v, w in zip(context, seq, strict=True)))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in rows], "doc_id long, text string, held string, shard int, score double")


def same(got, rows, plain):
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted((plain.score(i, t) for i, t in rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def prose(rng, n):
    """Words of a long tail, some always followed by one other word."""
    out = []
    while len(out) < n:
        w = f"w{int(rng.paretovariate(0.6)) % 3000}"
        out += [w.upper() if rng.random() < 0.1 else w, *(["Ünited", "states"] if rng.random() < 0.05 else [])]
    return rng.choice([" ", "\t", "\n\x0b "]).join(out)


@pytest.mark.parametrize("shard_tokens", [2_000_000, 40])
def test_against_plain_model(spark, shard_tokens):
    """With shards of forty tokens most texts go over several."""
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.choice((1, 5, 60, 200)))) for k in range(150)]
    rows += [(500, None), (501, ""), (502, " \n "), (None, "w1 w2 unheard"), (None, None), (7, rows[7][1]), (503, "a" * 5000 + " b")]
    rows += [(600 + k, "a copied text of ten or so words stays copied") for k in range(40)]
    plain = Plain(rows)
    made = katz(table(spark, rows), shard_tokens=shard_tokens)
    same(made.scores, rows, plain)
    assert (made.unigram.n_tokens, made.unigram.n_types) == (plain.n, len(plain.single))


def test_tables_hold_the_model(spark):
    rng = random.Random(9)
    rows = [(k, prose(rng, 80)) for k in range(60)]
    plain, made = Plain(rows), katz(table(spark, rows))
    import zstandard
    words = [w for r in made.words.collect() for w in zstandard.ZstdDecompressor().decompress(r.a).split(b"\n")]
    counts = [c for r in made.words.collect() for c in expand(r.b).tolist()]
    assert {w.decode() or None: c for w, c in zip(words, counts, strict=True)} == dict(plain.single)
    assert sorted(c for r in made.pairs.collect() for c in expand(r.c).tolist()) == sorted(plain.pairs.values())
    assert sorted(c for r in made.contexts.collect() for c in expand(r.b).tolist()) == sorted(
        sum(x.values()) + all(c > K for c in x.values()) for x in plain.after.values())


def test_probabilities_add_up_to_one():
    rng = random.Random(6)
    plain = Plain([(k, prose(rng, 100)) for k in range(80)])
    assert any(all(c > K for c in x.values()) for x in plain.after.values())
    for v in ["<s>", ("never seen",), *list(plain.after)[:200]]:
        total = sum(plain.probability(v, w) for w in plain.single) + plain.unseen * plain.probability(v, "never seen")
        assert total == pytest.approx(1, abs=1e-9)
    model = Words(len(plain.single), plain.n, 0, [Counter(plain.single.values())[r] for r in range(1, K + 2)])
    assert model.probability(np.array(list(plain.single.values()))).sum() + model.unseen_types * model.unknown() == pytest.approx(1)


def test_nothing_to_train_on(spark):
    assert katz(table(spark, [])).scores.collect() == []
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    rows = [(held, "some words"), (None, None)]
    same(katz(table(spark, rows)).scores, rows, Plain(rows))
    one = [(next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10), None), (held, "some words")]
    same(katz(table(spark, one)).scores, one, Plain(one))


def test_blocks_and_pairs():
    for x in ([], [0], [-1, 2 ** 62, -2 ** 62, 5], list(range(1000))):
        assert expand(squeeze(np.array(x, np.int64))).tolist() == x
    rng = random.Random(1)
    for size in (5, 2 ** 40):
        v, w = (np.array([rng.randrange(size) for _ in range(300)]) for _ in "ab")
        a, b, at = unique_pairs(v, w)
        pairs = list(zip(a.tolist(), b.tolist(), strict=True))
        assert pairs == sorted(set(zip(v.tolist(), w.tolist(), strict=True)))
        assert (a[at] == v).all() and (b[at] == w).all()


def test_discounts_stay_between_zero_and_one():
    assert good_turing([100, 40, 20, 12, 8, 5])[1] == pytest.approx((2 * 40 / 100 - 0.3) / 0.7)
    for n in ([0] * 6, [1, 0, 0, 0, 0, 0], [0, 5, 0, 0, 0, 9], [10, 90, 1, 1, 1, 50], [6, 1, 1, 1, 1, 1]):
        assert all(0 < d < 1 for d in good_turing(n)[1:])
