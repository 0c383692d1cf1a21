"""Spelling variants against a plain program that compares every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arbiter.llm import spelling
from arbiter.llm.spelling import build_tree, letter_codes, letter_counts, near_pairs, reached, roots, variant_forms

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, min_chars=7, min_count=2, thin=31, times=10):
    seen = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % thin == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_chars:
                seen[run] += 1
    n = {w: c for w, c in seen.items() if c >= min_count}
    form, out = {}, {}
    for w in n:
        near = [x for x in n if abs(len(x) - len(w)) < 2 and x != w and one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
        out[w] = len(near)
    end = {}
    for w in n:
        end[w] = w
        while form[end[w]] is not None:
            end[w] = form[end[w]]
    return {w: (form[w], end[w], n[w], out[w], n.get(form[w])) for w in n}


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, "y") for i, t in rows], "doc_id long, text string, word string, n int, form string")


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def variants(rng, base, many):
    """Texts in which words and their one-edit neighbours occur from once to hundreds of times."""
    letters, words = "abcdeéÿÀ×", list(base)
    for _ in range(many):
        w = rng.choice(words)
        at, kind = rng.randrange(len(w)), rng.randrange(4)
        words.append(w[:at] + w[at + 1:] if kind == 0 else w[:at] + rng.choice(letters) + w[at + (kind == 1):] if kind < 3
                     else "".join(rng.sample(w, len(w))))
    counts = [rng.choice((1, 2, 3, 20, 21, 300)) for _ in words]
    flat = [w for w, c in zip(words, counts, strict=True) for _ in range(c)]
    rng.shuffle(flat)
    return [(k, " ".join(flat[k * 400:(k + 1) * 400])) for k in range(len(flat) // 400 + 1)]


@pytest.mark.parametrize("cell", [20_000, 6])
def test_against_every_pair(spark, monkeypatch, cell):
    """With cells of six words the upper trees split, and words that no split tells apart fill several cells."""
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    rng = random.Random(5)
    rows = variants(rng, ["abcdeabc", "abcdefgh", "beadcabd", "cabbageé", "ÿéÀabcdea", "abcdeabcdeabcdeabcde"], 250)
    rows += [(900, None), (901, ""), (902, "ABCDEABC Abcdeabc abcdeABC ÀBCDEFGH àbcdefgh"), (None, "abcdefgh abcdefgh"), (7, rows[7][1])]
    assert found(variant_forms(table(spark, rows))) == plain(rows)


def test_empty_long_and_other_parameters(spark):
    assert found(variant_forms(table(spark, []))) == {}
    assert found(variant_forms(table(spark, [(1, None), (2, "1 2 3")]))) == {}
    long = "abcdefg" * 3000
    rows = [(1, f"{long} {long} {long[:-1]}x {long[:-1]}x {long}y " + f"{long}y " * 30), (2, "a a b b ab ab " * 20 + "c")]
    assert found(variant_forms(table(spark, rows))) == plain(rows)
    assert found(variant_forms(table(spark, rows[1:]), min_chars=1, min_count=1, thin=3, times=2)) == plain(rows[1:], 1, 1, 3, 2)


def test_range_search_finds_every_pair():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcz") for _ in range(8)) for _ in range(900)})
    longer = sorted({"".join(rng.choice("abcz") for _ in range(9)) for _ in range(900)})
    a, b = letter_codes(words, 8), letter_codes(longer, 9)
    same = {(p, q) for x in near_pairs(a, a, 1, 1) for p, q in zip(*map(np.ndarray.tolist, x), strict=True)}
    assert same == {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if one_edit(x, y) and i != j}
    pairs = [(p, q) for x in near_pairs(b, a, 1, 0) for p, q in zip(*map(np.ndarray.tolist, x), strict=True)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, j) for i, x in enumerate(longer) for j, y in enumerate(words) if one_edit(x, y)}


def test_upper_tree_prunes_only_what_no_edit_reaches():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(400)})
    counts = letter_counts(letter_codes(words, 8))
    tree = build_tree(counts, 4000, 100)
    home = {}
    for first, _, rows in reached(tree, counts, 0, 0):
        home.update(dict.fromkeys(rows.tolist(), first))
    assert len(home) == len(words) and len(set(home.values())) > 30
    cells = [set() for _ in words]
    for first, _, rows in reached(tree, counts, 1, 1):
        for r in rows.tolist():
            cells[r].add(first)
    assert all(home[j] in cells[i] for i, x in enumerate(words) for j, y in enumerate(words) if one_edit(x, y))
    assert sum(map(len, cells)) < len(words) * len(set(home.values())) / 2


def test_roots_follow_long_chains(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(18)] + [("x", "w3"), ("y", "w18")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "w18" for w, _ in links}
