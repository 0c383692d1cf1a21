"""The registered queries and the pipeline at the smallest size, against plain versions."""

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from arbiter.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_every_operator_is_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert "pipeline" in names and set(QUERIES) <= set(names)


def rows_of(spark, name, *columns):
    return sorted(tuple(r[c] for c in columns) for r in entry.queries()[name](spark, SF).collect())


def test_substring_query(spark, documents):
    got = rows_of(spark, "op1_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.repeated_windows([d[:2] for d in documents], 35))


def test_quality_query(spark, documents):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(spark, "op2_quality_rules", *names) == sorted((i, *brute.base_quality(t)) for i, t, _ in documents)


def test_simhash_query(spark, documents):
    fps = [(i, brute.fingerprint(t)) for i, t, _ in documents]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute.linked(fps)))
    assert rows_of(spark, "op7_simhash_dedup", "doc_id", "fingerprint", "component_id") == want


def test_line_query(spark, documents):
    got = rows_of(spark, "op8_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(brute.lines([d[:2] for d in documents]))


def test_pii_query(spark, documents):
    want = []
    for i, t, _ in documents:
        spans = brute.personal(t)
        want.append((i, *[sum(s[0] == k for s in spans) for k in brute.KINDS], brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    assert rows_of(spark, "op5_pii_crf", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want)


def test_pipeline(spark, documents):
    """Every stage against what the plain versions make of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.stage(stage(spark, docs, SF), name)
        after, texts = docs.collect(), [(r.doc_id, r.text) for r in before]
        if name != "sentence_pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "quality_rules":
            fails = {i for i, t in texts if brute.base_quality(t)[-1]}
            assert not fails & {r.doc_id for r in after}
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in after}
            assert all(i in kept for i, _ in texts if labels.get(i) == 1 and i not in fails)
            assert not any(i in kept for i, _ in texts if labels.get(i) == 0)
        elif name == "line_dedup":
            assert sorted((r.doc_id, brute.sha(r.text)) for r in after) == sorted((i, s) for i, _, _, s in brute.lines(texts))
        elif name == "simhash_dedup":
            fps = [(i, brute.fingerprint(t)) for i, t in texts]
            assert sorted(r.doc_id for r in after) == sorted(set(brute.linked(fps)))
        elif name == "mix_sources":
            sizes, taken, longest = {}, {}, {}
            for r in before:
                n = len(brute.WORD.findall(r.text))
                sizes[r.source], longest[r.source] = sizes.get(r.source, 0) + n, max(longest.get(r.source, 0), n)
            for r in after:
                taken[r.source] = taken.get(r.source, 0) + len(brute.WORD.findall(r.text))
            for s, want in brute.targets(sizes).items():
                assert abs(taken.get(s, 0) - want) <= longest[s] / 2
        else:
            from arbiter.llm.sentence_pieces import Pieces
            pieces = Pieces()
            assert sorted((r.doc_id, pieces.decode(r.ids)) for r in after) == sorted(texts)


def test_katz_query(spark, documents):
    from test_katz import Plain
    rows = [d[:2] for d in documents]
    plain = Plain(rows)
    got = {r.doc_id: tuple(r)[:5] + (r.base_score, r.score) for r in entry.queries()["op11_katz"](spark, SF).collect()}
    assert len(got) == len(rows)
    # the plain program adds up a context's probabilities for every token: a part of the documents is enough for its scores
    for i, t in rows[::10]:
        want = plain.score(i, t)
        assert got[i][:5] == want[:5] and got[i][5:] == pytest.approx(want[5:], rel=1e-9)


def test_spelling_query(spark, documents):
    """Near words by deleting or masking each letter, instead of comparing every pair."""
    from collections import defaultdict
    got = {r.word: r for r in entry.queries()["op12_spelling"](spark, SF).collect()}
    n = {w: r.n for w, r in got.items()}
    masked, near = defaultdict(list), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            masked[w[:i] + "*" + w[i + 1:]].append(w)
            if (short := w[:i] + w[i + 1:]) in n:
                near[w].add(short)
                near[short].add(w)
    for same in masked.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    for w, r in got.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 10 * n[w] else None
        assert (r.n_near, r.form, r.form_n) == (len(near[w]), form, n.get(form))
        assert r.root == (got[form].root if form else w)


def test_whitening_query(spark):
    from test_whitening import plain
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = plain(rows), entry.queries()["op13_whitening"](spark, SF).collect()
    assert len(got) == 4 * len(rows)
    for r in got:
        n, deviation, white, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and abs(abs(r.whitened) - white) < 1e-8
        assert abs(r.explained - share) < 1e-9 and r.identity_error < 1e-10
