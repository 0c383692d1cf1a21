"""Exact, line, substring and SimHash de-duplication against plain versions, with the odd inputs."""

import random
from itertools import combinations

import brute
import pytest
from pyspark.sql import functions as F

from arbiter.llm.common import work_path
from arbiter.llm.components import components
from arbiter.llm.exact_dedup import DigestIndex, deduplicated
from arbiter.llm.line_dedup import LineRuns, deduplicate_lines
from arbiter.llm.simhash_dedup import _list_links, _postings, fingerprint, near_duplicates, one_of_each
from arbiter.llm.substring_dedup import remove_repeated

SCHEMA = "doc_id long, text string, n_lines string, n_words string, kept string, h string, source string"


def frame(spark, rows):
    """Rows (id, text) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "h", "s") for i, t in rows], SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with shared passages and lines, exact and near copies, a long one, empty ones and nulls."""
    rng = random.Random(7)
    passage = [" ".join(words(rng, n)) for n in (34, 35, 36, 60)]
    line = ["A shared Line of text", "a shared line of TEXT  ", "short", "another common line here"]
    rows = []
    for i in range(60):
        parts = [" ".join(words(rng, rng.randrange(5, 90))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, passage[i % 4])
        if i % 4 == 0:
            parts.insert(2, line[i % 4 if i % 8 else 3])
        rows.append((i, ("\n" if i % 2 else " ").join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 40, 5)]
    rows += [(200 + i, rows[4][1] + f" tail{i}") for i in range(5)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (303, "one"), (304, " ".join(words(rng, 70_000, 90_000)))]
    return rows


def test_exact_dedup(spark, corpus):
    index = DigestIndex(spark, work_path(spark, "t"), buckets=4)
    rows = corpus + [corpus[3]] * 2 + [(None, "lonely"), (None, corpus[5][1])]
    got = index.deduplicate(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_text, kept = {}, {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    for i, t in rows:
        ids = [x for x in by_text[t or ""] if x is not None]
        kept.setdefault(i, []).append((max(ids) if ids else None, len(by_text[t or ""])))
    for r in got:
        assert (r.keep_id, r.group_size) in kept[r.doc_id]
    assert sum(r.kept for r in got) == len(by_text)
    # a later batch meets what the index holds, a repeated one decides alike
    later = index.deduplicate(frame(spark, [(900, corpus[0][1]), (901, "new text")]))
    assert {r.doc_id: (r.keep_id, r.kept) for r in later.collect()} == {900: (100, False), 901: (901, True)}
    assert index.rows().groupBy("digest").count().filter("count > 1").count() == 0
    reopened = DigestIndex(spark, index.path, buckets=4)
    again = {r.doc_id: r.kept for r in reopened.deduplicate(frame(spark, [(901, "new text")])).collect()}
    assert again == {901: True}
    assert index.deduplicate(frame(spark, [])).count() == 0


def test_exact_dedup_in_batches(spark, corpus, monkeypatch):
    rows = corpus + [corpus[3]] * 2 + [(None, "lonely"), (None, corpus[5][1]), (5000, corpus[0][1])]
    want = DigestIndex(spark, work_path(spark, "t"), buckets=4).deduplicate(frame(spark, rows)).collect()
    for batches in (2, 5):
        index = DigestIndex(spark, work_path(spark, "t"), buckets=4)
        got = index.deduplicate(frame(spark, rows), batches=batches).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert index.rows().count() == len({t or "" for _, t in rows})
    # the registered query feeds an index that isn't empty, and lets it decide
    from arbiter.llm.queries import op4_exact_dedup
    held, append = [], DigestIndex.append
    monkeypatch.setattr(DigestIndex, "append", lambda self, groups: (
        held.append(self.rows().join(groups.select("digest"), "digest", "left_semi").count()), append(self, groups)))
    op4_exact_dedup(spark, "/root/testdata/sf0.001")
    assert len(held) > 1 and held[0] == 0 and sum(held) > 0


def test_exact_dedup_joins_by_merge_without_python(spark, corpus):
    index = DigestIndex(spark, work_path(spark, "t"), buckets=4)
    df = index.deduplicate(frame(spark, corpus))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    kept = deduplicated(frame(spark, corpus), DigestIndex(spark, work_path(spark, "t"), buckets=4))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert kept.count() == len({t or "" for _, t in corpus})


def test_line_dedup(spark, corpus):
    got = deduplicate_lines(frame(spark, corpus), batches=3).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.lines(corpus))
    assert sum(r[2] for r in got.collect()) > 20
    assert deduplicate_lines(frame(spark, [])).count() == 0


def test_line_runs_go_on_and_are_compacted(spark):
    runs = LineRuns(spark, work_path(spark, "t"), buckets=2, fanout=2)
    for i in range(5):
        docs = frame(spark, [(i, f"the common first line\nonly in batch number {i}\nthe common first line")])
        got = deduplicate_lines(docs, runs, batches=1).first()
        assert (got.n_dropped, got.text.count("common")) == ((2, 0) if i else (0, 2))
    assert len(runs.runs) < 4 and max(level for level, _ in runs.runs) >= 2
    reopened = LineRuns(spark, runs.path, buckets=2, fanout=2)
    assert reopened.runs == runs.runs
    late = deduplicate_lines(frame(spark, [(-1, "ONLY in batch number 0 ")]), reopened, batches=1).first()
    assert late.n_dropped == 1  # an earlier batch owns it, whatever the id


def test_line_runs_survive_a_job_that_dies(spark, monkeypatch, tmp_path):
    path = f"{tmp_path}/runs"
    runs = LineRuns(spark, path, expected=100_000_000)
    assert runs.buckets == 25
    deduplicate_lines(frame(spark, [(1, "a line of the first batch")]), runs, batches=1).collect()
    with monkeypatch.context() as m:
        m.setattr(LineRuns, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            deduplicate_lines(frame(spark, [(2, "a line of the second batch")]), runs, batches=1)
    (tmp_path / "runs" / "lists" / "00000002").mkdir()               # a list that was begun and never completed
    again = LineRuns(spark, path)
    assert (again.buckets, len(again.runs), again.number) == (25, 1, 1)
    got = {r.doc_id: r.n_dropped for r in deduplicate_lines(
        frame(spark, [(2, "a line of the second batch"), (3, "a line of the first batch\na line of the second batch")]), again, batches=1).collect()}
    assert got == {2: 0, 3: 2} and LineRuns(spark, path).number == 2
    with pytest.raises(ValueError, match="25 buckets"):
        LineRuns(spark, path, buckets=4)
    (tmp_path / "runs" / "lists").rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="no list"):
        LineRuns(spark, path)


def test_lines_of_one_id_and_of_none(spark):
    rows = [(5, "a line in two rows"), (5, "a line in two rows\nand one more line"), (None, "and one more line"), (None, None)]
    got = sorted((r.doc_id or 0, r.n_lines, r.n_dropped) for r in deduplicate_lines(frame(spark, rows)).collect())
    assert got == [(0, 1, 0), (0, 1, 1), (5, 1, 0), (5, 2, 0)]


def test_substring_dedup(spark, corpus):
    got = remove_repeated(frame(spark, corpus), window=35).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.repeated_windows(corpus, 35))
    removed = {r[0]: r[2] for r in got.collect()}
    assert removed[100] and not removed[304] and not removed[300]
    assert remove_repeated(frame(spark, []), window=35).count() == 0


def test_substring_dedup_within_one_text_and_short_windows(spark):
    twice = " ".join(["a b c d e f g h i j k l"] * 2)
    rows = [(1, twice), (2, "x a b c d e y"), (3, "a " * 40), (4, None), (4, "q r s t u"), (4, "q r s t u")]
    got = remove_repeated(frame(spark, rows), window=5, phrase=2).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.repeated_windows(rows, 5))


def test_substring_dedup_batches_end_at_documents(spark, monkeypatch):
    """Documents are located many at a time; no window, run or phrase goes on in the next document."""
    import pyarrow as pa
    from arbiter.llm import substring_dedup as module
    rng = random.Random(12)
    rows = [(k, " ".join(rng.choices("abc", k=rng.choice([0, 1, 4, 5, 6, 30])))) for k in range(150)]
    rows += [(200, "p q r"), (201, "s t u v"), (202, "p q r s t u v"), (203, "s t u v p q r"), (204, None), (205, "p q r s t u v")]
    for window, phrase in ((5, 2), (7, 7), (2, 1), (1, 1)):
        got = remove_repeated(frame(spark, rows), window=window, phrase=phrase).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
        assert sorted(map(tuple, got.collect())) == sorted(brute.repeated_windows(rows, window))
    calls, hashes = [], module.word_hashes
    monkeypatch.setattr(module, "word_hashes", lambda words: calls.append(len(words)) or hashes(words))
    shard = pa.table({"_key": pa.array(range(400), pa.int64()), "_row": [{"text": f"w{k} x y z w{k + 1} w{k}"} for k in range(400)]})
    made = module._locate(3, 2)(shard, pa.table({"phrase": [b"x y", b"z w5"]}))
    assert len(calls) == 3  # the machine's words twice, all texts once
    marks = sorted(zip(made["key"].to_pylist(), made["mark"].to_pylist(), strict=True))
    assert {key for key, _ in marks} == set(range(400)) and all(pos >> 32 < 4 for _, pos in marks)
    first, second = hashes([b"one", b"two", b"one"])
    assert first[0] == first[2] != first[1] and second[0] == second[2] != second[1] and not set(first) & set(second)


def test_fingerprint():
    rng = random.Random(3)
    for n in (0, 1, 3, 4, 5, 50, 40_000):
        text = " ".join(words(rng, n)).upper() + " É x " * (n > 3)
        assert fingerprint(text.encode()) == brute.fingerprint(text)


def test_near_duplicates(spark, corpus):
    rows = corpus + [corpus[2], (None, corpus[2][1])]
    got = near_duplicates(frame(spark, rows), list_limit=2).collect()  # nearly every list counts as dense
    fps = [(10 ** 9 if i is None else i, brute.fingerprint(t)) for i, t in rows]
    want = sorted((i, f, c) for (i, f), c in zip(fps, brute.linked(fps)))
    assert sorted((10 ** 9 if r.doc_id is None else r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got) == want
    usual = near_duplicates(frame(spark, rows)).collect()  # the roots are the same too
    assert sorted(map(repr, usual)) == sorted(map(repr, got))
    for key_bytes in (4,):  # lists whose pairs all reach the minimum
        other = near_duplicates(frame(spark, rows), key_bytes=key_bytes).collect()
        assert sorted(map(repr, other)) == sorted(map(repr, got))
    assert near_duplicates(frame(spark, [])).count() == 0
    kept = one_of_each(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_count_filter_rejects(spark):
    """Pairs meet in a list with fewer common bytes than the minimum, or enough of them and too many bits."""
    def bits(*at):
        return sum(1 << b for b in at)
    a = 0x0123456789ABCDEF
    near, far = a ^ bits(0, 8, 16, 24), a ^ bits(0, 1, 8, 16, 24)       # four common bytes, four and five bits
    few = a ^ bits(0, 8, 16, 24, 32)                                    # three common bytes, five bits
    fps = [f - (1 << 64) if f >> 63 else f for f in (a, near, far, few)]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for size in (1, 2, 3, 4):
        positions = list(combinations(range(8), size))
        got = _list_links(_postings(df, positions), positions, 4, 64).collect()
        links = {tuple(sorted((r.a, r.b))) for r in got}
        want = {tuple(sorted(p)) for p in combinations(fps, 2) if ((p[0] ^ p[1]) % 2 ** 64).bit_count() <= 4}
        assert links == want and len(got) == len(want)  # each link once


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)]
    links += [(5000, 5000 + k) for k in range(1, 50)]
    root = {}
    for _ in range(200):
        for a, b in links:
            m = min(root.get(a, a), root.get(b, b))
            root[a] = root[b] = m
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in root.items() if n in got}
    assert {n for a, b in links if a != b for n in (a, b)} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
