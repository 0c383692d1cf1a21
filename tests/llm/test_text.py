"""Quality rules, classifier, personal data, page extraction, mixing and pieces against plain versions."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from arbiter.llm.html_extract import FEATURES, FlowNetwork, extract, label_blocks, page_blocks
from arbiter.llm.mixing import fit_counts, mix, plan_mix
from arbiter.llm.pii_crf import NONE, SHAPES, Field, SkipChainField, all_spans, base_spans, find_pii, fit_field, redact
from arbiter.llm.quality_rules import clean, judged
from arbiter.llm.rule_classifier import Rule, score_quality
from arbiter.llm.sentence_pieces import MODEL, Pieces, decode, encode

SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string, kept string, score string")


def make(rows):
    return [(i, t, "s", "x", "y", "z") for i, t in rows]


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta of the and or".split()) + str(rng.randrange(50)) for _ in range(n))


def test_quality_base(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, n)) for k, n in enumerate((0, 1, 2, 3, 49, 50, 51, 300))]
    rows += [(20, "a b c " * 40), (21, "x|y | z & # a b\n\nx|y | z & # a b\n  \n"), (22, None), (23, ""), (24, "\n\n"),
             (25, "a a a a a a"), (26, "u v w\x0bé x " * 3 + prose(rng, 60)), (27, " ".join(map(str, range(30_000))) + " 1 2 3")]
    got = judged(docs(spark, make(rows)).drop("kept", "n_words")).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {r.doc_id: tuple(r[c] for c in names) for r in got} == {i: brute.base_quality(t) for i, t in rows}
    plan = judged(docs(spark, make(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_quality_lines(spark):
    rng = random.Random(2)
    good = [prose(rng, 20) + "." for _ in range(5)]
    rows = [(1, "\n".join(good)), (2, "\n".join(good + ["Home | About | News | Contact", "All rights reserved"])),
            (3, "\n".join(good[:3] + ["BUY!! NOW!! THIS!! IS!! IT!! " * 12])), (4, "\n".join(x.replace(" ", "%%% ") for x in good))]
    got = {r.doc_id: r for r in judged(docs(spark, make(rows))).collect()}
    assert {i: r.kept for i, r in got.items()} == {1: True, 2: True, 3: False, 4: False}
    assert got[2].clean_text == rows[0][1] and got[2].n_lost_words == 10
    kept = clean(docs(spark, make(rows)))
    assert kept.columns == ["doc_id", "text", "source", "n_words", "kept", "score"]
    assert sorted((r.doc_id, r.text, r.n_words, r.kept) for r in kept.collect()) == [(1, rows[0][1], "x", "y"), (2, rows[0][1], "x", "y")]
    assert clean(docs(spark, [])).count() == 0


def test_quality_lines_by_form(spark):
    """Rows and columns of links and capitals in any language; prose that speaks of such things stays."""
    rng = random.Random(12)
    good = [prose(rng, 20) + "." for _ in range(5)]
    column = ["Über uns", "Nos équipes", "Aktuelles", "Última hora"]
    gone = ["Startseite | Über uns", "Accueil › Produits › Détail", "ÉCOUTEZ BIEN MAINTENANT", "Tous droits réservés", "Impressum"]
    stay = ["We changed our privacy policy " + prose(rng, 30) + ".", "Either yes / no was said here by them all in the end.",
            "NASA said so", "- milk", "Kurz.", "Short lines.", "Of three.", "With marks.", *column[:3]]
    rows = [(1, "\n".join([*good, *column, *gone])), (2, "\n".join([*good, *stay])), (3, "\n".join([*column, "", *good])),
            (4, "\n".join([*column, *column, *good]))]
    got = {r.doc_id: r.clean_text for r in judged(docs(spark, make(rows))).collect()}
    assert got == {1: "\n".join(good), 2: rows[1][1], 3: "\n".join(["", *good]), 4: "\n".join(good)}


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(60, 200)) + "."
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good)))
    rows += [(1000, None), (1001, ""), (None, "x")]
    known = spark.createDataFrame(labels + [(5, None)], "doc_id long, quality int")
    got = score_quality(docs(spark, make(rows)), known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    truth = dict(labels)
    assert sum(r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth) >= 0.95 * sum(r.doc_id in truth for r in held)
    # the labels of held-out rows change nothing
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    again = score_quality(docs(spark, make(rows)), spark.createDataFrame(other, "doc_id long, quality int")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    none = score_quality(docs(spark, make(rows)), spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in none.collect()} == {0.5}
    assert score_quality(docs(spark, []), known).count() == 0


def test_rule_column(spark):
    rule = Rule((("a", True, 1.0), ("b", False, 2.0)))
    df = spark.createDataFrame([(2.0, 2.0), (1.0, 0.0), (3.0, 2.5)], "a double, b double")
    assert [r[0] for r in df.select(rule.column()).collect()] == [True, False, False]
    assert str(rule) == "a > 1 and b <= 2"


def test_base_spans():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice("aZ09.@+- ()%_:4-1.2 5@é") for _ in range(rng.randrange(60)))
        assert base_spans(text) == brute.personal(text)
    assert base_spans("a" * 200_000 + "1" * 200_000 + "@" * 1000) == []  # no run is gone over again


def test_field_agrees_across_the_document():
    rng = random.Random(5)
    texts = [f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} at {rng.randrange(9)} or {n} items "
             f"a{n}@mail.example.com" for n in range(300)]
    model = SkipChainField.fit([Field(t, base_spans(t)) for t in texts])
    text = "ring +1 (308) 555-1234 now, or 555-1234, then 777 times"
    spans = all_spans(text, base_spans(text), model)
    assert [(k, text[a:b]) for k, a, b in spans] == [("phone", "+1 (308) 555-1234"), ("phone", "555-1234")]
    alone = "only 555-1234 stands here"
    assert all_spans(alone, base_spans(alone), model) == []


def test_field_reaches_every_repeat():
    """Equal tokens hear the same of a base span, near or far."""
    unary, pairs = np.zeros((len(SHAPES), NONE + 1)), np.zeros((NONE + 1, NONE + 1))
    unary[0, NONE] = 1.0
    far = "ring +1 (308) 555-1234 now" + " or 555-1234 and then" * 100
    model = SkipChainField(unary, pairs, 6 * np.eye(NONE + 1))
    spans = all_spans(far, base_spans(far), model)
    assert [(k, far[a:b]) for k, a, b in spans] == [("phone", "+1 (308) 555-1234")] + [("phone", "555-1234")] * 100
    p = model.beliefs(Field(far, base_spans(far)))[3:]  # +1, (308) and 555-1234 come before
    assert len(p) == 100 and abs(p - p[0]).max() < 1e-9


def test_field_fitted_on_a_table(spark):
    rng = random.Random(12)
    texts = []
    for n in range(300):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        texts.append(f"call {phone} at {rng.randrange(9)} or {n} items, again {phone}")
    long = " ".join(f"{n}x" for n in range(5_000)) + " " + "9a " * 50  # no length is left out of the fit
    model = fit_field(docs(spark, make(enumerate([*texts, long]))))
    text = "ring +1 (308) 555-1234 now, or 555-1234, then 777 times"
    assert [(k, text[a:b]) for k, a, b in all_spans(text, base_spans(text), model)] == [
        ("phone", "+1 (308) 555-1234"), ("phone", "555-1234")]
    # the slope of the penalised likelihood is near 0: the weights are the best ones
    fields = [Field(t, base_spans(t)) for t in [*texts, long]]
    x, y = np.concatenate([f.rows() for f in fields]), np.concatenate([f.labels for f in fields])
    score = np.exp(x @ np.vstack([model.unary, model.chain, model.skip]))
    slope = x.T @ (score / score.sum(axis=1, keepdims=True) - np.eye(NONE + 1)[y]) / len(y)
    assert abs(slope).max() < 0.005


def test_find_pii(spark):
    rows = [(1, "a.b@c.de and 10.0.0.1"), (2, None), (3, ""), (1, "a.b@c.de and 10.0.0.1"), (None, "card 4111 1111 1111 1111")]
    got = find_pii(docs(spark, make(rows))).collect()
    assert sorted((r.doc_id or 0, [tuple(s) for s in r.base]) for r in got) == sorted((i or 0, brute.personal(t)) for i, t in rows)
    assert all(set(r.base) <= set(r.spans) for r in got)
    assert find_pii(docs(spark, [])).count() == 0
    made = {(r.doc_id, r.text) for r in redact(docs(spark, make(rows))).collect()}
    assert made == {(1, "<email> and <ip>"), (2, None), (3, ""), (None, "card <card>")}


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=x>Home</a><li>News</ul></nav><main><article><header><h2>A &amp; B</h2></header><p>First  <b>bold
text</b>, of the day.<p>Second &lt;one&gt;.<br>More.<aside>See also</aside><div class="comments"><p>Nice!</div>
<ul><li>item one<li>item two</ul><form><p>Mail</p></form></article></main><div id="cookie-notice">We use cookies.</div>
<footer>&copy; x</footer></body>"""


def test_extract(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p>cut off &am"), (5, "u", "<nav>only</nav>"), (1, "u", PAGE)]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract(table).collect())
    text = "A & B First bold text, of the day. Second <one>. More. item one item two"
    assert got[:2] == [(1, text, len(text))] * 2
    assert [g[1] for g in got[2:]] == ["", "", "cut off &am", ""]
    assert extract(table.limit(0)).count() == 0


def test_extract_supplied_pages(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        want[r.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
    assert {r.page_id: r.text for r in extract(pages).collect()} == want


def test_extract_enclosed_pages(spark):
    """A form of the whole page, and menus and heads that are never closed, don't take the article away."""
    body = " ".join(f"<p>The {w} of the town was open, and many of its people came to see it, as in the years before.</p>"
                    for w in ("market", "bridge", "library"))
    text = " ".join(f"The {w} of the town was open, and many of its people came to see it, as in the years before."
                    for w in ("market", "bridge", "library"))
    menu = "<ul><li><a href=x>Home</a><li><a href=y>News</a></ul>"
    made = [
        f"<body><form action=x><nav>{menu}</nav><article>{body}</article><footer>&copy; x</footer><button>Go</button></form></body>",
        f"<head><script>{'var a = 1; ' * 200}</script></head><body><form id=f><nav>{menu}</nav><div>{body}</div><select><option>a</select></form>",
        f"<body role=form><nav>{menu}</nav><main>{body}</main></body>",
        f"<body><nav>{menu}<article>{body}</article></body>",
        f"<body><aside>{menu}<main>{body}</main></body>",
        f"<body><menu>{menu}<div><article>{body}</article></div></body>",
        f"<body><nav>{menu}<div>{body}</div></body>",
        f"<body><main><form>{body}<button>Go</button></form></main></body>",
        f"<html><head><title>T</title><body><nav>{menu}</nav><article>{body}</article></body>",
    ]
    closed = f"<body><nav>{'<p>Many a word of the menu, and more. </p>' * 9}</nav><article><p>Short.</article><form><p>Mail</form>"
    rows = [(1000 + i, "u", h) for i, h in enumerate([*made, closed])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").where("page_id < 1000")
    got = {r.page_id: r.text for r in extract(table.unionByName(known)).collect()}
    assert [got[1000 + i] for i in range(len(made))] == [text] * len(made)
    assert got[1000 + len(made)] == "Short."


def test_min_cut_is_the_least():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(1, 7)
        up, down = [rng.randrange(9) for _ in range(n)], [rng.randrange(9) for _ in range(n)]
        ties = [(a, b, rng.randrange(5)) for a in range(n) for b in range(a) if rng.random() < 0.6]
        net = FlowNetwork(n + 2)
        for k in range(n):
            net.tie(0, k + 2, up[k])
            net.tie(k + 2, 1, down[k])
        for a, b, c in ties:
            net.tie(a + 2, b + 2, c, c)
        cost = lambda side: sum(down[k] if side[k] else up[k] for k in range(n)) + sum(c for a, b, c in ties if side[a] != side[b])  # noqa: E731,B023
        least = min(cost([m >> k & 1 for k in range(n)]) for m in range(1 << n))
        assert cost(net.source_side()[2:]) == least


def test_smoothing_follows_neighbours():
    page = "".join(f"<p>{'Long sentence, with words enough. ' * 6}</p>" if k != 2 else "<p>Short one</p>" for k in range(5))
    weights = [0.0] * len(FEATURES)
    weights[FEATURES.index("log_words")] = 1.0
    assert label_blocks(page_blocks(page), -2.0, weights, smooth=2.0) == [True] * 5
    assert label_blocks(page_blocks(page), -2.0, weights, smooth=0.0) == [True, True, False, True, True]


def test_fit_counts():
    rng = random.Random(8)
    for _ in range(150):
        sizes = rng.sample(range(1, 60), rng.randrange(1, 7))
        counts = [rng.randrange(1, 5) for _ in sizes]
        total = sum(s * c for s, c in zip(sizes, counts))
        budget = rng.randrange(0, total + 1)
        taken = fit_counts(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        got = sum(s * t for s, t in zip(sizes, taken))
        assert abs(got - budget) <= max(sizes) / 2
    assert fit_counts([0, 5], [9, 2], 5) == [0, 1] and fit_counts([7], [3], 0) == [0] and fit_counts([], [], 4) == []
    assert sum(s * t for s, t in zip([3, 100_000], fit_counts([3, 100_000], [10_000, 50], 2_345_678))) == 2_330_000


def test_fit_counts_favours_no_length():
    rng = random.Random(11)
    sizes = sorted(rng.sample(range(1, 5_000), 2_000))
    counts = [rng.choice([1, 1, 1, 2]) for _ in sizes]
    total = sum(s * c for s, c in zip(sizes, counts))
    picks = set()
    for share in (0.1, 0.46, 0.8):
        for seed in ("a", "b"):
            taken = fit_counts(sizes, counts, round(total * share), seed)
            assert taken == fit_counts(sizes, counts, round(total * share), seed)
            assert sum(s * t for s, t in zip(sizes, taken)) == round(total * share)
            for k in range(0, 2_000, 400):  # fifths by length
                assert abs(sum(taken[k:k + 400]) / sum(counts[k:k + 400]) - share) < 0.03
            picks.add(tuple(taken))
    assert len(picks) == 6  # the seed counts
    huge = fit_counts([7, 11, 3_000_000], [40, 40, 3], 4_000_001)  # one document holds most words
    assert abs(sum(s * t for s, t in zip([7, 11, 3_000_000], huge)) - 4_000_001) <= 1_000_001


def test_mix(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(0, 40)), rng.choice(["b", "a", "é", None, "big", "big", "big"])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "empty"), (5, rows[5][1], rows[5][2]), (None, "x y z", "a"), (None, "x y z", "a")]
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, source string, size string, n string")
    got = plan_mix(table).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    want = brute.targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
    for s in sizes:
        assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 3
    assert sorted(map(repr, plan_mix(table.repartition(7)).collect())) == sorted(map(repr, got))
    mixed = mix(table)
    assert mixed.columns == table.columns
    assert mixed.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == sum(r.taken for r in got)
    assert plan_mix(table.limit(0)).count() == 0


def test_pieces_round_trip(spark):
    import sentencepiece
    rng = random.Random(10)
    rows = [(1, "Hello  world\nnew\tline  é中文🙂 a "), (2, None), (3, ""), (4, "   "), (5, " lead and <s> [UNK]"), (1, "Hello"),
            (None, "no id"), (6, "x" * 300 + " " + "ab" * 400), (7, prose(rng, 3000)), (8, "ｆｕｌｌ ﬁ \u0000 ü")]
    table = docs(spark, make(rows))
    few = encode(table, common=3)
    got = few.collect()
    assert len(got) == len(rows) and all(r.n_tokens == len(r.ids) for r in got)
    pieces, library = Pieces(), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {(i, t or "") for i, t in rows}
    assert {(r.doc_id, pieces.decode(r.ids)) for r in got} == texts == {(r.doc_id, library.decode(r.ids)) for r in got}
    assert {(r.doc_id, r.text) for r in decode(few).collect()} == texts
    assert sorted(map(repr, encode(table).collect())) == sorted(map(repr, got))  # shared words change nothing
    assert encode(docs(spark, [])).count() == 0


def test_pieces_query_decodes(spark):
    from arbiter.llm.queries import op3_sentence_pieces
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, brute.sha((r.text or "").replace("\u2581", " "))) for r in texts)
    assert sorted((r.doc_id, r.decoded_sha256) for r in op3_sentence_pieces(spark, SF).collect()) == want


def test_quality_rules_count_a_lines_words_once(spark):
    """The rules get a line's words, and all that is counted adds up whatever the white space between words."""
    from arbiter.llm.common import WORD
    from arbiter.llm.quality_rules import line_fails, link_like
    line, n = F.col("line"), F.col("n")
    assert WORD not in str(line_fails(line, n)) and WORD not in str(link_like(line, n))
    rows = [("a | b c d", True), ("a | b c d e", False), ("a | b | c d e f g h i", False), ("a | b | c d e f g h", True),
            ("| | |" + " w" * 40, True), ("plain words", False), (" \t\x0b ", False), ("", False)]
    made = spark.createDataFrame([(x, len(brute.WORD.findall(x)), want) for x, want in rows], "line string, n int, want boolean")
    # the symbol rule aside, by long words
    long = made.withColumn("line", F.regexp_replace("line", "([a-z])", "$1nnnnnnnnn"))
    assert [r.got for r in long.select(line_fails(line, n).alias("got")).collect()] == [want for _, want in rows]
    text = "\x0b\n".join(["wort wort\x0cwort"] * 30 + ["Home", "", " \t "])
    got = judged(docs(spark, make([(1, text), (2, None)]))).collect()
    assert {(r.doc_id, r.n_words, r.word_chars, r.n_dup_lines, r.n_lost_words) for r in got} == {(1, 91, 364, 29, 1), (2, 0, 0, 0, 0)}


def test_pieces_never_cross_a_cut(spark):
    """Words end where no piece joins on; rare words are cut into parts that no piece joins; Java cuts as Python does."""
    import re
    from arbiter.llm.sentence_pieces import SPACE, _parts, _words
    pieces = Pieces()
    words, parts = re.compile(pieces.word).findall, re.compile(pieces.part).findall
    assert all(words(p) == [p] for p in pieces.ids) and all(parts(p) == [p] for p in pieces.ids)
    assert words(f"{SPACE}onntshansh,{SPACE}for.\nThe") == [f"{SPACE}onntshansh", ",", f"{SPACE}for", ".", "\n", "The"]
    rng = random.Random(14)
    rows = [(k, "".join(rng.choices("abtqxzéÉжя.,[]-^&\\\n 1²中据数🙂\u0000  ", k=40))) for k in range(200)] + [(200, "b" * 300), (201, "")]
    table = docs(spark, make(rows))
    got = table.select("doc_id", "text", _words(F.col("text"), pieces).alias("w"))
    for r in got.withColumn("p", F.transform("w", lambda w: _parts(w, pieces))).collect():
        spaced = (SPACE + r.text.replace(" ", SPACE)) if r.text else ""
        assert r.w == words(spaced) and "".join(r.w) == spaced
        assert r.p == [parts(w) if len(w) <= 256 else [] for w in r.w]
    own = {r.doc_id: r.ids for r in encode(table, common=5).collect()}
    assert own == {i: pieces.spell(SPACE + t.replace(" ", SPACE)) if t else [] for i, t in rows}


def test_pieces_runs_hold_the_words(spark):
    """The runs between a text's spaces, cut one by one, give the words of the whole text."""
    import re
    from arbiter.llm.sentence_pieces import SPACE, _runs
    words = re.compile(Pieces().word).findall
    rng = random.Random(15)
    rows = [(k, "".join(rng.choices("ab.\n ▁ é中\u0000", k=rng.randrange(12)))) for k in range(400)]
    rows += [(400, ""), (401, " "), (402, "   "), (403, " a  b "), (404, "a▁ b"), (405, "a ▁b"), (406, "one two\tthree.\nfour"), (407, None)]
    for r in docs(spark, make(rows)).select("text", _runs(F.col("text")).alias("runs")).collect():
        spaced = (SPACE + r.text.replace(" ", SPACE)) if r.text else ""
        assert "".join(r.runs) == spaced and [w for run in r.runs for w in words(run)] == words(spaced)
        assert all(run.startswith(SPACE) for run in r.runs)
    table = docs(spark, make(rows))
    model = Pieces()
    want = sorted((i, model.spell(SPACE + t.replace(" ", SPACE)) if t else []) for i, t in rows)
    assert sorted((r.doc_id, list(r.ids)) for r in encode(table, common=2).collect()) == want


def test_lattice_path_is_the_best(spark):
    """The fold's path scores as the best of all segmentations (short words, all ways tried)."""
    from arbiter.llm.sentence_pieces import SPACE, spell_words
    pieces = Pieces()
    words = [SPACE + w for w in "the thering onöx ab aaaa 中x zzzzzz information".split()] + [SPACE, SPACE * 5, SPACE * 3 + "a"]

    def ways(word):
        if not word:
            yield 0.0, []
        for n in range(1, min(len(word), pieces.longest) + 1):
            found = pieces.ids.get(word[:n])
            if found or n == 1:
                i, s = found or (None, pieces.fallback)
                for score, rest in ways(word[n:]):
                    yield s + score, [i, *rest]

    table = spark.createDataFrame([(0, w) for w in words], "part int, word string")
    got = {r.word: r.ids for r in spell_words(table, pieces, ["part"]).collect()}
    score = {i: s for i, s in pieces.ids.values()}
    for w in words:
        assert sum(score.get(i, pieces.fallback) for i in got[w]) == max(s for s, _ in ways(w))
        assert [i for i in got[w] if i >= 0] == [i for i in pieces.spell(w) if i not in set(pieces.byte.values())]


def test_fold_takes_the_longest_of_equal_paths(spark):
    """Edges in, path out: of equal scores the longest last piece, then the longest before it; a negative id stays as it is."""
    from arbiter.llm.sentence_pieces import _viterbi
    words = [
        [(1, 0, 1, -2.0), (2, 0, 12, -5.0), (2, 1, 2, -2.0)],  # 1 + 2 beats 12
        [(1, 0, 1, -2.0), (2, 0, 12, -4.0), (2, 1, 2, -2.0)],  # a tie: 12
        [(1, 0, 1, -2.0), (2, 0, 12, -4.0), (2, 1, 2, -2.0), (3, 0, 123, -6.0), (3, 1, 23, -4.0), (3, 2, 3, -2.0)],  # three at once
        [(1, 0, 1, -2.0), (2, 0, 12, -4.0), (2, 1, 2, -2.0), (3, 0, 123, -7.0), (3, 1, 23, -5.0), (3, 2, 3, -2.0)],  # 12 + 3
        [(1, 0, 1, -2.0), (2, 1, -2, -50.0), (3, 1, 23, -9.0), (3, 2, 3, -2.0), (4, 3, -4, -50.0)],  # 1 + 23 + bytes
        [(1, 0, -1, -50.0)]]
    table = spark.createDataFrame(list(enumerate(words)), "i int, edges array<struct<end:int,start:int,id:int,score:double>>")
    got = [r.ids for r in table.select("i", _viterbi(F.col("edges")).alias("ids")).orderBy("i").collect()]
    assert got == [[1, 2], [12], [123], [12, 3], [1, 23, -4], [-1]]


def test_parts_try_common_characters_first():
    """The pattern's ways stand by how many pieces go on from their characters, not by how many characters may follow."""
    from collections import Counter
    pieces = Pieces()
    uses = Counter(c for p in pieces.ids for c in p[:-1])
    seen = {c: pieces.part.find(f"[{c}](?=") for c in uses if f"[{c}](?=" in pieces.part}
    alone = sorted(seen, key=seen.get)
    assert len(alone) > 20 and [uses[c] for c in alone] == sorted((uses[c] for c in alone), reverse=True)


def test_lattice_holds_the_useful_pieces(spark):
    """Pieces that others spell at a higher score aren't joined; the paths are those over all pieces."""
    from arbiter.llm.sentence_pieces import SPACE, spell_words
    pieces = Pieces()
    held = {r.piece for r in pieces.table(spark).collect()}
    assert held == set(pieces.useful) and 2 * len(held) < len(pieces.ids)
    assert all(pieces.spell(p) != [i] for p, (i, _) in pieces.ids.items() if p not in held)
    rng = random.Random(16)
    some = [p for p in pieces.ids if set(p) - {SPACE}]
    words = sorted({*some, *("".join(rng.choices(some, k=4)) for _ in range(2000))})
    table = spark.createDataFrame([(k % 5, w) for k, w in enumerate(words)], "part int, word string").repartition(4, "part")
    for r in spell_words(table, pieces, ["part"]).collect():
        assert [j for i in r.ids for j in ([i] if i >= 0 else [pieces.byte[c] for c in r.word[-1 - i].encode()])] == pieces.spell(r.word)


def test_useful_pieces_follow_the_scores():
    """A piece stays unless a spelling is better by more than rounding; a single character always stays."""
    pieces = Pieces()
    pieces.ids = {"a": (1, -3.0), "b": (2, -3.0), "ab": (3, -5.0), "ba": (4, -7.0), "aab": (5, -8.0), "abab": (6, -10.5), "bab": (7, -7.9)}
    pieces.longest, pieces.fallback = 4, -20.5
    assert set(pieces.useful) == {"a", "b", "ab", "aab", "bab"}  # aab ties with a + ab


def test_deep_and_long_pages_take_linear_time():
    """Fifty thousand unclosed elements, as many stray end tags, nested articles, and a page of 5 MB."""
    import time
    weights = [0.3, -1.0, 0.5, 0.2, 0.1, 0.3, -0.2, 0.1, -0.3]
    pages = {"<div>w " * 50_000: 50_000, "<div>w " * 50_000 + "</x></p>" * 50_000: 50_000, "<article>w " * 50_000: 50_000,
             "<article><p>" + "some words of text. " * 250_000 + "</p></article>": 1}
    for html, n in pages.items():
        began = time.time()
        blocks = page_blocks(html)
        assert len(blocks) == n == len(label_blocks(blocks, -1.0, weights))
        assert time.time() - began < 20  # about 2 s; quadratic work would take an hour


def test_long_pages_come_out_whole(spark):
    article = "<article><p>" + "some words of a text. " * 50_000 + "</p></article>"
    rows = [(k, "u", article + f"<nav>menu {k}</nav>") for k in range(6)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.n_chars for r in got.collect()} == {22 * 50_000 - 1}
