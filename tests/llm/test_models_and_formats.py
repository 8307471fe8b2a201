import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stocktrail.llm import reply_trees
from stocktrail.llm.hmm import Model, expected_counts, forward, score
from stocktrail.llm.html_cut import Rule as CutRule, blocks, extract, main_text, minimum_cut
from stocktrail.llm.toxicity import Rule, best_cut, graded, toxicity
from tests.llm import reference


# Hidden Markov model


def random_model(k=3, symbols=6):
    rng = np.random.default_rng(8)
    a, e, start = rng.random((k, k)), rng.random((symbols, k)), rng.random(k)
    return a / a.sum(axis=1, keepdims=True), start / start.sum(), e / e.sum(axis=0)


def by_all_paths(a, start, e, s):
    total = 0.0
    for path in itertools.product(range(len(start)), repeat=len(s)):
        p = start[path[0]] * e[s[0], path[0]]
        for t in range(1, len(s)):
            p *= a[path[t - 1], path[t]] * e[s[t], path[t]]
        total += p
    return math.log(total)


def test_forward_sums_over_all_paths():
    a, start, e = random_model()
    sequences = [np.array(s, dtype=np.uint16) for s in ([0], [5, 1, 2], [3, 3, 3, 0, 1], [2, 4], [1] * 6)]
    got = forward(a, start, e, sequences)
    assert got == pytest.approx([by_all_paths(a, start, e, s) for s in sequences])
    long = np.resize(np.array([0, 3, 1, 5], dtype=np.uint16), 20_000)
    assert forward(a, start, e, [long, long[:7]])[1] == pytest.approx(forward(a, start, e, [long[:7]])[0])


def test_expected_counts_are_those_of_all_paths():
    a, start, e = random_model()
    s = [2, 0, 5, 5]
    emitted, moves, firsts = expected_counts(a, start, e, np.array(s, dtype=np.uint16)[:, None], np.array([True]))
    want_e, want_a, want_s, total = np.zeros_like(e), np.zeros_like(a), np.zeros_like(start), 0.0
    for path in itertools.product(range(3), repeat=4):
        p = start[path[0]] * np.prod([e[x, z] for x, z in zip(s, path)]) * np.prod([a[x, y] for x, y in zip(path, path[1:])])
        total += p
        want_s[path[0]] += p
        for x, z in zip(s, path):
            want_e[x, z] += p
        for x, y in zip(path, path[1:]):
            want_a[x, y] += p
    assert np.allclose(emitted, want_e / total) and np.allclose(moves, want_a / total) and np.allclose(firsts, want_s / total)


def two_tongues(n=300):
    draw = random.Random(1)
    tongues = [["a%d" % i for i in range(40)], ["b%d" % i for i in range(40)]]
    return [(i, " ".join(draw.choices(draw.choice(tongues), k=draw.randint(1, 60)))) for i in range(n)]


def test_scores_beat_the_base_on_texts_held_out(table):
    docs = two_tongues() + [(1000, None), (1001, ""), (1001, ""), (None, "A1 rareword"), (1002, "a1 " * 20_000)]
    rows = score(table(docs), Model(states=4, heads=50, classes=16, rounds=6)).collect()
    held = {d for d, _ in docs if d is not None and zlib.crc32(str(d).encode()) % 10 == 0}
    tokens = [(d, [w.translate(reference.FOLD) for w in reference.words(t)] + ["</>"]) for d, t in docs]
    counts = Counter(w for d, ws in tokens if d not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (d or -1, d in held, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 3))
        for d, ws in tokens
    )
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=0.01)
    out = [r for r in rows if r.held_out and r.n_tokens < 100]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)


def test_no_texts_no_scores(table):
    assert score(table(two_tongues(3)).limit(0), Model(states=2, heads=4, classes=2, rounds=1)).count() == 0


# Main text


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.randoms())
def test_the_cut_costs_least(n, draw):
    content = [draw.choice([0.0, draw.random() * 4]) for _ in range(n)]
    boilerplate = [draw.choice([0.0, draw.random() * 4]) for _ in range(n)]
    ties = [(i, j, draw.random() * 2) for i in range(n) for j in range(i + 1, min(n, i + 3))]

    def cost(keep):
        return sum(boilerplate[i] if keep[i] else content[i] for i in range(n)) + sum(w for i, j, w in ties if keep[i] != keep[j])

    least = min(cost(k) for k in itertools.product([False, True], repeat=n))
    assert cost(minimum_cut(content, boilerplate, ties)) == pytest.approx(least, abs=1e-6)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><header><h2>Site</h2></header>
<div class="cookie-notice">We use cookies.</div><script>var x = "</p>";</script><!-- <p>no</p> -->
<article><h1>Title &amp; more</h1><p>One <b>bold</b>&nbsp;text,
 two<br>three.<p>It.</p><div class="ad">Buy this.</div><p>A &lt;tag&gt; and &#233;.</p>
<form><p>Your name</p></form><section id="comments"><p>First!</p></section></article>
<aside>Related <a href="/x">things</a></aside><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    want = "Title & more\nOne bold text, two three.\nIt.\nA <tag> and é."
    assert main_text(PAGE, np.zeros(8), CutRule()) == want


ARTICLE = "<article><h1>Title</h1><p>A whole story, told at length.</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        '<svg class="icon"/>%s',
        "<canvas/>%s<canvas>no</canvas>",
        "<div><object data='x'></div>%s<object>no</object>",
        "<button>%s<p><button>no</button></p>",
        "<svg><title/><style/></svg>%s",
        "<title-bar>%s",
        "<video><source src='x'>no</video>%s",
        "<svg><svg>no</svg>no</svg>%s<script>var no = 1</script >",
        '<div class="has-sidebar">%s</div>',
        '<div class="search-results with-comments" id="social-story-page">%s</div>',
        '<div class="sidebar"><div>%s</div></div>',
        "<form><main>%s</main></form>",
        '<div class="notice">no</div>%s<article class="related">no</article>',
    ],
)
def test_an_article_is_kept_whatever_stands_around_it(page):
    assert main_text(page % ARTICLE, np.zeros(8), CutRule()) == "Title\nA whole story, told at length."


@pytest.mark.parametrize(
    "name",
    "comment-list comments-area post-comments reader-comments user-comments comment-body related-posts share-buttons "
    "ad-slot site-footer site-header cookie-bar main-menu comments_thread post-footer newsletter-box".split(),
)
def test_what_names_make_no_part_of_an_article(name):
    inner = "<div class='%s'><p>No part of it, though it is long, too, and has stops.</p>%s</div>"
    page = f"<body>{inner % (name, '')}{ARTICLE[:-10]}{inner % ('wide ' + name, '')}</article></body>"
    if name.startswith(("comment", "related")):
        page += inner % (name, "<article><p>What a reader said.</p></article>")
    if name != "site-header":
        assert main_text(page, np.zeros(8), CutRule()) == "Title\nA whole story, told at length."
    assert "No part" not in main_text(page.replace("article", "main"), np.zeros(8), CutRule())


@pytest.mark.parametrize("name", "post-content article-body entry-header content-wrapper story-social-history page-title".split())
def test_what_names_leave_in_an_article(name):
    page = f"<article><div class='{name}'><p>A whole story.</p></div></article>"
    assert main_text(page, np.zeros(8), CutRule()) == "A whole story."


def test_pages_that_mark_nothing(spark):
    menu = "".join(f"<li><a href='/{i}'>Part {i}</a></li>" for i in range(8))
    story = "".join(f"<p>The story goes on, as told by all who were there, and then on again, {i}.</p>" for i in range(8))
    pages = spark.createDataFrame([(1, "u", f"<ul>{menu}</ul><div>{story}</div>")], "page_id long, url string, html string")
    text = extract(pages).first().text
    assert text.count("The story") == 8 and "Part" not in text


def test_a_cut_of_many_blocks_takes_little():
    random = np.random.default_rng(3)
    n = 12_000
    side = np.where(random.random(n) < 0.5, 1, 0)
    costs = random.random((2, n)) * 3
    ties = [(i, j, float(w)) for i in range(n) for j, w in zip(range(i + 1, min(i + 3, n)), random.random(2))]
    began = time.process_time()
    keep = minimum_cut((costs[0] * side).tolist(), (costs[1] * (1 - side)).tolist(), ties)
    assert 0 < sum(keep) < n and time.process_time() - began < 10


@pytest.mark.parametrize("page", [None, "", "<", "<p", "plain", "<p>a</", "<!--", "<script>x", "<a href='", "&amp", "<div>" * 3000 + "x"])
def test_broken_pages_do_no_harm(page):
    assert isinstance(main_text(page, np.zeros(8), CutRule()), str)
    assert all(b.text for b in blocks(page))


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars, r.text) for r in extract(pages).collect())
    text = main_text(PAGE, np.zeros(8), CutRule())
    assert got == [(0, 0, ""), (1, len(text), text), (1, len(text), text), (2, 0, "")]
    assert extract(pages.limit(0)).count() == 0


# Reply trees


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=6), st.text(alphabet="</s>[INST]|im_end\\ n\n<>", max_size=30)), max_size=4))
def test_formats_read_back(turns):
    template = reply_trees.Template()
    turns = [(r if i % 2 else "assistant", t) for i, (r, t) in enumerate(turns)] + [("user", c) for c in reply_trees.CONTROLS]
    text, spans = template.format(turns)
    assert template.read(text) == turns
    assert [reply_trees.unescape(text[a : a + n]) for a, n in spans] == [t for r, t in turns if r == "assistant"]
    for c in reply_trees.CONTROLS:
        assert c not in reply_trees.escape("".join(t for _, t in turns))


NODES = "tree string, node long, parent long, role string, text string, score double, leaf string"


def test_paths_ranks_and_cycles(spark):
    rows = [("t", i, i - 1 if i else None, "user", f"m{i}", 1.0, "x") for i in range(70)]
    rows += [("t", 100, 3, "assistant", "short", 90.0, "x"), ("t", 101, 100, None, None, None, "x")]
    rows += [("c", 1, 2, "u", "a", 0.0, "x"), ("c", 2, 1, "u", "b", 0.0, "x"), ("c", 3, 2, "u", "hangs", 0.0, "x")]
    rows += [("d", 5, 99, "u", "orphan", 0.0, "x"), ("d", 5, 99, "u", "orphan", 0.0, "x"), (None, 1, None, "u", "?", 0.0, "x"), ("e", None, None, "u", "?", 0.0, "x")]
    frame = spark.createDataFrame(rows, NODES)
    got = {(r.tree, r.rank): r for r in reply_trees.conversations(frame, branches=2).collect()}
    assert set(got) == {("t", 1), ("t", 2), ("d", 1)}
    read = lambda key: [t for _, t in reply_trees.Template().read(got[key].formatted)]
    assert read(("t", 1)) == ["m0", "m1", "m2", "m3", "short", ""] and got[("t", 1)].score == 94.0
    assert read(("t", 2)) == [f"m{i}" for i in range(70)] and read(("d", 1)) == ["orphan"]
    assert reply_trees.conversations(frame.limit(0)).count() == 0


def test_conversations_by_turn(spark):
    rows = [(1, 5, "assistant", "b"), (1, 2, "user", None), (1, 5, "assistant", "a"), (None, 0, None, "x"), (2, None, "user", "</s>")]
    made = reply_trees.conversations(reply_trees.as_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    back = reply_trees.read_back(made.withColumn("conv_id", F.when(F.col("tree") != reply_trees.NO_ID, F.col("tree")).cast("long")))
    got = {r.conv_id: r for r in back.collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == digest("user\n\nassistant\na\nassistant\nb\n") and got[1].loss_sha256 == digest("ab")
    assert got[None].turns_sha256 == digest("\nx\n") and got[2].loss_chars == 0


# Toxicity


def insults(n=600):
    draw = random.Random(5)
    good, bad = ["g%s" % "".join(draw.choices("abcdef", k=5)) for _ in range(200)], ["vile", "rotten", "zork"]
    docs, labels = [], []
    for i in range(n):
        toxic = draw.random() < 0.25
        w = draw.choices(good, k=draw.randint(5, 200))
        for _ in range(draw.randint(1, 6) * toxic):
            w.insert(draw.randrange(len(w)), draw.choice(bad) + draw.choice(["", ",", "."]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_texts_held_out_are_found(spark, table):
    docs, labels = insults()
    known = spark.createDataFrame([x for x in labels if x[0] < 400] + [(None, 1), (3, None)], "doc_id long, toxic int")
    docs += [(9000, None), (9001, ""), (None, "ZORK!"), (9002, "g" * 50 + " fine " * 50_000 + "vile")]
    rows = {r.doc_id: r for r in toxicity(table(docs), known).collect()}
    assert [i for i, t in labels if rows[i].kept == bool(t)] == []
    assert rows[9000].kept and rows[9001].kept and not rows[None].kept and not rows[9002].kept
    assert all(0 <= r.severity <= 3 for r in rows.values())
    heavy = [rows[i].severity for i, t in labels if t]
    assert max(heavy) > min(heavy) + 1
    whole = graded(table(docs), known)
    assert whole.select("row.*").columns == table(docs).columns and whole.count() == len(docs)


def test_without_labels_all_is_kept(spark, table):
    docs, _ = insults(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(table(docs), none).where("kept and severity = 0").count() == 20
    assert toxicity(table(docs).limit(0), none).count() == 0


def test_best_cut_has_the_fewest_errors():
    assert best_cut(np.array([0.0, 0, 2, 4]), np.array([False, False, True, True])) == 1.0
    assert best_cut(np.array([0.0, 1]), np.array([False, False])) > 1
