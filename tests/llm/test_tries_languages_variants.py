import itertools
import os
import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stocktrail.llm import language_crf, pivotal_grams, prefix_trie
from stocktrail.llm.language_crf import Rule, languages
from stocktrail.llm.pivotal_grams import near_words, pivots, roots, spelling_variants
from stocktrail.llm.prefix_trie import ZFastTrie, conversation_trie, fattest, rebuilt, trie_nodes
from stocktrail.llm.queries import tokenizer_path
from stocktrail.llm.token_ids import document_ids
from stocktrail.llm.words import slices
from stocktrail.llm import words as words_of
from tests.llm import reference

TURNS = "conv_id long, turn long, role string, text string, depth string, names long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)


def many_turns(seed, n=60):
    draw = random.Random(seed)
    out = []
    for c in range(n):
        first = draw.random() < 0.6
        for t in range(draw.randint(1, 12)):
            text = "common" if first and t < draw.randint(1, 9) else draw.choice(["a", "é b", "", None, "c" * 50])
            out.append((c * draw.choice([1, 1, 3]), t, draw.choice(["user", "assistant"]) if t % 3 else None, text))
    return out


ODD_TURNS = [
    (None, 0, "user", "no conversation"),
    (7, None, "user", "first"),
    (7, None, "user", "first"),
    (7, 2, "user", "tie b"),
    (7, 2, "user", "tie a"),
    (10**12 + 1, 0, "user", None),
    (-3, 0, "user", "below zero"),
    (-5, 0, None, "its base"),
]


def test_fattest_number_is_that_of_most_trailing_zeros():
    for low in range(40):
        for high in range(low + 1, 70):
            zeros = lambda x: (x & -x).bit_length()
            assert fattest(low, high) == max(range(low + 1, high + 1), key=zeros)


@pytest.mark.parametrize("batch", [1, 7, 500])
def test_trie_holds_branchings_and_ends_and_finds_exits(batch):
    draw = random.Random(3)
    whole = {tuple(draw.choice("ab") * draw.choice([1, 1, 9]) for _ in range(draw.randint(0, 14))) for _ in range(300)}
    whole |= {("a",) * 400, ("a",) * 399 + ("b",)}
    named = lambda s: [repr(s[: d + 1]).encode() for d in range(len(s))]
    order = sorted(whole)
    draw.shuffle(order)
    trie = ZFastTrie()
    for i in range(0, len(order), batch):
        trie.insert([named(s) for s in order[i : i + batch]])
    kids = Counter(p[:-1] for p in {s[:d] for s in whole for d in range(1, len(s) + 1)})
    want = {p for p in kids if kids[p] > 1} | whole | {()}
    assert len(trie.end) == len(want)
    assert {trie.name(v, trie.end[v]) if v else b"" for v in range(len(want))} == {repr(p).encode() if p else b"" for p in want}
    for s in [*order[:50], ("b",) * 20, ("a",) * 398, ("c",)]:
        deepest = max(d for d in range(len(s) + 1) if s[:d] in want)
        assert trie.end[trie.locate(named(s))] == deepest


@pytest.mark.parametrize("range_turns", [1, 40, 1 << 20])
def test_nodes_are_those_of_all_prefixes(spark, range_turns):
    rows = many_turns(range_turns) + ODD_TURNS
    got = trie_nodes(rebuilt(turns(spark, rows)), range_turns).collect()
    assert Counter(tuple(r) for r in got) == reference.trie(rows)


def test_one_conversation_many_times(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    rows = [(5 * c, t, "user", f"same {t}") for c in range(50) for t in range(3)]
    got = conversation_trie(turns(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == reference.trie(rows)


def test_no_conversations_have_no_root(spark):
    out = conversation_trie(turns(spark, []).where("false"))
    assert out.collect() == [] and out.columns[0] == "conv_id"


def test_pivots_are_the_lightest_disjoint_grams():
    draw = random.Random(1)
    for _ in range(300):
        places = sorted(draw.sample(range(14), draw.randint(3, 7)))
        weight = [draw.randint(1, 9) for _ in places]
        apart = [c for c in itertools.combinations(range(len(places)), 2) if places[c[1]] - places[c[0]] >= 2]
        got = pivots(places, weight)
        assert len(got) == 2 and got[1] - got[0] >= 2
        assert sum(weight[places.index(p)] for p in got) == min(weight[i] + weight[j] for i, j in apart)


@pytest.mark.parametrize("letters, size", [("ab", 900), ("abcé", 1500), ("a", 12)])
def test_near_words_are_all_those_one_edit_apart(spark, letters, size):
    draw = random.Random(size)
    n = {"".join(draw.choices(letters, k=draw.randint(5, 9))): draw.randint(3, 50) for _ in range(size)}
    n |= {"a" * k: 3 for k in range(5, 12)} | {"a" * 3000: 3, "a" * 1500 + "b" + "a" * 1499: 9}
    got = near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    want = {(a, n[a], b, n[b]) for a in n for b in n if reference.near(a, b)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_chains_of_forms_end_at_their_roots(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w3"), ("y", "x")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert set(got.values()) == {"w37"} and len(got) == 39


def test_variants_of_odd_documents(table):
    draw = random.Random(4)
    base = ["Straße", "naïveté", "colour", "Ünterwegs", "mississippi"]
    docs = [(None, "colour Colour COLOUR"), (1, None), (2, ""), (3, "12 §§ \u0130\u0131 \u4e2d"), (4, "colour" * 3000), (4, "colour" * 3000), (4, "colour" * 3000)]
    for d in range(300):
        some = []
        for _ in range(30):
            w = draw.choice(base)
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", "x", w[at] * 2]) + w[at + 1 :]
            some.append(w + draw.choice([" ", "×", "1", "\u2019", "\n"]))
        docs.append((d, "".join(some)))
    got = Counter(tuple(r) for r in spelling_variants(table(docs)).collect())
    n = reference.vocabulary(docs)
    assert got == reference.variants(n) and len(n) > 20


def test_text_in_pieces_has_the_same_runs(monkeypatch):
    text = "Ab\u00e9 cd-ef" * 200
    whole = [r for some in pivotal_grams.runs(text) for r in some]
    monkeypatch.setattr(pivotal_grams, "PIECE", 5)
    assert [r for some in pivotal_grams.runs(text) for r in some] == whole


def test_variants_without_words(table):
    assert spelling_variants(table([(1, "a b c"), (2, None)])).collect() == []


def labellings(likely, moves):
    """Weight of every labelling, the first word after any language."""
    k, n = likely.shape
    for labels in itertools.product(range(k), repeat=n):
        p = moves[:, labels[0]].mean() * likely[labels[0], 0]
        for t in range(1, n):
            p *= moves[labels[t - 1], labels[t]] * likely[labels[t], t]
        yield labels, p


@pytest.mark.parametrize("block", [1, 2, 3, 512])
def test_expected_words_are_sums_over_all_labellings(monkeypatch, block):
    monkeypatch.setattr(language_crf, "BLOCK", block)
    rng = np.random.default_rng(block)
    ends = np.array([0, 5, 5, 6, 10])
    likely, moves = np.exp(rng.normal(size=(3, 10))), np.exp(rng.normal(size=(3, 3)))
    want = np.zeros((4, 3))
    for i in range(4):
        if ends[i] < ends[i + 1]:
            rows = list(labellings(likely[:, ends[i] : ends[i + 1]], moves))
            total = sum(p for _, p in rows)
            for labels, p in rows:
                np.add.at(want[i], list(labels), p / total)
    assert np.allclose(language_crf.expected_words(likely.copy(), ends, moves), want)


def test_training_expectations_are_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    moves, likely = np.exp(rng.normal(size=(3, 3))), np.exp(rng.normal(size=(5, 2, 3)))
    real = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], dtype=bool)
    log, chance, moved = language_crf.chain_expectations(likely, real, moves)
    want, logs = np.zeros((3, 3)), 0.0
    for s, n in ((0, 5), (1, 3)):
        rows = list(labellings(likely[:n, s].T, moves))
        total = sum(p for _, p in rows)
        logs += np.log(total)
        each = np.zeros((n, 3))
        for labels, p in rows:
            each[np.arange(n), labels] += p / total
            for a, b in itertools.pairwise(labels):
                want[a, b] += p / total
        assert np.allclose(chance[:n, s], each)
        want += (moves / moves.sum(axis=0) * each[0])
    assert np.allclose(moved, want) and np.isclose(log, logs)


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_texts_get_their_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    out = languages(docs).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(lang) and 20 < len(held) < 100
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.95
    again = {r.doc_id: r for r in languages(docs.drop("n_chars").withColumnRenamed("source", "lang_pred")).collect()}
    assert all(again[r.doc_id].lang_pred == r.lang_pred for r in out)


def test_code_switched_and_odd_texts(table):
    draw = random.Random(6)
    kinds = {"en": "the thing with thorn", "de": "schon zwei schnell straße", "fr": "être élevé beaux leurs"}
    said = lambda k, n: " ".join(draw.choices(kinds[k].split(), k=n))
    docs = [(i, said(k, 30), k) for i, k in enumerate(draw.choices(list(kinds), k=90))]
    odd = [
        (500, None, "en"), (501, "", None), (502, "12 -- 34 ½", "en"), (503, "— …", "fr"), (None, said("de", 9), None),
        (504, said("en", 9) + " " + said("fr", 40), None), (504, "straße " * 20000, None), (505, "x" * 100000, None),
    ]
    rows = [(d, t, lang, "s") for d, t, lang in docs + odd]
    out = languages(table(rows), Rule(steps=30)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id != 504}
    assert [by_id[d] for d in (500, 501, 502, 503)] == [("und", 0.0)] * 4
    assert by_id[None][0] == "de" and by_id[505][0] != "und"
    mixed, long = sorted((r for r in out if r.doc_id == 504), key=lambda r: r.score)
    assert mixed.lang_pred == "fr" and 0.6 < mixed.score < 0.95 and long.lang_pred == "de"


def test_nothing_to_learn_from(table):
    assert [(r.lang_pred, r.score) for r in languages(table([(1, "hello", None, "s")])).collect()] == [("und", 0.0)]
    assert languages(table([(1, "hello", None, "s")]).where("false")).collect() == []


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_that_collide_in_a_polynomial_hash_are_told_apart(size):
    bits = [bin(i).count("1") % 2 for i in range(size)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    texts = pa.array([one, other, one.upper()], pa.large_string())
    part = next(slices(texts))
    assert len(set(part.hashes.tolist())) == 2 and part.hashes[0] == part.hashes[2]
    sets = [tuple(s) for s in words_of.shingles(part, 5)]
    assert sets[0] != sets[1] and sets[0] == sets[2]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    for text, ids in zip(texts.to_pylist(), document_ids(tokenizer_path(), texts, 1)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_texts_go_to_the_prediction_in_small_batches(spark, tmp_path, monkeypatch):
    """Batches of 10,000 texts took an executor's memory."""
    seen, predict = str(tmp_path), language_crf._predict

    def noted(model):
        run = predict(model)

        def note(batches):
            for batch in batches:
                with open(f"{seen}/{uuid.uuid4().hex}", "w") as file:
                    file.write(str(batch.nbytes))
                yield batch

        return lambda batches: run(note(batches))

    monkeypatch.setattr(language_crf, "_predict", noted)
    monkeypatch.setattr(language_crf, "BATCH_BYTES", 20_000, raising=False)
    docs = spark.range(400).selectExpr(
        "id AS doc_id", "repeat(if(id % 2 = 0, 'the word ', 'das wort '), 100) AS text", "if(id % 2 = 0, 'en', 'de') AS lang"
    )
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    out = languages(docs.coalesce(1), Rule(steps=5)).collect()
    assert {(r.doc_id, r.lang_pred) for r in out} == {(i, "de" if i % 2 else "en") for i in range(400)}
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(sizes) > 10 and max(sizes) < 60_000
    assert spark.conf.get(name, None) == before
