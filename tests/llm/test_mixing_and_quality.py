import random

import pytest
from pyspark.sql import functions as F

from stocktrail.llm.mixing import apportion, mix, mixed
from stocktrail.llm.outliers import Rule, quality
from tests.llm import reference


def test_seats_go_to_the_highest_quotients(spark):
    draw = random.Random(4)
    for _ in range(4):
        parties = [(f"p{i}", draw.choice([0.0, draw.uniform(0, 50), 7.0]), draw.randint(0, 80)) for i in range(9)]
        house = min(draw.randint(0, 150), sum(m for _, v, m in parties if v > 0))
        # Capacities that never bind below what the votes ask for, as in the mix.
        parties = [(n, v, max(m, int(v * house / max(sum(x for _, x, _ in parties), 1)) + 3)) for n, v, m in parties]
        rows = spark.createDataFrame([(n, v, m, house) for n, v, m in parties], "name string, votes double, most long, house long")
        got = {r.name: r.seats for r in apportion(rows, [], ["name"]).collect()}
        quotients = sorted(((-v / (2 * k + 1), n, k) for n, v, m in parties if v > 0 for k in range(m)))[:house]
        want = {n: sum(x[1] == n for x in quotients) for n, _, _ in parties}
        assert got == want


def corpus(n=400):
    draw = random.Random(9)
    sources = ["a"] * 6 + ["b", "c", "É", "z", None]
    return [(i, " ".join(["w"] * draw.randint(0, 300)), "en", draw.choice(sources)) for i in range(n)] + [
        (5000, None, None, None), (5001, "", "en", "tiny"), (5002, "one", "en", "small"), (3, "x y z", "en", "a"), (3, "x y z", "en", "a"),
    ]


def targets(docs):
    size = {}
    for _, t, _, s in docs:
        size[s] = size.get(s, 0) + len(reference.words(t))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), 1.5 * sum(size.values())
    while True:
        rest = total - sum(2 * size[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        above = {s for s in order if s not in full and rest * weight[s] / w > 2 * size[s]}
        if not above:
            return {s: 2.0 * size[s] if s in full else rest * weight[s] / w for s in order}, size
        full |= above


def test_mix_meets_its_targets(table):
    docs = corpus()
    want, size = targets(docs)
    rows = mix(table(docs), shard_rows=50).collect()
    assert len(rows) == len(docs)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.03 * t + 64
    again = mix(table(docs).repartition(7), shard_rows=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_the_mix_holds_the_words_it_took(table):
    docs = [(i, "\n ".join(f"w{i}.{k}" for k in range(i % 90)), "en", "abc"[i % 3]) for i in range(200)]
    frame = table(docs)
    taken = {r.doc_id: r.taken for r in mix(frame).collect()}
    out = mixed(frame)
    assert out.columns == frame.columns and out.schema == frame.schema
    text = dict((d, t) for d, t, _, _ in docs)
    got = {}
    for r in out.collect():
        assert r.text in text[r.doc_id] and r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(reference.words(r.text))
    # Whole passes over an empty text are rows too.
    assert {d: n for d, n in got.items() if n} == {d: n for d, n in taken.items() if n}


def test_nothing_to_mix(table):
    assert mix(table(corpus()).limit(0)).count() == 0 and mixed(table(corpus()).limit(0)).count() == 0


def test_counts_are_those_of_a_plain_version(table):
    draw = random.Random(2)
    docs = [(i, "".join(draw.choice(["a ", "b ", "c\n", "# ", "|<", "\t", "é ", "\x0b"]) for _ in range(draw.randint(0, 80)))) for i in range(300)]
    docs += [(900, None), (901, ""), (902, "a b c d e " * 2), (903, "same line\n" * 5), (904, "p q r s t u v " * 3000), (None, "x " * 12)]
    rows = quality(table(docs)).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((d or -1, *reference.counts(t)) for d, t in docs)
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def prose(draw, n):
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(n)) + "."


def test_far_documents_go_and_usual_ones_stay(table):
    draw = random.Random(6)
    docs = [(i, prose(draw, int(draw.lognormvariate(5, 0.6)) + 12), draw.choice(["en", None]), draw.choice("aab")) for i in range(500)]
    odd = [(1000 + i, " ".join("#$%&|" * 30 for _ in range(200)) + prose(draw, 20), "en", "a") for i in range(25)]
    odd += [(2000 + i, " ".join("x" * 400 + str(k) for k in range(200)), "en", "a") for i in range(5)]
    kept = {r.doc_id: r.kept for r in quality(table(docs + odd)).collect()}
    assert sum(kept[d[0]] for d in docs) >= 498
    assert not any(kept[d[0]] for d in odd)


def test_one_odd_statistic_is_enough(table):
    """Documents of usual length and words, but for one thing."""
    draw = random.Random(3)
    docs = [(i, prose(draw, int(draw.lognormvariate(5, 0.6)) + 12)) for i in range(400)]
    signs = [(1000, " ".join("".join(draw.choices("#*$%&|<>", k=5)) for _ in range(150)))]
    some = [(1001, " ".join(prose(draw, 1)[:-1] + draw.choice("#*$%") for _ in range(150)))]
    lines = [(1002, "\n".join(prose(draw, 4) + "\nRead more" for _ in range(30)))]
    passage = prose(draw, 14)
    repeats = [(1003, " ".join([passage, prose(draw, 112), passage]))]
    odd = signs + some + lines + repeats
    rows = {r.doc_id: r for r in quality(table([(*d, "en", "a") for d in docs + odd])).collect()}
    assert [rows[d].base_failed for d, _ in odd] == [False] * 4
    assert [rows[d].kept for d, _ in odd] == [False] * 4
    assert sum(rows[d].kept for d, _ in docs) >= 398


def test_too_few_documents_are_not_judged(table):
    draw = random.Random(6)
    docs = [(i, prose(draw, 30), "en", f"s{i}") for i in range(20)] + [(99, "#" * 900 + " " + prose(draw, 20), "fr", "s")]
    assert all(r.kept for r in quality(table(docs)).collect())
    assert quality(table(docs).limit(0)).count() == 0
    assert quality(table(docs * 9), Rule(least=1)).where(F.col("distance").isNull()).count() == 0
