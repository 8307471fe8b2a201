import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stocktrail.llm import shingle_join
from stocktrail.llm.components import components
from stocktrail.llm.exact_dedup import exact_duplicates
from stocktrail.llm.shingle_join import Jaccard, jaccard_components, possible_keys, signatures
from tests.llm import reference


def texts(seed, n=40, length=60):
    """Texts, many of them edited copies, and some with a shared passage."""
    draw = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = " ".join(draw.choices(vocabulary, k=50))
    out = []
    for _ in range(n):
        kind = draw.random()
        if kind < 0.5 or not out:
            out.append(" ".join(draw.choices(vocabulary, k=draw.randint(1, length))))
        elif kind < 0.6:
            out.append(passage + " " + " ".join(draw.choices(vocabulary, k=draw.randint(0, 30))))
        else:
            w = draw.choice(out).split()
            for _ in range(draw.randint(0, 3)):
                w[draw.randrange(len(w))] = draw.choice(vocabulary)
            out.append(" ".join(w[draw.randint(0, 2) :] or w))
    return out


SPECIAL = [
    (900, None),
    (901, ""),
    (902, " \n\t"),
    (903, "one two"),
    (904, "ONE\ntwo"),
    (905, "a b c d e f g"),
    (905, "a b c d e f g"),
    (906, "a b c d e f g h"),
    (None, "a b c d e f g"),
    (907, "é b c d e f g"),
    (908, "É b c d e f g"),
    (909, "z " * 30000),
    (910, "Z " * 30001),
]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [3, 4096])
def test_components_are_those_of_all_pairs(table, monkeypatch, seed, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    docs = [(1000 - i, t) for i, t in enumerate(texts(seed, 120))] + SPECIAL
    want = reference.linked_components(docs)
    rows = jaccard_components(table(docs)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles) for r in rows) == sorted(
        (d or -1, len(reference.shingles(t))) for d, t in docs
    )
    assert {(r.doc_id, r.component_id) for r in rows} == {(d, want.get(d)) for d, _ in docs}


def test_no_documents_no_components(table):
    assert jaccard_components(table(SPECIAL).limit(0)).count() == 0


def test_linked_sets_share_a_key_whatever_is_frequent():
    """Sets at the threshold, with random keys declared frequent."""
    import numpy as np

    rng, rule = np.random.default_rng(5), Jaccard()
    for size in [1, 2, 3, 4, 7, 8, 15, 16, 31, 32, 33, 60, 64, 100, 127, 128, 170, 300]:
        for _ in range(12):
            base = np.unique(rng.integers(1, 2**63, size, dtype=np.uint64))
            far = rule.distance(size, size)
            gone = rng.integers(0, far + 1)
            other = np.setdiff1d(base, rng.choice(base, min(gone, size), replace=False))
            other = np.unique(np.append(other, rng.integers(1, 2**63, far - min(gone, size), dtype=np.uint64)))
            if not other.size or not rule.linked(base, other):
                continue
            every = np.unique(np.concatenate(list(possible_keys(rule, [base, other]))))
            some = np.sort(rng.choice(every, every.size // 2, replace=False))
            hot = shingle_join.Hot(some, rng.integers(1, 9, some.size))
            (_, a), (_, b) = signatures(rule, [base], hot), signatures(rule, [other], hot)
            assert np.intersect1d(a, b).size


def test_sets_signed_together_get_the_keys_they_get_alone():
    import numpy as np

    rng, rule = np.random.default_rng(8), Jaccard()
    sizes = [0, 1, 2, 5, 16, 17, 31, 40, 63, 64, 85, 300, 0, 16, 1500, 3]
    sets = [np.unique(rng.integers(1, 2**63, n, dtype=np.uint64)) for n in sizes]
    sets.append(sets[5])
    every = np.unique(np.concatenate(list(possible_keys(rule, sets))))
    some = rng.choice(every, every.size // 3, replace=False)
    hot = shingle_join.Hot(some, rng.integers(1, 1 << 26, some.size))
    owner, keys = signatures(rule, sets, hot)
    for i, one in enumerate(sets):
        alone = signatures(rule, [one], hot)[1]
        assert np.array_equal(np.sort(keys[owner == i]), np.sort(alone))
        assert bool(alone.size) == bool(one.size)


def test_parities_differ_in_no_more_places_than_sets():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (1, 5, 64, 700):
        a = np.unique(rng.integers(1, 2**63, size, dtype=np.uint64))
        b = np.union1d(a[: size // 2 + 1], rng.integers(1, 2**63, size * 2, dtype=np.uint64))
        x, y = shingle_join.parities(a), shingle_join.parities(b)
        n = min(x.size, y.size)
        differ = np.bitwise_count(shingle_join._folded(x, n) ^ shingle_join._folded(y, n)).sum()
        assert differ <= np.setxor1d(a, b).size


def test_pairs_of_a_forest_grow_with_the_documents_not_their_square():
    import numpy as np
    import pyarrow as pa

    sketch = shingle_join.parities(np.arange(1, 9, dtype=np.uint64)).tobytes()
    names = ["cell", "doc", "component", "side", "n", "sketch"]
    for docs, labels in ((300, 300), (300, 3)):
        rows = [(7, d, d % labels, 0, 8, sketch) for d in range(docs)] + [(8, 0, 0, 0, 8, sketch), (8, 1, 1, 0, 8, sketch)]
        batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=names)
        out = shingle_join._across(Jaccard(), forest=True)([batch])
        got = [p for one in out for p in zip(*one.to_pydict().values())]
        pairs = {(a, b) for a, b, cell in got if cell is None}
        assert labels - 1 <= len(pairs) < docs and all(a % labels != b % labels for a, b in pairs)
        # The cell of two documents has nothing left out.
        assert [cell for _, _, cell in got if cell is not None] == [7]


def test_near_copies_of_one_text_are_linked_as_all_pairs_link_them(table):
    """Few of them link with the least document; some at no more than one place of a long chain."""
    draw = random.Random(4)
    words = ["w%d" % i for i in range(60)]
    docs = []
    for i in range(60):
        copy = list(words)
        for at in draw.sample(range(60), draw.randint(1, 4)):
            copy[at] = "x%d" % draw.randint(0, 3)
        docs.append((i, " ".join(copy)))
    want = reference.linked_components(docs)
    assert 1 < len(set(want.values())) < 60
    rows = jaccard_components(table(docs)).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(d, want.get(d)) for d, _ in docs}


@pytest.mark.parametrize("blocks", [1, 2])
def test_pairs_across_components_of_equal_size_in_any_order(blocks):
    import itertools

    import numpy as np
    import pyarrow as pa

    sketch = shingle_join.parities(np.arange(1, 9, dtype=np.uint64)).tobytes()
    names = ["cell", "doc", "component", "side", "n", "sketch"]
    for labels in ([1, 1, 2, 2], [1, 1, 2, 2, 3, 3], [1, 2, 2, 3, 3]):
        for order in sorted(set(itertools.permutations(labels))):
            rows = [(7, d, c, 0 if blocks == 1 else 1 + d % 2, 8, sketch) for d, c in enumerate(order)]
            want = {
                (a[1], b[1])
                for a in rows
                for b in rows
                if a[1] > b[1] and a[2] != b[2] and (blocks == 1 or a[3] != b[3])
            }
            batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=names)
            got = [p for out in shingle_join._across(Jaccard())([batch]) for p in zip(*out.to_pydict().values())]
            assert sorted(got) == sorted(want), order


@pytest.mark.parametrize("forest", [False, True])
def test_small_cells_go_pair_by_pair_as_large_ones_by_arrays(forest, monkeypatch):
    """Arrays for each of many cells of a few documents took most of a task."""
    import numpy as np
    import pyarrow as pa

    rng, rows, doc = np.random.default_rng(5), [], 0
    for cell in range(150):
        base, blocks = rng.integers(0, 2**63, 140).astype(np.uint64), rng.integers(1, 3)
        for _ in range(rng.integers(2, 7)):
            some, doc = base[: int(rng.choice([60, 62, 66, 100, 140]))], doc + 1
            component = -cell if rng.random() < 0.3 else doc
            side = 0 if blocks == 1 else 1 + doc % 2
            rows.append((cell, doc, component, side, len(some), shingle_join.parities(some).tobytes()))
    assert len({len(r[5]) for r in rows}) > 1
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["cell", "doc", "component", "side", "n", "sketch"])
    got, sorts, lexsort = {}, [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorts.append(1) or lexsort(keys))
    for few in (0, 16):
        monkeypatch.setattr(shingle_join, "FEW", few, raising=False)
        out = shingle_join._across(Jaccard(), forest)([batch])
        out = [p for one in out for p in one.to_pylist()]
        pairs = [(r["a"], r["b"]) for r in out if r["a"] is not None]
        of = {r[1]: r[2] for r in rows}
        linked = {(max(of[a], of[b]), min(of[a], of[b])) for a, b in pairs}
        left = {r["cell"] for r in out if r.get("cell") is not None}
        got[few] = (reference.union(linked, set(of.values())), left if forest else set(pairs))
        if few == 0:
            assert pairs and (left or not forest) and sorts
            sorts.clear()
    assert not sorts and got[0][0] == got[16][0]
    # Pair by pair, a cell is left open only for pairs that may be linked.
    assert got[16][1] <= got[0][1] if forest else got[16][1] == got[0][1]


def test_connected_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i + 1, i) for i in range(1, 40)] + [(100 + i, 100) for i in range(1, 30)] + [(201, 200), (202, 201), (202, 200)]
    draw = random.Random(1)
    draw.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == reference.union(links, {n for x in links for n in x})


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


COPIES = SPECIAL + [(i, "same Text") for i in range(50)] + [(77, "SAME text"), (None, "only here"), (None, "Only here")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("runs,fan", [(1, 2), (16, 2), (512, 8)])
def test_one_row_of_equal_texts_is_kept(table, keep, runs, fan):
    fold = lambda t: (t or "").translate(reference.FOLD)
    groups = {}
    for d, t in COPIES:
        groups.setdefault(fold(t), []).append(d)
    rows = exact_duplicates(table(COPIES), runs, fan, keep).collect()
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(COPIES)
    kept = {}
    for r in rows:
        ids = digest[r.text_sha256]
        named = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        best = (max if keep == "largest" else min)(named) if named else None
        if keep == "largest" or None not in ids:
            assert r.keep_id == best
        if r.kept:
            kept.setdefault(r.text_sha256, []).append(r.doc_id)
    assert all(len(kept[d]) == 1 for d in digest)


def test_nothing_to_deduplicate(table):
    assert exact_duplicates(table(COPIES).limit(0)).count() == 0


def test_half_of_all_rows_may_be_copies(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    rows = exact_duplicates(docs).where("text_sha256 = sha2('hot', 256)").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in rows] == [(3998, 2000, 2000)]
