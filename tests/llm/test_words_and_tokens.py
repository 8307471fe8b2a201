import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from stocktrail.llm import packing, token_ids
from stocktrail.llm.elias_fano import EliasFano, TokenFile, token_table
from stocktrail.llm.packing import fullest, pack, plan, solve_patterns
from stocktrail.llm.queries import END_ID, tokenizer_path
from stocktrail.llm.token_ids import document_ids
from stocktrail.llm.words import shingles, slices, sparing
from tests.llm import reference

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\n\t\x0b\x1f\x85ñ.|'1-", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    seen = {}
    for part in slices(pa.array(texts, pa.string())):
        for i in range(part.n):
            want = reference.words((texts[part.first + i] or "").translate(reference.FOLD))
            got = part.hashes[part.ends[i] : part.ends[i + 1]].tolist()
            assert len(got) == len(want)
            for w, h in zip(want, got):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_short_and_repeated_texts():
    texts = ["a b c d e", "A  B\nC d E", "a b c d", "", None, "a b c d e a b c d e"]
    got = [s for part in slices(pa.array(texts)) for s in shingles(part, 5)]
    assert [len(s) for s in got] == [len(reference.shingles(t)) for t in texts]
    assert got[0].tolist() == got[1].tolist() and got[2].tolist() != got[0].tolist()


def test_a_text_longer_than_a_slice():
    text = "word " * 400_000 + "last"
    parts = list(slices(pa.array(["x", text, "y"])))
    assert sum(len(p.hashes) for p in parts) == 400_003
    assert len({int(h) for p in parts for h in p.hashes}) == 4


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_the_librarys(library):
    draw = random.Random(3)
    letters = "aB'sStT dD\n\t\x0b\x1f\x85 é́E12<|>#ΣσςİßKÅ한글가‍🙂=≠̸|'!"
    specials = ["<|endoftext|>", "'ll", "'ve", "<|startoftext|>"]
    texts = [None, "", " ", "don't'S 'Sx", "x" * 3000, "<|endoftext|>"] + [
        "".join(draw.choice(letters) if draw.random() < 0.93 else draw.choice(specials) for _ in range(draw.randint(0, 16)))
        for _ in range(4000)
    ]
    for text, ids in zip(texts, document_ids(tokenizer_path(), pa.array(texts), END_ID)):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids + [END_ID], text


def test_encoder_table_grows_and_learns_some_parts_at_a_time(library, monkeypatch):
    monkeypatch.setattr(token_ids, "FIRST_PLACES", 64)
    monkeypatch.setattr(token_ids, "LEARN_BYTES", 100)
    encoder, asked = token_ids.Encoder(tokenizer_path()), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda keys, parts: (asked.append(sum(map(len, parts))), learn(keys, parts)))
    texts = [" ".join(f"{chr(97 + i % 26)}{'xyz' * (i % 5)} {i}" for i in range(k, k + 700)) for k in (0, 350, 0)]
    for part in slices(pa.array(texts), parts=True):
        ids, edges = encoder.ids(part)
        for i in range(part.n):
            want = library.encode(texts[part.first + i], add_special_tokens=False).ids
            assert ids[edges[i] : edges[i + 1]].tolist() == want
    assert max(asked) < 130 and len(asked) > 10
    assert 4 * len(encoder.n) <= encoder.places < 16 * len(encoder.n)


def test_workers_get_small_batches_of_texts_to_pack(spark, tmp_path, monkeypatch):
    """Batches of 10,000 texts took an executor's memory."""
    seen, pieces = str(tmp_path), packing._pieces

    def noted(tokenizer, end, length):
        def note(batches):
            for batch in batches:
                with open(f"{seen}/{uuid.uuid4().hex}", "w") as file:
                    file.write(str(batch.nbytes))
                yield batch

        run = pieces(tokenizer, end, length)
        return lambda batches: run(note(batches))

    monkeypatch.setattr(packing, "_pieces", noted)
    monkeypatch.setattr(packing, "BATCH_BYTES", 20_000)
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat(id, ' word '), 100) AS text").coalesce(1)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    assert pack(docs, tokenizer_path(), END_ID).select("doc_id").distinct().count() == 400
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(sizes) > 10 and max(sizes) < 60_000
    assert spark.conf.get(name, None) == before


def test_grading_toxicity_gives_freed_memory_back(monkeypatch):
    """What its workers kept lay beside the memory of the pipeline's later stages."""
    from types import SimpleNamespace

    from stocktrail.llm import toxicity, words

    given = []
    monkeypatch.setattr(words, "_give_back", lambda: given.append(1))
    assert list(toxicity._predict(toxicity.Rule(), SimpleNamespace(value=None))(iter([]))) == []
    assert len(given) == 2


def test_sparing_changes_no_batch():
    batches = [pa.record_batch([pa.array([i, i + 1])], names=["n"]) for i in range(3)]
    assert list(sparing(lambda given: (b.slice(1) for b in given))(iter(batches))) == [b.slice(1) for b in batches]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=400))
def test_elias_fano_gives_back_each_number(values):
    values = sorted(values)
    code = EliasFano.from_bytes(EliasFano.of(np.array(values, dtype=np.uint64)).to_bytes())
    assert code.all().tolist() == values
    assert [code[i] for i in range(len(code))] == values


def test_elias_fano_is_near_the_least_space():
    values = np.sort(np.random.default_rng(0).integers(0, 10**9, 20_000))
    bits = 8 * len(EliasFano.of(values).to_bytes()) / len(values)
    assert bits < 2 + np.log2(10**9 / 20_000) + 1


def test_token_file_round_trip_and_damage():
    documents = [np.array(d, dtype=np.uint16) for d in ([5, 1], [1], [1], [7, 8, 9, 1])]
    data = TokenFile.pack([None, -4, -4, 2**62], documents, 2)
    file = TokenFile(data)
    assert [file.doc_id(i) for i in range(4)] == [None, -4, -4, 2**62]
    assert [file.document(i).tolist() for i in range(4)] == [d.tolist() for d in documents]
    assert [file.holder(p) for p in range(8)] == [0, 0, 1, 2, 3, 3, 3, 3]
    with pytest.raises(ValueError):
        TokenFile(data[:40] + b"?" + data[41:])


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


DOCS = [(9, "Hello there, World!"), (2, None), (5, ""), (7, "été " * 900), (7, "été " * 900), (7, "b"), (None, "none")]


def test_token_table_reads_back_what_the_library_says(table, library):
    got = [tuple(r) for r in token_table(table(DOCS), tokenizer_path(), END_ID).collect()]
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in DOCS]
    assert sorted((d is not None, d or 0, len(i), crc(i)) for (d, _), i in zip(DOCS, want)) == sorted(
        (d is not None, d or 0, n, c) for d, _, n, c in got
    )
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [None, 2, 5, 7, 7, 7, 9]


def test_no_documents_no_files(table):
    assert token_table(table(DOCS).limit(0), tokenizer_path(), END_ID).count() == 0


def test_linear_program_of_a_known_optimum():
    # Two of 5 or three of 3 fill 10 and 9 of 10; 5 and 3 can share.
    patterns, times = solve_patterns(np.array([5, 3]), np.array([10.0, 9.0]), 10)
    assert abs(times.sum() - 8) < 0.1 and np.all(patterns.T @ np.array([5, 3]) <= 10)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 30), min_size=1, max_size=12))
def test_plans_hold_exactly_the_demand(demand):
    sizes = sorted(demand)
    made = plan(sizes, [demand[s] for s in sizes], 32)
    held = dict.fromkeys(range(len(sizes)), 0)
    for pattern, many in made:
        assert sum(sizes[i] * n for i, n in pattern.items()) <= 32
        for i, n in pattern.items():
            held[i] += n * many
    assert list(held.values()) == [demand[s] for s in sizes]


def test_fullest_fills_best():
    pattern = np.zeros(3, dtype=int)
    fullest(np.array([7, 5, 4]), np.array([1, 1, 2]), 13, pattern)
    assert (pattern * [7, 5, 4]).sum() == 13


def test_packing_places_every_id_once(table, library):
    docs = DOCS + [(100 + i, "word " * (37 * i % 5000)) for i in range(60)]
    rows = pack(table(docs), tokenizer_path(), END_ID).collect()
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    assert sum(r.length for r in rows) == sum(want)
    for (doc, tokens), spans in pieces.items():
        if doc != 7:
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at == tokens
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) * 2048 < 1.1 * sum(want)
    ids = library.encode("Hello there, World!", add_special_tokens=False).ids + [1]
    assert [r.ids_crc32 for r in rows if r.doc_id == 9] == [crc(ids)]


def test_packing_nothing(table):
    assert pack(table(DOCS).limit(0), tokenizer_path(), END_ID).count() == 0
