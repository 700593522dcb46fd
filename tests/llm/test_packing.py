"""Packing: ids against the library, pieces against plain slices, sequences
against the rules of a packing and against best fit alone."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from incidentlake.llm import queries
from incidentlake.llm.packing import Grouping, WordIds, _cut, pack, sequences, token_pieces

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


LIBRARY = Tokenizer.from_file(WORDS)


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def texts():
    rng = random.Random(2)
    letters = "abcdeXYZ 's't 0123.,!?-_é́ßΣσÅ漢字😀 　 \u0085\x0b\x0c\x1c\t\n\r<|>"
    out = [None, "", " ", "\n\x0b", "Hello World's end", "<|endoftext|>", "a<|startoftext|>b c", "ΑΣ ΑΣ. İI", "é ́x", "don't DON'T 've x've"]
    out += ["Èonai,ÉAI.x ×a÷b aİb <|END|> <| ab<|cd É́ ɏa ɐB 12ab34 a\x7fb ʰa ʱ", "mañana,Straße!ÀÉ x'S y’s a_b--c ... <|endoftext|>,x 3.14% #tag"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    return [*out, "word " * 5000, "x" * 9000, out[4], out[4]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, i, "k") for i, t in enumerate(texts())] + [(4, texts()[4], 4, 4, "k"), (None, "no id", -1, -1, "k")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, piece int, offset int, key string").repartition(5)


def test_pieces_are_slices_of_the_librarys_ids(spark, docs):
    rows = token_pieces(docs, WORDS, capacity=64).collect()
    assert token_pieces(docs, WORDS).columns == ["doc_id", "offset", "key", "piece", "start", "length", "ids"]
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, text in enumerate(texts()):
        want = library_ids(text)
        found = sorted(by_doc[i], key=lambda r: r.piece)
        found = found[:: 2 if i == 4 else 1]  # a repeated row
        assert [r.piece for r in found] == list(range(len(found)))
        assert [r.start for r in found] == [r.piece * 64 for r in found]
        assert [x for r in found for x in np.frombuffer(r.ids, "<u4").tolist()] == want
        assert all(r.length == len(r.ids) // 4 <= 64 for r in found) and all(r.length == 64 for r in found[:-1])
    assert token_pieces(docs.limit(0), WORDS).count() == 0


def test_ids_of_random_characters():
    """All of Latin, with signs between letters, white space of all kinds and others."""
    rng = random.Random(77)
    chars = [chr(c) for c in [*range(1, 0x280), 0x300, 0x301, 0x3A3, 0x2019, 0x4E00, 0x1F600, 0x2028, 0x3000]]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(1, 80))) for _ in range(2000)]
    words, got = WordIds(WORDS), []
    for k in range(0, len(texts), 500):
        for pieces in _cut(pa.array(texts[k : k + 500]), words, 64, 0):
            got.append([x for p in pieces.as_py() for x in np.frombuffer(p["ids"], "<u4").tolist()])
    assert got == [library_ids(t) for t in texts]


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity or len(members) == 1
    return len(bins)


def best_fit(lengths, capacity):
    g = Grouping(np.array(lengths, np.int64), capacity, np.random.default_rng(0))
    return g.cost(g.start(0.0))[0], g.bound


def test_packing_of_random_lengths(spark):
    rng = random.Random(9)
    cases = {
        "small": [rng.randrange(1, 40) for _ in range(900)],
        "halves": [rng.randrange(30, 70) for _ in range(700)],
        "large": [rng.randrange(51, 101) for _ in range(300)],
        "triples": [x for _ in range(120) for a, b in [(rng.randrange(20, 45), rng.randrange(20, 45))] for x in (a, b, 100 - a - b)],
        "one": [7],
    }
    for lengths in cases.values():
        table = spark.createDataFrame([(i, x, "k") for i, x in enumerate(lengths)], "doc_id bigint, length bigint, key string").repartition(3)
        rows = pack(table, capacity=100, block=250, generations=12).collect()
        assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths)) and {r.key for r in rows} == {"k"}
        n, (greedy, bound) = check_packing(rows, 100), best_fit([x for x in lengths if x < 100], 100)
        assert bound + sum(x >= 100 for x in lengths) <= n <= greedy + sum(x >= 100 for x in lengths) + 1 + len(lengths) // 250


def test_crossover_improves_on_best_fit():
    rng = random.Random(1)
    lengths = np.array([x for _ in range(60) for a, b in [(rng.randrange(20, 45), rng.randrange(20, 45))] for x in (a, b, 100 - a - b)], np.int64)
    g = Grouping(lengths, 100, np.random.default_rng(3))
    first = g.evolve([], 5, 0)
    last = g.evolve(first, 5, 200)
    assert g.cost(last[0]) < g.cost(first[0])
    for bins in (g.cross(last[0], first[-1]), g.mutate(last[0])):
        assert (bins >= 0).all() and (g.fill(bins) <= 100).all() and (g.fill(bins) > 0).all()


def test_odd_lengths(spark):
    table = spark.createDataFrame([(1, None), (2, 0), (3, -4), (4, 100), (5, 250), (6, 1), (6, 1), (None, 99)], "doc_id bigint, length bigint")
    rows = pack(table, capacity=100).collect()
    assert len(rows) == 8 and {r.doc_id for r in rows if r.sequence_id is None} == {1, 2, 3}
    assert check_packing([r for r in rows if r.sequence_id is not None], 100) == 4
    assert pack(table.limit(0)).columns == ["doc_id", "length", "sequence_id", "offset"] and pack(table.limit(0)).count() == 0


def test_sequences_hold_their_pieces(spark, docs):
    packed = pack(token_pieces(docs, WORDS, capacity=256), capacity=256).cache()
    made = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in sequences(packed).collect()}
    rows = packed.collect()
    for r in rows:
        assert made[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    assert sum(map(len, made.values())) == sum(r.length for r in rows) and max(map(len, made.values())) <= 256


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = queries.op11_best_fit_packing(spark, path).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    total = 0
    for doc_id, text in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array(library_ids(text), "<u4")
        total += len(ids)
        want = [(k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id]) == want
    assert len(rows) == sum(map(len, by_doc.values()))
    short = [r.length for r in rows if r.length < 2048]
    assert check_packing(rows, 2048) <= best_fit(short, 2048)[0] + len(rows) - len(short)
    assert total == sum(r.length for r in rows)
