"""Periodic runs against a search of every lag, on random words over small and
large alphabets, planted repeats, and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentlake.llm import queries
from incidentlake.llm.periodic_runs import digest, find_runs, repeat_tails, runs_of


def brute_runs(words, min_length=6, min_exponent=4):
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            end = x
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - x + q
            stretch = words[x : x + length]
            smallest = next(r for r in range(1, q + 1) if all(stretch[i] == stretch[i + r] for i in range(length - r)))
            if length >= max(min_length, min_exponent * q) and smallest == q:
                out.append((x, length, q))
            x = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(kept)))


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 40])
def test_runs_of_random_sequences(letters):
    rng = random.Random(letters)
    for _ in range(300):
        words = [rng.randrange(letters) for _ in range(rng.randrange(0, 70))]
        if rng.random() < 0.7:  # a planted period, at times of a periodic block
            block = [rng.randrange(letters) for _ in range(rng.randrange(1, 14))] * rng.choice((1, 1, 2))
            at = rng.randrange(len(words) + 1)
            words[at:at] = (block * 9)[: rng.randrange(1, 9 * len(block) + 1)]
        assert runs_of(np.array(words, np.int64)) == brute_runs(words)


def test_long_periods_whose_words_all_repeat():
    rng = random.Random(5)
    for q in (16, 31, 32, 33, 100):
        words = [rng.randrange(2) for _ in range(q)] * 4
        words = [2, *words, words[0], 3]
        assert runs_of(np.array(words, np.int64)) == brute_runs(words)


def test_other_thresholds():
    rng = random.Random(8)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(60)]
        assert runs_of(np.array(words, np.int64), 8, 3) == brute_runs(words, 8, 3)
    with pytest.raises(ValueError):
        runs_of(np.array([1, 1, 1], np.int64), 6, 2)


def texts():
    rng = random.Random(3)
    some = lambda n, k: " ".join(rng.choice("abcdeéß漢")[:1] + str(rng.randrange(k)) for _ in range(n))
    out = [None, "", " \t\n\x0b", "one", "a " * 6, "a\x0ba\x0ca\ra a\ta", "a b " * 4, "a b " * 3 + "a", "x y " * 5 + "x y", "a\x1ca " * 9]
    out += [some(rng.randrange(1, 90), 2) for _ in range(60)] + [some(40, 50) + " " + "k l m " * 30 + some(40, 50)]
    return out + [some(900, 1), some(150, 500) * 5, out[5], out[5]]


def test_digest_of_all_texts(spark):
    rows = [(i, t, "r", i) for i, t in enumerate(texts())]
    rows += [rows[7], (None, "z z z z z z", "r", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, found int").repartition(4)
    found = find_runs(repeat_tails(docs))
    assert sorted(found.columns) == ["collapsed", "doc_id", "found", "runs", "text"]
    got = sorted(map(tuple, digest(found).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t, *_ in rows), key=str)
    assert find_runs(docs, keep_text=False).columns == ["doc_id", "found", "runs", "collapsed"]
    named = {r[0]: r.text for r in find_runs(docs.select("doc_id", "text"), collapsed="text").collect()}
    assert named[4] == "a" and named[0] == ""
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t, *_ in rows)
    assert {r.found for r in found.collect()} == {r[3] for r in rows}
    assert digest(find_runs(repeat_tails(docs.limit(0)))).count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").where(F.length("text") < 1500).collect()
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, path).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == expected(doc_id, text)
