"""Product codes against plain integer arithmetic over every entry."""

import hashlib
import math
import random

import numpy as np
import pytest

from incidentlake.llm import queries, vector_codes
from incidentlake.llm.vector_codes import NearestEntry, compress, encode, integers, train

SCHEMA = "vec_id bigint, embedding array<float>, label int, x int, id string"


def plain(rows, parts=4, entries=256, rounds=4):
    """(vec_id, vector, label) -> (vec_id, code, error, label_error, sha)."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], l) for i, v, l in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = lambda x: [tuple(x[k * w : k * w + w]) for k in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(x)[k] for _, x, _ in first] for k in range(parts)]

    def nearest(k, p):
        d = [sum((a - b) ** 2 for a, b in zip(p, e, strict=True)) for e in books[k]]
        return min(range(len(d)), key=lambda i: (d[i], i)), min(d)

    for _ in range(rounds):
        groups = {}
        for _, x, _ in kept:
            for k, p in enumerate(cut(x)):
                groups.setdefault((k, nearest(k, p)[0]), []).append(p)
        for (k, i), members in groups.items():
            books[k][i] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], {}
    for i, x, label in kept:
        found = [nearest(k, p) for k, p in enumerate(cut(x))]
        error = sum(d for _, d in found)
        total[label] = total.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for k, _ in found), error, label))
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=str)


def sample(n=700, dim=8, seed=1):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.1) for _ in range(dim)] for _ in range(40)]
    rows = []
    for i in range(n):
        v = [c + rng.gauss(0, 0.01) for c in rng.choice(base)] if rng.random() < 0.7 else [rng.gauss(0, 0.3) for _ in range(dim)]
        rows.append((i * 3 % n, v, rng.choice([1, 1, 1, 2, None]), 0, "id"))
    nan, inf = float("nan"), float("inf")
    odd = [None, [None] * dim, [nan] + [0.0] * (dim - 1), [inf] + [0.0] * (dim - 1), [0.0] * dim, [-0.0] * dim, [0.5] * dim, [-0.5 / 1024] * dim]
    rows += [(n + k, v, None, 0, "id") for k, v in enumerate(odd)] + [rows[3], rows[3], (None, [0.25] * dim, 2, 0, "id"), (5, [0.3] * dim, 1, 0, "id")]
    return rows


def test_nearest_entry_is_exact_at_every_width():
    rng = np.random.default_rng(4)
    entries = rng.integers(-300, 300, (200, 5))
    entries[17] = entries[3]  # a tie
    parts = np.concatenate([rng.integers(-400, 400, (900, 5)), entries, entries + 1])
    d = np.square(parts[:, None, :] - entries[None]).sum(axis=2)
    for width in (1, 7, 64, 1000, None):
        for cells in (3, 50_000):
            search = NearestEntry(entries, width, cells)
            for _ in range(2):
                index, distance = search(parts)
                assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    narrow = NearestEntry(entries, 16)
    narrow(parts), narrow(parts)
    assert narrow.computed < narrow.met / 2 + 1 and narrow.compared < narrow.met * len(entries) / 4


def test_compress(spark):
    rows = sample()
    got = compress(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain([r[:3] for r in rows])


def test_few_and_no_rows(spark):
    rows = sample()[:9]
    table = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, compress(table).collect()), key=str) == plain([r[:3] for r in rows])
    assert compress(table.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert compress(table.limit(0)).count() == 0
    assert compress(table.where("vec_id < 0")).count() == 0


def test_other_lengths_and_huge_components_are_left_out(spark):
    rows = [(i, [0.1 * i] * 8, None, 0, "") for i in range(6)] + [(7, [0.1] * 4, None, 0, ""), (8, [0.1] * 7, None, 0, ""), (9, [], None, 0, ""), (10, [1e30] * 8, None, 0, "")]
    got = compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.vec_id for r in got) == list(range(6))


def test_codes_decode_to_their_entries(spark):
    rows = integers(spark.createDataFrame(sample(), SCHEMA), "vec_id", "embedding")
    books = train(rows, entries=16, rounds=2)
    joined = encode(rows, books).join(rows.select("id", "x"), "id").where("id > 10").collect()
    assert len(joined) > 600
    for r in joined:
        assert r.error == sum((a - b) ** 2 for a, b in zip(r.x, books.vector(r.code), strict=True))
    with pytest.raises(ValueError):
        train(rows, entries=257)


def test_query(spark):
    path = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = sorted(map(tuple, queries.op12_vector_codes(spark, path).collect()), key=str)
    assert got == plain([tuple(r) for r in table])
    assert vector_codes.ENTRIES == 256
