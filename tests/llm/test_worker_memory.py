"""What a task of operators 3 and 10 holds at once, beside its results."""

import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from incidentlake.llm import language_id, ngram_join
from incidentlake.llm._ship import ship
from incidentlake.llm._text import shingle_sets, utf8


def _texts(n: int, words: int) -> list[str]:
    draw = random.Random(7)
    return [" ".join(draw.choice("abcdefgh") * draw.randint(1, 9) for _ in range(words)) for _ in range(n)]


def test_language_tasks_stay_small():
    """A batch of 3 MB is scored and counted with the arrays of a slice."""
    texts = _texts(300, 1700)
    batch = pa.record_batch({"__text": texts, "text": texts, "lang": ["x", "y"] * 150})
    assert batch.column("text").nbytes > 2 << 20
    model = {"languages": ["x", "y"], "log_prob": np.log(np.full((2, 512), 1 / 512)), "log_prior": np.zeros(2), "n_buckets": 512}
    for run in (language_id._score(SimpleNamespace(value=model), []), language_id._count_grams(512)):
        assert sum(len(b) for b in run(iter([batch.slice(0, 2)])))  # what stays for good
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 80 << 20


def test_candidates_are_the_rarest_shared_blocks(spark, capsys):
    """Per document and band, all but the spared number of blocks that others
    have too, rarest first; sorted by Spark, not gathered in lists on the heap."""
    draw, texts = random.Random(3), _texts(12, 60)
    texts += [" ".join(w if draw.random() > 0.02 else "other" for w in t.split()) for t in texts for _ in range(3)]
    texts += ["", "a b", "a b", texts[0]]
    sets = shingle_sets(*utf8(pa.array(texts)), ngram_join.WIDTH)
    rows = [(i, tag, k) for i, s in enumerate(sets) for tag, keys in ngram_join._blocks(ngram_join.THRESHOLD)(s) for k in keys.tolist()]
    n = Counter(k for _, _, k in rows)
    want = Counter()
    for place in {(i, tag) for i, tag, _ in rows}:
        held = sorted((n[k], k) for i, tag, k in rows if (i, tag) == place and n[k] > 1)
        want.update((place[0], k) for _, k in held[: max(0, len(held) - (place[1] >> 6))])
    ship(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    found = ngram_join._candidates(spark.createDataFrame(list(enumerate(texts)), schema), ngram_join.WIDTH, ngram_join.THRESHOLD)
    assert want and Counter((r.doc_id, r.key) for r in found.collect()) == want
    found.explain()
    assert "collect_list" not in capsys.readouterr().out
