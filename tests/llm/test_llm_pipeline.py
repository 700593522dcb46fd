"""Every stage of the pipeline against brute force on its own input."""

from collections import Counter

import corpus_pipeline

from incidentlake.llm.line_dedup import PASSAGE_WORDS

from tests.llm import brute
from tests.llm.test_line_passages import repeated_lines, worded

SF = "/root/testdata/sf0.001"


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "src1", 0), (9002, "12 34 !", None, None, 7), (9003, "", "de", "src2", 0)], docs.schema)
    docs = docs.unionByName(odd)
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "mixing", "piece_codec"]
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        after = sorted(docs.collect(), key=lambda r: r.doc_id)
        if name != "piece_codec":
            assert docs.columns == columns
        if name == "language_id":
            assert [r.doc_id for r in before if r.doc_id not in {x.doc_id for x in after}] == [9001, 9002, 9003]
        if name == "line_dedup":
            gone = brute.chunk_lines([(r.doc_id, r.text) for r in before])
            for i, lines in repeated_lines({r.doc_id: r.text for r in before}, PASSAGE_WORDS).items():
                gone[i] |= lines
            left = {r.doc_id: [x for k, x, _ in worded(r.text) if k not in gone[r.doc_id]] for r in before}
            assert any(len(gone[r.doc_id]) for r in before)
            want = [(r.doc_id, left[r.doc_id]) for r in before if left[r.doc_id] or not gone[r.doc_id]]
            assert [(r.doc_id, [x for _, x, _ in worded(r.text)]) for r in after] == want
            assert all(r.text == b.text for b in before if not gone[b.doc_id] for r in after if r.doc_id == b.doc_id)
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "ngram_join":
            part = brute.jaccard_groups({r.doc_id: r.text for r in before})
            assert [r.doc_id for r in after] == [r.doc_id for r in before if part[r.doc_id][1] == r.doc_id]
            assert len(after) < len(before)
        if name == "mixing":
            sized = [(r.doc_id, r.source, len(brute.WORD.findall(r.text))) for r in before]
            _, taken = brute.mix(sized)
            copies = Counter(r.doc_id for r in after)
            assert {i: copies[i] * n for i, _, n in sized} == {i: t for (i, _, _), t in zip(sized, taken, strict=True)}
        if name == "piece_codec":
            assert len(after) == len(before) and all(r.lossless for r in after)


def test_run_on_an_empty_table(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{scratch}/documents.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
