"""Merge-dropout draws: per occurrence, document, copy and candidate."""

import random
from array import array

import numpy as np
import public_tokenizers
import sentencepiece

from incidentlake.llm import piece_codec
from incidentlake.llm._text import mix
from incidentlake.llm.piece_codec import Encoder, draws

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WORD = "internationalization"


def cuts(encoder, text, key, copy=0):
    """The texts of the pieces, word by word."""
    pieces = [encoder.model.output[i].decode() for i in array("i", encoder.encode(text, key, copy))]
    return "|".join(pieces).split("| ")


def test_each_occurrence_document_and_copy_is_drawn_anew():
    encoder = Encoder(PIECES, 0.1)
    text = " ".join([WORD] * 400)
    one = cuts(encoder, text, "1")
    assert len(set(one)) > 20
    assert one == cuts(Encoder(PIECES, 0.1, limit=3), text, "1")
    assert cuts(encoder, text, "2") != one != cuts(encoder, text, "1", copy=1)


def test_results_do_not_depend_on_what_is_kept(monkeypatch):
    rng = random.Random(31)
    words = ["a", "the", "station", "antidisestablishmentarianism", "x,y,z", "漢字漢字", "ab" * 90, "▁", "", "hello,world", "naïveté" * 4]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    kept = Encoder(PIECES, 0.2).encode_many(texts, [str(k) for k in range(60)], [0] * 60)
    monkeypatch.setattr(piece_codec, "LONG", 0)
    monkeypatch.setattr(piece_codec, "SHORT", 0)
    monkeypatch.setattr(piece_codec, "SLICE_WORDS", 7)
    anew = Encoder(PIECES, 0.2, limit=1)
    assert kept == [anew.encode(t, str(k)) for k, t in enumerate(texts)]
    assert all(anew.decode(list(array("i", x))) == t for x, t in zip(kept, texts, strict=True))


def test_pipeline_copies_differ(spark):
    import corpus_pipeline

    text = " ".join([WORD, "representation", "standardization"] * 40)
    docs = spark.createDataFrame([(7, text), (7, text), (8, text), (None, text)], "doc_id bigint, text string").repartition(3)
    got = corpus_pipeline.piece_codec(spark, docs, "").collect()
    assert len({tuple(r.pieces) for r in got}) == 4 and all(r.lossless for r in got)
    again = corpus_pipeline.piece_codec(spark, docs.repartition(2), "").collect()
    assert sorted(r.pieces for r in got) == sorted(r.pieces for r in again)


def test_draws_are_independent_by_candidate():
    keys = np.random.default_rng(1).integers(0, 2**64, 20000, dtype=np.uint64)
    hit = np.stack([draws(keys, np.full(len(keys), k)) < round(0.1 * 2**32) for k in range(24)])
    assert (abs(hit.mean(axis=1) - 0.1) < 0.012).all()
    assert abs(np.corrcoef(hit) - np.eye(24)).max() < 0.035


def test_skip_rate_is_the_same_for_early_and_late_candidates():
    """Also where all candidates are at one place: there each merge of a long
    chain has a draw of its own, whatever its piece's id."""
    encoder = Encoder(PIECES, 0.1)
    kept = encoder.kept
    for word in (WORD, "representation"):
        (root,) = kept.of_word(word)
        keys = np.random.default_rng(2).integers(0, 2**64, 20000, dtype=np.uint64)
        node, _ = kept.resolve(np.full(len(keys), root), keys, encoder.below)
        skips = [kept.skips[n] for n in node.tolist()]
        taken = [kept.left[n] + (s[-1] + 1 if s else 0) for n, s in zip(node.tolist(), skips, strict=True)]
        plain = kept.left[root]
        assert plain >= 7
        for number in range(plain):
            reached = [number in s for s, n in zip(skips, taken, strict=True) if n > number]
            assert len(reached) > 4000 and abs(np.mean(reached) - 0.1) < 0.02
        assert abs(np.mean([not s for s in skips]) - 0.9**plain) < 0.02


def naive_model():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = [i for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
    score = {library.id_to_piece(i): library.get_score(i) for i in ids}
    return library, score, {a + b for p in score for a, b in zip(p, p[1:], strict=False)}


def naive_pieces(model, text, seed, rate):
    """The agenda as it is defined, one candidate after the other, for texts
    without literal space marks."""
    library, score, near = model
    marked = "▁" + text.replace(" ", "▁") if text else ""
    cut = [i for i in range(len(marked)) if i == 0 or marked[i - 1 : i + 1] not in near or (marked[i] == "▁" != marked[i - 1])]
    out = []
    for place, (a, b) in enumerate(zip(cut, [*cut, len(marked)][1:], strict=True)):
        part = mix(np.array([seed + np.uint64(place + 1) * piece_codec._PLACE]))
        ends, closed, number = list(range(a, b + 1)), set(), 0
        while True:
            open_ = [(-score[marked[x:z]], x, y, z) for x, y, z in zip(ends, ends[1:], ends[2:], strict=False) if marked[x:z] in score and (x, y, z) not in closed]
            if not open_:
                break
            _, x, y, z = min(open_)
            if draws(part, np.array([number]))[0] < round(rate * 2**32):
                closed.add((x, y, z))
            else:
                ends.remove(y)
            number += 1
        for s in (marked[x:y] for x, y in zip(ends, ends[1:], strict=False)):
            out += [library.piece_to_id(s)] if s in score else [library.piece_to_id(f"<0x{c:02X}>") for c in s.encode()]
    return out


def test_pieces_are_those_of_the_agenda_with_these_draws():
    rng, model = random.Random(8), naive_model()
    parts = ["the", "station", WORD, " ", "  ", "\n", "x,y,z", "漢字", "😀", "naïve", "ab" * 25, "a" * 70, "http://"]
    for rate in (0.0, 0.1, 0.5, 0.9):
        texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(12)]
        encoder = Encoder(PIECES, rate)
        made = encoder.encode_many(texts, [str(k) for k in range(12)], [0] * 12)
        for k, (text, x) in enumerate(zip(texts, made, strict=True)):
            with np.errstate(over="ignore"):
                assert list(array("i", x)) == naive_pieces(model, text, encoder.document_key(str(k)), rate), (rate, text)


def test_a_set_of_skips_is_segmented_at_once():
    """Not one skip after the other, each with a segmentation of its own."""
    encoder, done = Encoder(PIECES, 0.4), []
    segment = encoder.model.agenda.segment
    encoder.model.agenda.segment = lambda *args: done.append(len(args[1])) or segment(*args)
    text = " ".join([WORD] * 300)
    assert len(set(cuts(encoder, text, "1"))) > 100
    assert sum(done) < 2 * 300


def test_check_compares_whole_texts(monkeypatch):
    model, texts = Encoder(PIECES).model, ["", "naïve 漢字 😀", "", " a  b\n", "x" * 500]
    monkeypatch.setattr(piece_codec, "SLICE_PIECES", 3)
    ids = [array("i", x) for x in Encoder(PIECES, 0.3).encode_many(texts, ["1"] * 5, [0] * 5)]
    sizes = np.array([len(x) for x in ids])
    flat = np.concatenate([np.array(x, np.int32) for x in ids])
    assert model.texts(flat, sizes) == [t.encode() for t in texts]
    flat[-1] = model.byte_id[0]
    assert model.texts(flat, sizes)[:-1] == [t.encode() for t in texts[:-1]]
    assert model.texts(flat, sizes)[-1] != texts[-1].encode()


def test_batches_of_long_texts(spark):
    """More than one batch of characters in a batch of rows."""
    texts = ["ab c\n" * 120000, None, "", "x, y " * 150000, "é" * 400000, "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in piece_codec.encode_and_check(docs, PIECES).collect()}
    encoder = Encoder(PIECES)
    for k, text in enumerate(texts):
        assert got[k].lossless is (None if text is None else True)
        assert got[k].pieces == (None if text is None else list(array("i", encoder.encode(text, str(k)))))
