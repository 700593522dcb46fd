"""SentencePiece encoding and decoding with seeded merge-dropout.

The model's BPE pieces are merged by an agenda: the adjacent pair whose joined
piece scores highest (leftmost among equals) is merged first. With dropout, each
candidate taken from the agenda is skipped if its own draw falls below the dropout
rate. The draw is a keyed hash of (seed, document id, copy, place of the word,
number of the candidate), so every occurrence is segmented anew, repeated rows too
if they are numbered, and all is the same on every rerun and every machine. With a
rate of 0 the result is the model's own encoding.

No piece goes on after a space mark that follows other characters, so a word
with the spaces before it is segmented by itself. Nor can a merge join two
characters that are neighbours in no piece of the model (a letter and a comma,
mostly), so words are cut there too. What is kept, in bounded arrays per Python
worker, does not depend on the draws: a part's segmentation for each set of
skipped candidates met so far, and how many candidates it takes from the agenda.
Draws are made for many words at once, and each set of skips is segmented at
once, many sets together. Characters outside the vocabulary become byte pieces. Decoding joins the
pieces' bytes and drops the one leading space that encoding put in front; it
gives back every text exactly. A literal space mark (U+2581) in a text is encoded
as its three bytes, since it could not be told from a space otherwise.

Defined results: null text has null pieces and decodes to null; the empty text
has none and decodes to the empty text; a null id counts as the empty string;
repeated rows give repeated results unless ``copy`` numbers them; extra columns
are kept, clashing ones replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Container, Iterable, Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._agenda import Agenda, Pairs, ranges
from incidentlake.llm._ship import ship
from incidentlake.llm._text import mix

DROPOUT = 0.1
SEED = "dropout-1"
CACHE_ENTRIES = 120_000  # segmentations kept by a task; beyond that it starts anew
SLICE_WORDS = 1 << 16  # words whose draws are made at once
SLICE_PIECES = 1 << 18  # pieces that are decoded at once
SHORT = 40  # characters that are merged by a list instead of a heap
LONG = 48  # candidates; parts with more are segmented anew each time
BATCH_CHARS = 1 << 20
SPACE_MARK = "▁"


class PieceModel:
    """Pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, tuple[int, int]] = {}
        self.byte_id = [0] * 256
        self.output: list[bytes] = []
        scored = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.output.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.output.append(b"")
            else:
                scored.append((-model.get_score(i), i, piece))
                self.output.append(piece.replace(SPACE_MARK, " ").encode("utf-8"))
        level, last = -1, None
        for score, i, piece in sorted(scored):  # equal scores share a rank
            if score != last:
                level, last = level + 1, score
            self.rank[piece] = (level, i)
        self.level = {piece: rank for piece, (rank, _) in self.rank.items()}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.rank):
            raise ValueError("a piece spans words; texts cannot be cut at spaces")
        self.agenda = Agenda(self.rank)
        symbol = self.agenda.symbol
        near = sorted({(symbol[a], symbol[b]) for piece in self.rank for a, b in zip(piece, piece[1:], strict=False)})
        self.neighbours = Pairs(*np.array(near, np.int32).reshape(-1, 2).T, len(symbol))
        self.mark_ids = [self.byte_id[b] for b in SPACE_MARK.encode()]
        self.output_bytes = np.frombuffer(b"".join(self.output), np.uint8)
        self.output_size = np.fromiter(map(len, self.output), np.int64, len(self.output))
        self.output_start = np.cumsum(self.output_size) - self.output_size

    def parts_of_all(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The words cut between characters that no merge can join, and how many
        parts each has."""
        text = "".join(words)
        symbol = self.agenda.char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        first = np.ones(len(symbol), bool)
        first[1:] = self.neighbours.find(symbol[:-1], symbol[1:]) == self.neighbours.none
        begin = np.cumsum([0, *map(len, words)])
        first[begin[:-1][begin[:-1] < len(symbol)]] = True
        cut = np.append(np.flatnonzero(first), len(symbol))
        at = cut.tolist()
        return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], np.diff(np.searchsorted(cut, begin))

    def segment_all(self, code: np.ndarray, start: np.ndarray, size: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, ...]:
        """``Agenda.segment``; parts with characters that are in no piece, and long
        ones, are done one by one."""
        ids, at, count, taken = self.agenda.segment(code, start, np.where(size > SHORT, 0, size), masks)
        every, before = [ids], len(ids)
        for k in np.flatnonzero((size > SHORT) | (taken < 0)).tolist():
            mask = int(masks[k])
            own, taken[k] = self.segment(code[start[k] : start[k] + size[k]].tobytes().decode("utf-32-le"), {d for d in range(mask.bit_length()) if mask >> d & 1})
            at[k], count[k] = before, len(own)
            every.append(np.frombuffer(own, np.int32) if own else ids[:0])
            before += len(own)
        return np.concatenate(every), at, count, taken

    def texts(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """What the pieces of each row stand for, in UTF-8."""
        size = self.output_size[ids]
        slices = [slice(a, a + SLICE_PIECES) for a in range(0, len(ids), SLICE_PIECES)]
        whole = b"".join(self.output_bytes[ranges(self.output_start[ids[x]], size[x])].tobytes() for x in slices)
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(sizes))].tolist()
        return [whole[a + 1 : b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def segment(self, word: str, skipped: Container[int] = ()) -> tuple[array, int]:
        """Piece ids of one word (space marks included), as 32-bit integers, if
        the candidates with the numbers ``skipped`` are; and how many were taken."""
        symbols, taken = self._merge_short(word, skipped) if len(word) <= SHORT else self._merge_long(word, skipped)
        ids = array("i")
        for s in symbols:
            found = self.rank.get(s)
            if found:
                ids.append(found[1])
            else:
                ids.extend([self.byte_id[b] for b in s.encode("utf-8")])
        return ids, taken

    def _merge_short(self, word: str, skipped: Container[int]) -> tuple[list[str], int]:
        """The agenda as a list of the neighbours' ranks: quicker for few."""
        rank, none = self.level.get, len(self.level)
        symbol, taken = list(word), 0
        open_ = [rank(word[i : i + 2], none) for i in range(len(word) - 1)]
        while open_:
            best = min(open_)
            if best == none:
                break
            i = open_.index(best)
            taken += 1
            if taken - 1 in skipped:
                open_[i] = none
                continue
            a = symbol[i] = symbol[i] + symbol.pop(i + 1)
            del open_[i]
            if i < len(open_):
                open_[i] = rank(a + symbol[i + 1], none)
            if i:
                open_[i - 1] = rank(symbol[i - 1] + a, none)
        return symbol, taken

    def _merge_long(self, word: str, skipped: Container[int]) -> tuple[list[str], int]:
        rank = self.rank
        symbol: list[str | None] = list(word)
        n, taken = len(symbol), 0
        agenda = []
        for i in range(n - 1):
            found = rank.get(symbol[i] + symbol[i + 1])
            if found:
                agenda.append((found[0], i, len(symbol[i]) + len(symbol[i + 1]), found[1]))
        if agenda:
            heapify(agenda)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while agenda:
                _, i, size, _ = heappop(agenda)
                a = symbol[i]
                j = after[i]
                if a is None or j >= n or len(a) + len(symbol[j]) != size:
                    continue  # one of the two was merged meanwhile
                taken += 1
                if taken - 1 in skipped:
                    continue
                a = symbol[i] = a + symbol[j]
                symbol[j] = None
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    found = rank.get(a + symbol[k])
                    if found:
                        heappush(agenda, (found[0], i, size + len(symbol[k]), found[1]))
                h = before[i]
                if h >= 0:
                    found = rank.get(symbol[h] + a)
                    if found:
                        heappush(agenda, (found[0], h, size + len(symbol[h]), found[1]))
        return [s for s in symbol if s is not None], taken


_U = np.uint64
_PLACE, _CANDIDATE = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)


def draws(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """32-bit draws of the candidates with these numbers, each of an occurrence
    with its key."""
    return mix(keys + (numbers.astype(_U) + _U(1)) * _CANDIDATE) >> _U(32)


def _view(values: array) -> np.ndarray:
    """``values`` in place; to be dropped before they grow."""
    return np.frombuffer(values, values.typecode)


class _Numbers(dict):
    """Numbers its keys as they are met, from ``next`` on; ``new`` lists them."""

    def __init__(self):
        self.next, self.new = 0, []

    def __missing__(self, key) -> int:
        number = self[key] = self.next
        self.next += 1
        self.new.append(key)
        return number


class _OfNode:
    def __init__(self, function: Callable):
        self.function = function

    def __getitem__(self, node: int):
        return self.function(node)


class Segmentations:
    """Segmentations of parts of words. A node is a part and the candidates that
    it skips; a root skips none."""

    def __init__(self, model: PieceModel, limit: int):
        self.model, self.limit = model, limit
        self.skips = _OfNode(lambda node: tuple([d for d in range(self.masks[node].bit_length()) if self.masks[node] >> d & 1]))
        self.left = _OfNode(lambda node: self.taken[node] - self.masks[node].bit_length())  # after the last skip
        self.clear()

    def clear(self) -> None:
        self.words, self.roots, self.nodes = _Numbers(), _Numbers(), _Numbers()
        self.first, self.parts = array("q", [0]), array("i")  # the roots of a word are parts[first[k] : first[k + 1]]
        self.code = array("i")  # code points of the roots
        self.start, self.size = array("q"), array("i")  # of the node's part in ``code``
        self.ids = array("i")
        self.at, self.count = array("q"), array("i")  # of the node's pieces in ``ids``
        self.taken = array("i")  # candidates
        self.masks = array("Q")  # of the candidates skipped
        # the word None and the node 0 are the literal space mark
        self.words[None], self.words.next = 0, 1
        self.first.append(1)
        self.parts.append(self._one(self.model.mark_ids))

    def full(self) -> bool:
        return len(self.taken) + len(self.words) > self.limit or len(self.code) + len(self.ids) > 32 * self.limit

    def _one(self, ids: Iterable[int]) -> int:
        """A node of its own with these pieces."""
        self.at.append(len(self.ids))
        self.ids.extend(ids)
        self.count.append(len(self.ids) - self.at[-1])
        for x in (self.start, self.size, self.taken, self.masks):
            x.append(0)
        return len(self.taken) - 1

    def _add(self, start: np.ndarray, size: np.ndarray, masks: np.ndarray) -> None:
        """New nodes, one for each of these parts of ``code`` with its skips."""
        ids, at, count, taken = self.model.segment_all(_view(self.code), start, size, masks)
        at += len(self.ids)
        masks &= (_U(1) << np.minimum(taken, 63).astype(_U)) - _U(1) | np.where(taken > 63, ~_U(0), _U(0))
        for kept, new in ((self.start, start), (self.size, size), (self.masks, masks), (self.ids, ids), (self.at, at), (self.count, count), (self.taken, taken)):
            kept.frombytes(new.astype(kept.typecode).tobytes())

    def learn(self) -> None:
        """Roots of the parts of new words without their one leading space mark,
        or of units as they are, given as tuples."""
        words, self.words.new = self.words.new, []
        if not words:
            return
        parts, counts = self.model.parts_of_all([SPACE_MARK + w if isinstance(w, str) else w[0] for w in words])
        self.first.frombytes((self.first[-1] + np.cumsum(counts)).tobytes())
        self.roots.next = len(self.taken)
        self.parts.extend(map(self.roots.__getitem__, parts))
        new, self.roots.new = self.roots.new, []
        size = np.fromiter(map(len, new), np.int64, len(new))
        start = len(self.code) + np.cumsum(size) - size
        self.code.frombytes("".join(new).encode("utf-32-le"))
        if new:
            self._add(start, size, np.zeros(len(new), _U))

    def of_word(self, word: str | tuple[str]) -> tuple[int, ...]:
        """Roots of the parts of one word."""
        number = self.words[word]
        self.learn()
        return tuple(self.parts[self.first[number] : self.first[number + 1]])

    def of_words(self, words: Iterable[str | tuple[str] | None]) -> tuple[np.ndarray, np.ndarray]:
        """Roots of the parts of all words, and how many each has."""
        number = np.fromiter(map(self.words.__getitem__, words), np.int64)
        self.learn()
        first = _view(self.first)
        size = first[number + 1] - first[number]
        return _view(self.parts)[ranges(first[number], size)], size

    def pieces(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of all nodes, and how many each has."""
        count = _view(self.count)[node]
        return _view(self.ids)[ranges(_view(self.at)[node], count)], count

    def skip(self, roots: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """The nodes of these roots that skip these candidates."""
        order = np.lexsort((masks, roots))
        root, mask = roots[order], masks[order]
        first = np.append(True, (root[1:] != root[:-1]) | (mask[1:] != mask[:-1]))
        self.nodes.next = len(self.taken)
        found = [self.nodes[r << 64 | m] for r, m in zip(root[first].tolist(), mask[first].tolist(), strict=True)]
        new, self.nodes.new = self.nodes.new, []
        if new:
            above = np.array([k >> 64 for k in new])
            self._add(_view(self.start)[above], _view(self.size)[above], np.array([k & 0xFFFFFFFFFFFFFFFF for k in new], _U))
        out = np.empty(len(roots), np.int64)
        out[order] = np.array(found)[np.cumsum(first) - 1]
        return out

    def _anew(self, root: int, key: np.uint64, below: int) -> int:
        """A node for one occurrence of a part with many candidates."""
        start, size = self.start[root], self.size[root]
        skipped = np.flatnonzero(draws(key, np.arange(3 * size)) < below)  # less than three candidates a character
        return self._one(self.model.segment(self.code[start : start + size].tobytes().decode("utf-32-le"), set(skipped.tolist()))[0])

    def resolve(self, roots: np.ndarray, keys: np.ndarray, below: int) -> tuple[np.ndarray, int]:
        """The node that each occurrence's draws lead to, and how many occurrences
        were segmented anew. The candidates that a root takes are drawn; if the
        skips make it take more, those are drawn too, and so on."""
        node, taken, anew = roots.copy(), _view(self.taken)[roots], 0
        open_ = np.flatnonzero(taken) if below else roots[:0]
        mask, drawn, taken = np.zeros(len(open_), _U), np.zeros(len(open_), np.int64), taken[open_]
        most = LONG
        while len(open_):
            far = taken > most
            for k in open_[far].tolist():
                node[k] = self._anew(int(roots[k]), keys[k], below)
                anew += 1
            going = (taken > drawn) & ~far
            open_, mask, drawn, taken = open_[going], mask[going], drawn[going], taken[going]
            size = taken - drawn
            number = ranges(drawn, size)
            hit = np.flatnonzero(draws(np.repeat(keys[open_], size), number) < below)
            which, at = np.unique(np.searchsorted(np.cumsum(size), hit, side="right"), return_index=True)
            open_, drawn = open_[which], taken[which]
            if len(open_):
                mask = mask[which] | np.bitwise_or.reduceat(_U(1) << number[hit].astype(_U), at)
                node[open_] = self.skip(roots[open_], mask)
            taken, most = _view(self.taken)[node[open_]], 64
        return node, anew


class Encoder:
    _units = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+")

    def __init__(self, path: str, rate: float = DROPOUT, seed: str = SEED, limit: int = CACHE_ENTRIES):
        self.model, self.seed = PieceModel(path), seed.encode("utf-8")[:64]
        self.below = round(rate * 2**32)
        self.kept = Segmentations(self.model, limit)

    def document_key(self, key: str, copy: int = 0) -> np.uint64:
        digest = blake2b(key.encode("utf-8"), key=self.seed, salt=copy.to_bytes(8, "little"), digest_size=8).digest()
        return _U(int.from_bytes(digest, "little"))

    def words(self, text: str) -> list[str | tuple[str] | None]:
        """What is segmented by itself; None is a literal space mark."""
        if not text:
            return []
        if SPACE_MARK not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        out, lead = [], SPACE_MARK
        for k, stretch in enumerate(text.split(SPACE_MARK)):
            if k:
                out.append(None)
            for unit in self._units.findall(lead + stretch.replace(" ", SPACE_MARK)):
                out.append(unit[1:] if unit[0] == SPACE_MARK else (unit,))
            lead = ""
        return out

    def encode_all(self, texts: list[str | None], keys: list[str], copies: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of all texts, and how many each has."""
        ids, total = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        place = [0] * len(texts)  # parts before
        waiting: list[tuple[int, np.uint64, list]] = []  # row, key, words

        def flush() -> None:
            nodes, parts = self.kept.of_words(chain.from_iterable(x[2] for x in waiting))
            ends = np.cumsum([0, *(len(x[2]) for x in waiting)])
            ends = np.append(0, np.cumsum(parts))[ends]
            sizes = np.diff(ends)
            rows = [x[0] for x in waiting]
            first = []
            for row, n in zip(rows, sizes.tolist(), strict=True):
                first.append(place[row])
                place[row] += n
            seeds = np.repeat(np.array([x[1] for x in waiting], _U), sizes)
            places = ranges(np.array(first), sizes).astype(_U)
            found, _ = self.kept.resolve(nodes.astype(np.int64), mix(seeds + (places + _U(1)) * _PLACE), self.below)
            made, count = self.kept.pieces(found)
            ids.append(made)
            np.add.at(total, rows, np.diff(np.append(0, np.cumsum(count))[ends]))
            waiting.clear()
            if self.kept.full():
                self.kept.clear()

        held = 0
        for row, text in enumerate(texts):
            words, key = self.words(text or ""), self.document_key(keys[row], copies[row])
            for a in range(0, len(words), SLICE_WORDS):
                part = words[a : a + SLICE_WORDS]
                waiting.append((row, key, part))
                held += len(part)
                if held >= SLICE_WORDS:
                    flush()
                    held = 0
        if waiting:
            flush()
        return np.concatenate(ids), total

    def encode_many(self, texts: list[str | None], keys: list[str], copies: list[int]) -> list[bytes | None]:
        ids, sizes = self.encode_all(texts, keys, copies)
        ends = np.cumsum(sizes).tolist()
        return [None if t is None else ids[a:b].tobytes() for t, a, b in zip(texts, [0, *ends], ends, strict=False)]

    def encode(self, text: str, key: str = "", copy: int = 0) -> bytes:
        return self.encode_many([text], [key], [copy])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.model.output.__getitem__, ids))[1:].decode("utf-8") if ids else ""


_encoders: dict[tuple, Encoder] = {}


def _encoder(path: str, rate: float, seed: str) -> Encoder:
    """The encoder of this Python worker: its dictionaries serve all its tasks."""
    key = (path, rate, seed)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path, rate, seed)
    return _encoders[key]


def _lists(ids: np.ndarray, sizes: np.ndarray, texts: list[str | None]) -> pa.Array:
    """An Arrow list column from the ids of all rows; null for a null text."""
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(ids), mask=pa.array([t is None for t in texts]))


def encode(docs: DataFrame, model: str, rate: float = DROPOUT, seed: str = SEED, text: str = "text", key: str = "doc_id", copy: str | None = None, keep_text: bool = False, check: bool = False) -> DataFrame:
    """``docs`` with ``pieces`` (ids). ``model`` is the path of a SentencePiece
    BPE model, present on every executor. The text goes unless ``keep_text``.
    ``copy`` is a column with numbers that tell rows with one id and text apart.
    ``check`` decodes the pieces again and adds ``lossless``: whether they give
    the text back (null for a null text)."""
    ship(docs.sparkSession)
    new = ("pieces", "lossless") if check else ("pieces",)
    names = [c for c in docs.columns if c.lower() not in new and c != copy and (keep_text or c != text)]
    number = F.lit(0).cast("long") if copy is None else F.coalesce(F.col(f"`{copy}`").cast("long"), F.lit(0))
    rows = docs.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text}`").alias("__text"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("__key"), number.alias("__copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, rate, seed)
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column("__text")).fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(batch):
                base = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, base + BATCH_CHARS, side="right")))
                done = batch.slice(start, end - start)
                start = end
                texts = done.column("__text").to_pylist()
                ids, counts = encoder.encode_all(texts, done.column("__key").to_pylist(), done.column("__copy").to_pylist())
                made = [_lists(ids, counts, texts)]
                if check:
                    same = [None if t is None else t.encode("utf-8") == x for t, x in zip(texts, encoder.model.texts(ids, counts), strict=True)]
                    made.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(done.column(x) for x in names), *made], names=[*names, *new])
        encoder.kept.clear()  # the worker may serve another stage next

    added = [T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())][: len(new)]
    return rows.mapInArrow(run, T.StructType([*(f for f in rows.schema if f.name in names), *added]))


def decode(encoded: DataFrame, model: str, pieces: str = "pieces", text: str = "text") -> DataFrame:
    """``encoded`` with the text that its pieces stand for."""
    ship(encoded.sparkSession)
    names = [c for c in encoded.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        output = PieceModel(model).output
        for batch in batches:
            column = batch.column(pieces)
            texts = []
            for i in range(len(batch)):
                ids = column[i]
                whole = b"".join(map(output.__getitem__, ids.values.to_numpy().tolist())) if ids.is_valid else None
                texts.append(None if whole is None else whole[1:].decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(texts, pa.string())], names=[*names, text])

    schema = T.StructType([*(f for f in encoded.schema if f.name in names), T.StructField(text, T.StringType())])
    return encoded.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, schema)


def encode_and_check(docs: DataFrame, model: str, **options) -> DataFrame:
    """``docs`` without the text, with ``pieces``, ``lossless`` and ``n_pieces``."""
    coded = encode(docs.drop("n_pieces"), model, check=True, **options)
    return coded.withColumn("n_pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long"))
