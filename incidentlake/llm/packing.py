"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of documents (``token_pieces``) are put whole into as few sequences of at
most ``capacity`` tokens as can be found (``pack``). A piece as long as a sequence
is one. The others are dealt by hash to blocks of about ``BLOCK`` pieces, and a
block is one packing problem, held as lengths alone. Its chromosomes are groupings:
the bin of every piece. Each block is solved on a few islands, each a task row of
its own with a population and random numbers of its own. Crossover injects whole
well-filled bins of one parent into the other, whose bins that hold any of the
same pieces are dissolved (so no piece is there twice), and the displaced pieces
go back by best fit, longest first. Mutation dissolves the emptiest bins and a
few others. After every epoch each island sends its elite to the next one, by a
join on (block, island). A block that reaches the lower bound (tokens over
capacity, or pieces longer than half of it) is done and drops out.

Blocks end with a badly filled bin or two each. So the pieces of all bins below
``GOOD_FILL`` are dealt anew to fewer blocks and packed again, level by level,
as long as that saves bins (``WORTH``). No piece is left out at any point; memory follows
the block, and every level and epoch is a table in the shared folder.

Defined results: a null or empty text is one piece of the end id alone; repeated
rows are pieces of their own; pieces longer than a sequence have one of their
own; pieces of null length or less than 1 get no sequence (null); an empty table
gives an empty result; all other columns are kept, but for columns of the names
of the results, which are replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._columns import free_name, whole
from incidentlake.llm._ship import ship
from incidentlake.llm._stored import stored
from incidentlake.llm._text import ASCII_LOWER, slices, utf8, word_bounds
from incidentlake.llm.token_counts import byte_symbols

CAPACITY = 2048
END_ID = 0
BLOCK = 4096
ISLANDS, POPULATION, EPOCHS, GENERATIONS = 3, 5, 3, 24
GOOD_FILL = 0.98
WORTH = 0.001  # a level that saves a smaller share of its bins is the last
CACHE_WORDS, CACHE_IDS = 400_000, 4_000_000  # tokens that a worker keeps, and their ids


def _classes() -> np.ndarray:
    """Class of each byte: 0 letter, 1 digit, 2 other printable, 3 not plain."""
    out = np.full(256, _ODD, np.uint8)
    out[0x21:0x7F] = 2
    out[0x30:0x3A] = _DIGIT
    for first, last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF), (0xC3, 0xC9)):
        out[first : last + 1] = 0  # two-byte characters from U+00C0 to U+027F are letters, but for three
    out[0x27] = _ODD
    return out


_DIGIT, _ODD = 1, 3
_CLASS = _classes()
_PLAIN = re.compile(rb"(?:[a-z]|(?!\xc3\x97|\xc3\xb7|\xc4\xb0)[\xc3-\xc9][\x80-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class WordIds:
    """Ids of words by the library, kept by pre-token. The vocabulary's normaliser
    and pre-tokeniser never look across white space, so a text's ids are those of
    its words, one after the other. Words of plain characters are cut further, as
    the pre-tokeniser cuts them: runs of letters, single digits and runs of other
    signs. Words with an apostrophe, a special string's beginning or any other
    character go to the library as they are."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.symbols = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _plain_ids(self, token: bytes) -> list[int]:
        lowered = token.decode().lower().encode()
        return [t.id for t in self.library.model.tokenize(lowered.decode("latin-1").translate(self.symbols))]

    def _learn(self, tokens: list[bytes]) -> None:
        plain = [_PLAIN.fullmatch(t) is not None for t in tokens]
        others = iter(self.library.encode_batch_fast([t.decode() for t, p in zip(tokens, plain, strict=True) if not p], add_special_tokens=False))
        found = [self._plain_ids(t) if p else next(others).ids for t, p in zip(tokens, plain, strict=True)]
        self.slot.update(zip(tokens, range(len(self.slot), len(self.slot) + len(tokens)), strict=True))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    @staticmethod
    def _cut(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts without white space, the starts of the tokens in them, and
        the number of tokens before each text and in all."""
        starts, ends, row = word_bounds(raw, bounds)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[starts] += 1  # a word may begin where the last one of the row before ends
        inside[ends] -= 1
        packed = raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        word = np.concatenate([[0], np.cumsum(ends - starts)])
        if not len(packed):
            return packed, word[:-1], row
        kind = _CLASS[packed]
        pair = packed[:-1].astype(np.uint16) << 8 | packed[1:]
        odd = kind == _ODD
        odd[:-1] |= np.isin(pair, (0xC397, 0xC3B7, 0xC4B0, 0x3C7C))  # no letters; a lower case of two characters; a special string
        plain = ~np.logical_or.reduceat(odd, word[:-1])
        each = np.repeat(plain, np.diff(word))
        packed = np.where(each, ASCII_LOWER[packed], packed)
        first = np.zeros(len(packed), bool)
        first[1:] = each[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        first[word[:-1]] = True
        token = np.flatnonzero(first)
        return packed, token, np.searchsorted(token, word[row])

    def __call__(self, raw: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text of a UTF-8 buffer, each followed by ``end``, and
        the bounds of the texts among them. ``bounds`` starts at 0."""
        packed, token, row = self._cut(raw, bounds)
        edges = np.append(token, len(packed)).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(token), [None, pa.py_buffer(edges), pa.py_buffer(packed)]).dictionary_encode()
        distinct = tokens.dictionary.to_pylist()
        if len(self.slot) + len(distinct) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self._forget()
        if new := [w for w in distinct if w not in self.slot]:
            self._learn(new)
        slot = np.array([self.slot[w] for w in distinct], np.int64)[tokens.indices.to_numpy()] if distinct else np.zeros(0, np.int64)
        size = self.begin[slot + 1] - self.begin[slot]
        place = np.concatenate([[0], np.cumsum(size)])
        text = place[row] + np.arange(len(row))  # one end id more for every text before
        out = np.full(text[-1], end, np.uint32)
        shift = np.repeat(np.arange(len(row) - 1), np.diff(place[row]))
        at = np.arange(place[-1])
        out[at + shift] = self.ids[np.repeat(self.begin[slot] - place[:-1], size) + at]
        return out, text


_words: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _words:
        _words.clear()
        _words[path] = WordIds(path)
    return _words[path]


_PIECES = T.ArrayType(T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]))


def _cut(column: pa.Array, words: WordIds, capacity: int, end: int) -> pa.Array:
    raw, bounds = utf8(column)
    texts, piece, start, length, ids = [0], [], [], [], []
    for a, b in slices(bounds):
        found, text = words(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], end)
        for low, high in zip(text[:-1].tolist(), text[1:].tolist(), strict=True):
            for k, x in enumerate(range(low, high, capacity)):
                part = found[x : min(x + capacity, high)]
                piece.append(k), start.append(x - low), length.append(len(part)), ids.append(part.astype("<u4").tobytes())
            texts.append(len(piece))
    flat = pa.StructArray.from_arrays([pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["piece", "start", "length", "ids"])
    return pa.ListArray.from_arrays(pa.array(texts, pa.int32()), flat)


def token_pieces(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """A row for every piece of every text: the other columns of ``docs``,
    ``piece`` (number in its text), ``start`` (ids before it), ``length`` and
    ``ids`` (little-endian 32-bit). A text's ids are the library's, then ``end``.
    ``vocabulary`` is a file of the tokenizer library whose pre-tokens end at
    ASCII white space, present on every executor."""
    ship(docs.sparkSession)
    kept = docs.select(*whole(docs, text, "piece", "start", "length", "ids"))
    pieces = free_name(kept.columns, "pieces")
    names, width = [*kept.columns, pieces], len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], _cut(batch.columns[width], words, capacity, end)], names=names)

    rows = docs.select(*whole(docs, text, "piece", "start", "length", "ids"), F.col(f"`{text}`").alias(pieces))
    cut = rows.mapInArrow(run, T.StructType([*kept.schema, T.StructField(pieces, _PIECES)]))
    return cut.select(*whole(cut, pieces), F.inline(F.col(f"`{pieces}`")))


class _Open:
    """Open bins by room, so that the least sufficient room is found at once."""

    def __init__(self, capacity: int):
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: there is a bin with room r

    def add(self, number: int, room: int) -> None:
        self.bins[room].append(number)
        self.rooms |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """The bin of least room that takes ``size``, and its room."""
        fits = self.rooms >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        number = self.bins[room].pop()
        if not self.bins[room]:
            self.rooms ^= 1 << room
        return number, room


class Grouping:
    """Chromosomes of one block: arrays with the bin of every piece, bins numbered from 0."""

    def __init__(self, length: np.ndarray, capacity: int, rng: np.random.Generator):
        self.length, self.capacity, self.rng = length, capacity, rng
        self.bound = max(-(-int(length.sum()) // capacity), int((2 * length > capacity).sum()))

    def fill(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, weights=self.length).astype(np.int64)

    def cost(self, bins: np.ndarray) -> tuple[int, int]:
        """Fewer bins first, then fuller ones."""
        fill = self.fill(bins)
        return len(fill), -int(np.square(fill).sum())

    def best_fit(self, bins: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Pieces without a bin (-1) put by best fit, in the given order."""
        placed = bins >= 0
        names, bins[placed] = np.unique(bins[placed], return_inverse=True)
        fill = np.bincount(bins[placed], weights=self.length[placed], minlength=len(names)).astype(np.int64)
        space, count = _Open(self.capacity), len(names)
        for number, room in enumerate((self.capacity - fill).tolist()):
            if room:
                space.add(number, room)
        for i, size in zip(order.tolist(), self.length[order].tolist(), strict=True):
            number, room = space.take(size) or (count, self.capacity)
            count += number == count
            bins[i] = number
            if room > size:
                space.add(number, room - size)
        return bins

    def _longest_first(self, pieces: np.ndarray) -> np.ndarray:
        return pieces[np.argsort(-self.length[pieces], kind="stable")]

    def start(self, disturb: float) -> np.ndarray:
        """Best fit, longest first; lengths are disturbed by the given share."""
        key = self.length * (1 + disturb * self.rng.random(len(self.length)))
        return self.best_fit(np.full(len(self.length), -1, np.int64), np.argsort(-key, kind="stable"))

    def cross(self, mother: np.ndarray, father: np.ndarray) -> np.ndarray:
        """``mother`` with some of ``father``'s well-filled bins."""
        fill = self.fill(father)
        ranked = np.argsort(-(fill + self.rng.random(len(fill))), kind="stable")
        share = self.rng.uniform(0.1, 0.5)
        chosen = np.zeros(len(fill), bool)
        chosen[ranked[: max(1, int(share * len(fill)))]] = True
        injected = chosen[father]
        hit = np.zeros(int(mother.max()) + 1, bool)
        hit[mother[injected]] = True
        child = np.where(injected, father + len(hit), np.where(hit[mother], -1, mother))
        return self.best_fit(child, self._longest_first(np.flatnonzero(child < 0)))

    def mutate(self, bins: np.ndarray) -> np.ndarray:
        """The emptiest bins and a few drawn ones dissolved and put back."""
        fill = self.fill(bins)
        gone = np.zeros(len(fill), bool)
        gone[np.argsort(fill, kind="stable")[: 1 + len(fill) // 50]] = True
        gone[self.rng.integers(0, len(fill), 1 + len(fill) // 50)] = True
        child = np.where(gone[bins], -1, bins)
        return self.best_fit(child, self._longest_first(np.flatnonzero(child < 0)))

    def evolve(self, population: list[np.ndarray], size: int, generations: int) -> list[np.ndarray]:
        """The population after some generations, the elite first; ends at the bound."""
        population = list(population)
        while len(population) < size and not (population and self.cost(population[0])[0] <= self.bound):
            population.append(self.start(0.0 if not population else 0.2))
        ranked = sorted(((self.cost(p), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])[:size]
        for number in range(generations):
            if ranked[0][0][0] <= self.bound:
                break
            a, b = (min(self.rng.integers(0, len(ranked), 2).tolist()) for _ in range(2))
            child = self.mutate(self.cross(ranked[a][2], ranked[b][2]) if a != b else ranked[a][2])
            cost = self.cost(child)
            if cost < ranked[-1][0] and cost not in [r[0] for r in ranked]:
                ranked[-1] = (cost, size + number, child)
                ranked.sort(key=lambda x: x[:2])
        return [r[2] for r in ranked]


_STATE = "block bigint, island int, lengths array<int>, bins int, bound int, population array<array<int>>"


def _value(x: pa.Scalar):
    """Arrays of integers as numpy arrays, other values as Python's."""
    if not isinstance(x, pa.ListScalar) or not x.is_valid:
        return x.as_py()
    if pa.types.is_integer(x.type.value_type):
        return x.values.to_numpy().astype(np.int64)
    return [_value(y) for y in x]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: only one block's arrays are unpacked at a time."""
    for i in range(len(batch)):
        yield {name: _value(batch.column(name)[i]) for name in batch.schema.names}


def _island(capacity: int, size: int, generations: int, seed: tuple[int, ...]):
    """An epoch of every island (row): its population, with the migrant if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                rng = np.random.default_rng([*seed, row["block"], row["island"]])
                problem = Grouping(row["lengths"], capacity, rng)
                migrant = [] if row["migrant"] is None else [row["migrant"]]
                ranked = problem.evolve([*(row["population"] or []), *migrant], size, generations)
                out = {"block": row["block"], "island": row["island"], "lengths": row["lengths"], "bins": problem.cost(ranked[0])[0], "bound": problem.bound, "population": ranked}
                yield pa.RecordBatch.from_pylist([out], schema=_STATE_ARROW)

    return run


_STATE_ARROW = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())), ("bins", pa.int32()), ("bound", pa.int32()), ("population", pa.list_(pa.list_(pa.int32())))])


def _solved(members: DataFrame, capacity: int, islands: int, size: int, epochs: int, generations: int, seed: tuple[int, ...]) -> DataFrame:
    """``block`` and the best grouping (``best``: bin of every member) of each block."""
    state, ended = None, []
    for epoch in range(epochs):
        if state is None:
            rows = members.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths", F.lit(None).cast("array<array<int>>").alias("population"), F.lit(None).cast("array<int>").alias("migrant"))
        else:
            going = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("population")[0].alias("migrant"))
            rows = state.select("block", "island", "lengths", "population").join(going, ["block", "island"])
        rows = rows.repartition("block", "island")
        state = stored(rows.mapInArrow(_island(capacity, size, generations, (*seed, epoch)), _STATE), "pack-islands")
        at_bound = state.groupBy("block").agg((F.min("bins") <= F.min("bound")).alias("done"))
        open_blocks = stored(at_bound.where("not done").select("block"), "pack-open")
        last = epoch == epochs - 1 or open_blocks.isEmpty()
        ended.append(state if last else state.join(open_blocks, "block", "left_anti"))
        if last:
            break
        state = state.join(open_blocks, "block", "left_semi")
    every = ended[0]
    for more in ended[1:]:
        every = every.unionByName(more)
    best = F.min_by(F.col("population")[0], F.struct("bins", "island"))
    return every.groupBy("block").agg(best.alias("best"))


def _laid_out(capacity: int):
    """A row per member: its bin, the bin's fill and the tokens before it in the bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                bins, length = row["best"], row["lengths"]
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(length[order]) - length[order]
                offset = np.empty(len(bins), np.int64)
                offset[order] = before - before[np.searchsorted(bins[order], bins[order])]
                fill = np.bincount(bins, weights=length).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row["keys"], length, np.full(len(bins), row["block"], np.int64), bins, fill[bins], offset)], names=["key", "length", "block", "bin", "fill", "offset"])

    return run


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, generations: int = GENERATIONS, seed: int = 11) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (the tokens before the
    piece in its sequence, gapless from 0)."""
    spark = pieces.sparkSession
    ship(spark)
    key = free_name(pieces.columns, "key")
    rows = stored(pieces.select(*whole(pieces, "sequence_id", "offset"), F.monotonically_increasing_id().alias(key)), "pack-pieces")
    size = F.col(f"`{length}`")
    rest = rows.where((size >= 1) & (size < capacity)).select(F.col(f"`{key}`").alias("key"), size.cast("int").alias("length"))
    kept, before, level = [], None, 0
    while True:
        n = rest.count()
        if not n:
            break
        blocks = -(-n // block)
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(blocks)))
        members = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("key", "length"))).alias("m"))
        members = stored(members.select("block", F.col("m.key").alias("keys"), F.col("m.length").alias("lengths")), "pack-blocks")
        best = _solved(members.select("block", "lengths"), capacity, islands, population, epochs, generations, (seed, level))
        laid = stored(members.join(best, "block").mapInArrow(_laid_out(capacity), "key bigint, length bigint, block bigint, bin bigint, fill bigint, offset bigint"), "pack-level")
        bins = laid.where("offset = 0").agg(F.count("*").alias("n"), F.count_if(F.col("fill") < GOOD_FILL * capacity).alias("poor")).first()
        if before is not None and bins["n"] >= before[1]:
            kept.append(before[0])  # nothing saved: the last level's poor bins stay as they were
            break
        little = before is not None and before[1] - bins["n"] < WORTH * before[1]
        laid = laid.select("key", "length", "fill", "offset", F.struct(F.lit(level).alias("level"), "block", "bin").alias("sequence"))
        if blocks == 1 or little or bins["poor"] < 2:
            kept.append(laid)
            break
        poor = F.col("fill") < GOOD_FILL * capacity
        kept.append(laid.where(~poor))
        before = (laid.where(poor), bins["poor"])
        rest, level = laid.where(poor).select("key", F.col("length").cast("int").alias("length")), level + 1
    # level, block and bin in one number; a piece with a sequence of its own has its key, negated
    number = F.shiftleft(F.col("sequence.level").cast("long"), 56) + F.shiftleft(F.col("sequence.block"), 20) + F.col("sequence.bin")
    packed = spark.createDataFrame([], "key bigint, number bigint, place bigint")
    for part in kept:
        packed = packed.unionByName(part.select("key", number.alias("number"), F.col("offset").alias("place")))
    names = [free_name(rows.columns, x) for x in ("packed_key", "packed_number", "packed_place")]
    joined = rows.join(packed.toDF(*names), F.col(f"`{key}`") == F.col(names[0]), "left")
    alone = size >= capacity
    return joined.select(
        *whole(rows, key),
        F.when(alone, -1 - F.col(f"`{key}`")).otherwise(F.col(names[1])).alias("sequence_id"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col(names[2])).alias("offset"),
    )


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """``sequence_id`` and ``ids`` of every sequence: its pieces' ids in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(f"`{ids}`").alias("ids"))))
    joined = F.aggregate(parts["ids"], F.lit(b""), lambda whole_, part: F.concat(whole_, part))
    return packed.where("sequence_id is not null").groupBy("sequence_id").agg(joined.alias(ids))
