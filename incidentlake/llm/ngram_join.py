"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two
documents link when ``100 * intersection >= 75 * union``. Sizes a and b can only
link when their symmetric difference is at most D = (a + b) / 7, and the sizes
differ by a third at most.

*Sketch.* Per band of set sizes, the hash space is cut into blocks, and the
shingles of a block are XORed together. A block differs between two documents
only if a shingle of their symmetric difference falls in it, so the number of
differing blocks, like the Hamming distance of the one-bit-per-shingle parity
sketch, is a lower bound of the symmetric difference.

*Pigeonhole.* Of two linked documents' blocks at most D differ. So among any
D + 1 blocks of a document at least one agrees with its partner. Each document
may choose its D + 1 rarest blocks (by exact corpus counts), as long as all use
one order: blocks that nobody else has lead nowhere, and blocks full of a
passage that thousands share come last. A document with D + 1 blocks of its own
drops out.

*Verify.* Candidates must pass the size bound, then the Hamming bound of a
1024-bit parity sketch, then the exact comparison of their shingle sets.

Two steps keep the work down. Before the sketches, a fixed third of the hash
space is counted: a document more than a quarter of whose shingles are found
there and nowhere else cannot link (``possible``). And the members of a block
are not paired with each other at once: they meet the block's smallest document,
then one drawn by hash for each block. Thousands of near copies cost thousands
of comparisons so far. Only members that this leaves in different components
are compared with each other, by size and sketch and within tasks, and pairs
that pass come out to be verified. No link between components is lost. Equal
sets are one node throughout.

Defined results: null and empty texts, and texts without words, have no shingles
and link with nothing; fewer than five words are one shingle; a null id links by
its text, and never becomes a component's id; repeated rows get the same result;
extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._ship import ship
from incidentlake.llm._stored import stored
from incidentlake.llm._text import mix, shingle_sets, slices, utf8
from incidentlake.llm.components import connected_components

WIDTH = 5
THRESHOLD = (75, 100)  # intersection / union, as a fraction
BAND_RATIO = 8
SKETCH_BITS = 1024
COUNTED_SHARE = 0.32  # of the hash space, in the first step
BROADCAST_IDS = 500_000
PIECE_ROWS = 512
TASK_ROWS = 20_000

_U = np.uint64


def _per_document(names: list[str], schema: pa.Schema, rows_of, width: int):
    """A mapInArrow function: ``rows_of(set)`` gives the new columns' values of
    each output row of a document; the columns ``names`` are copied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            for a, b in slices(bounds):
                part = data[bounds[a] : bounds[b]]
                rows, made = [], []
                for i, found in enumerate(shingle_sets(part, bounds[a : b + 1] - bounds[a], width)):
                    for row in rows_of(found):
                        rows.append(a + i)
                        made.append(row)
                copied = [batch.column(x).take(pa.array(rows, pa.int64())) for x in names]
                new = [pa.array([r[k] for r in made], f.type) for k, f in enumerate(list(schema)[len(names) :])]
                yield pa.RecordBatch.from_arrays([*copied, *new], schema=pa.schema([*(pa.field(x, c.type) for x, c in zip(names, copied, strict=True)), *list(schema)[len(names) :]]))

    return run


def _map_documents(docs: DataFrame, new: list[tuple[str, T.DataType, pa.DataType]], rows_of, width: int) -> DataFrame:
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in names), *(T.StructField(n, t) for n, t, _ in new)])
    arrow = pa.schema([*(pa.field(c, pa.null()) for c in names), *(pa.field(n, t) for n, _, t in new)])
    return docs.mapInArrow(_per_document(names, arrow, rows_of, width), schema)


_LONGS = (T.ArrayType(T.LongType()), pa.list_(pa.int64()))


def _identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set."""
    if not len(found):
        return 0, 0
    twin = mix(found ^ _U(0x5851F42D4C957F2D))
    one, two = np.bitwise_xor.reduce(found), np.add.reduce(twin)
    return int(mix(np.array([one ^ twin.sum()]))[0].astype(np.int64)), int(two.astype(np.int64))


def shingled(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, size of the set and its 128-bit identity (``h1``, ``h2``)."""
    long = (T.LongType(), pa.int64())
    return _map_documents(docs, [("n_shingles", *long), ("h1", *long), ("h2", *long)], lambda s: [(len(s), *_identity(s))], width)


def _counted(found: np.ndarray) -> list[tuple]:
    if not len(found):
        return []
    return [(_identity(found)[0], found[: np.searchsorted(found, _U(int(COUNTED_SHARE * 2**64)))].astype(np.int64))]


def own_shingles(docs: DataFrame, width: int) -> DataFrame:
    """Per identity ``h1``, how many shingles of the counted share only it has."""
    rows = _map_documents(docs.select("text"), [("h1", T.LongType(), pa.int64()), ("keys", *_LONGS)], _counted, width)
    counts = rows.select("h1", F.explode("keys").alias("key")).groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    return counts.where("low = high").groupBy(F.col("low").alias("h1")).agg(F.count("*").alias("own"))


def possible(docs: DataFrame, sets: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Documents (the smallest of each set) that may have a partner. Of n
    shingles, at most n - ceil(n * threshold) are missing from a linked partner;
    a set with more that only it has is left out."""
    num, den = threshold
    missing = F.col("n_shingles") - F.ceil(F.col("n_shingles") * num / den)
    joined = sets.join(own_shingles(docs, width), "h1", "left")
    return joined.where(F.coalesce(F.col("own"), F.lit(0)) <= missing).select(F.col("rep").alias("doc_id"))


def band_of(n: int) -> int:
    band = 0
    while BAND_RATIO ** (band + 1) <= n:
        band += 1
    return band


def blocks_of(band: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Number of blocks in a band's sketch: a power of two, about one per
    shingle of its largest set; more in the lowest bands, where a few shingles
    falling together would matter."""
    largest = BAND_RATIO ** (band + 1) * threshold[1] // threshold[0]
    return max(1 << (31 if band == 0 else 16 if band == 1 else 0), 1 << (largest - 1).bit_length())


def block_keys(found: np.ndarray, band: int, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """A key per non-empty block: the band, the block and the XOR of its shingles."""
    block = ((found >> _U(32)) * _U(blocks_of(band, threshold))) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    parity = np.bitwise_xor.reduceat(mix(found + _U(1)), first)
    return mix(parity ^ mix(block[first] + _U(band << 40)))


def _blocks(threshold: tuple[int, int]):
    num, den = threshold

    def rows(found: np.ndarray) -> list[tuple]:
        n = len(found)
        if not n:
            return []
        home = band_of(n)
        bands = [home]
        # a partner from the band below is smaller by a quarter at most
        if home and n * num < BAND_RATIO**home * den:
            bands.append(home - 1)
        most = n * (den - num) // num  # differing blocks, for any partner
        out = []
        for band in bands:
            keys = block_keys(found, band, threshold)
            if len(keys) <= most:
                raise ValueError("shingles fell together in a sketch; more blocks are needed")
            # of the blocks that others have too, this many can be spared
            out.append(((len(keys) - most - 1) * 64 + band, keys.astype(np.int64)))
        return out

    return rows


def _sketch(found: np.ndarray) -> list[tuple]:
    bit, odd = np.unique(mix(found) & _U(SKETCH_BITS - 1), return_counts=True)
    words = np.zeros(SKETCH_BITS // 64, _U)
    for b in bit[odd % 2 == 1].tolist():
        words[b >> 6] |= _U(1 << (b & 63))
    return [(len(found), words.astype(np.int64))]


def _hamming(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def _verify(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict, sides = [], []
            for side in ("text_a", "text_b"):
                data, bounds = utf8(batch.column(side))
                sides.append([s for a, b in slices(bounds) for s in shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], width)])
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                verdict.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(verdict)], names=["a", "b", "same"])

    return run


def _linked(pairs: DataFrame, facts: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (``a``, ``b``) that link: size bound, Hamming bound, exact."""
    num, den = threshold
    side = lambda s: facts.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    near = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where((F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & (_hamming(F.col("sketch_a"), F.col("sketch_b")) * (num + den) <= (F.col("n_a") + F.col("n_b")) * (den - num)))
        .select("a", "b")
    )
    text = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    full = stored(near, "near-pairs").join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
    kind = pairs.schema["a"].dataType.simpleString()
    return full.mapInArrow(_verify(width, num, den), f"a {kind}, b {kind}, same boolean").where("same").select("a", "b")


def _candidates(texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """``key``, ``doc_id``: the blocks through which documents are compared."""
    rows = _map_documents(texts, [("tag", T.LongType(), pa.int64()), ("keys", *_LONGS)], _blocks(threshold), width)
    flat = rows.select("doc_id", "tag", F.explode("keys").alias("key"))
    shared = flat.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # rows that Spark sorts and spills; lists of a document's blocks would be objects on the heap
    mine = Window.partitionBy("doc_id", "tag")
    held = flat.join(shared, "key").withColumns({"rank": F.row_number().over(mine.orderBy("n", "key")), "held": F.count("*").over(mine)})
    return held.where(F.col("rank") <= F.col("held") - F.shiftright("tag", 6)).select("doc_id", "key")


def _open_blocks(held: DataFrame, part: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``component`` of the blocks whose members are in
    several components."""
    placed = held.join(part, held["doc_id"] == part["id"], "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where("low <> high")
    return stored(placed.join(several.select("key", "members"), "key"), "open-blocks")


def _compare_members(threshold: tuple[int, int], id_type: pa.DataType):
    num, den = threshold
    schema = pa.schema([("a", id_type), ("b", id_type)])

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("side").to_numpy(), table.column("j").to_numpy(), table.column("i").to_numpy(), table.column("key").to_numpy()))
        table = table.take(pa.array(order))
        key, i, j, side, n = (table.column(c).to_numpy() for c in ("key", "i", "j", "side", "n"))
        ids = table.column("doc_id").combine_chunks()
        label = pa.array(table.column("component").combine_chunks()).dictionary_encode().indices.to_numpy()
        sketch = table.column("sketch").combine_chunks().flatten().to_numpy().astype(np.int64).view(_U).reshape(len(n), -1)
        cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        left, right = [], []
        for start, end in zip(cut.tolist(), [*cut[1:].tolist(), len(n)], strict=True):
            middle = start + int(np.searchsorted(side[start:end], 1))
            within = i[start] == j[start]
            others = np.arange(start if within else middle, end)
            for x in range(start, end if within else middle):
                y = others[others > x] if within else others
                y = y[(label[y] != label[x]) & (np.minimum(n[x], n[y]) * den >= np.maximum(n[x], n[y]) * num)]
                apart = np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1, dtype=np.int64)
                y = y[apart * (num + den) <= (n[x] + n[y]) * (den - num)]
                left += [x] * len(y)
                right += y.tolist()
        found = [ids.take(pa.array(c, pa.int64())) for c in (left, right)]
        return pa.Table.from_arrays(found, schema=schema)

    return run


def _pairs_within(rows: DataFrame, facts: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (``a``, ``b``) of members of one block in different components that
    pass the size bound and the Hamming bound. A block's members are cut into
    pieces of ``PIECE_ROWS``; two pieces are compared in one place, and many
    such places are dealt to a task, so that neither memory nor rows grow with
    the square of a group."""
    pieces = F.ceil(F.col("members") / PIECE_ROWS).cast("int")
    full = rows.join(facts, "doc_id").withColumns({"pieces": pieces, "piece": F.pmod(F.xxhash64("doc_id"), pieces).cast("int")})
    every = F.sequence(F.lit(0), F.col("pieces") - 1)
    place = F.transform(every, lambda k: F.struct(F.least(k, F.col("piece")).alias("i"), F.greatest(k, F.col("piece")).alias("j"), (F.col("piece") > k).cast("int").alias("side")))
    dealt = full.select("key", "doc_id", "component", "n", "sketch", F.explode(place).alias("p")).select("key", "doc_id", "component", "n", "sketch", "p.*")
    tasks = rows.agg(F.greatest(F.ceil(F.sum(F.ceil(F.col("members") / PIECE_ROWS)) / TASK_ROWS), F.lit(1))).first()[0] or 1
    task = F.pmod(F.xxhash64("key", "i", "j"), F.lit(int(tasks)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    pairs = dealt.withColumn("task", task).groupBy("task").applyInArrow(_compare_members(threshold, id_type), f"a {kind}, b {kind}")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def linked_sets(docs: DataFrame, sets: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Components (``id``, ``component``) of the sets' smallest documents."""
    chosen = stored(possible(docs, sets, width, threshold), "possible")
    if chosen.count() <= BROADCAST_IDS:  # ids only; beyond that the join shuffles
        chosen = F.broadcast(chosen)
    # dealt once to as many files as the session's shuffles have partitions, so that the
    # tasks that count the blocks' keys stay small; the duplicates meet in the same place
    dealt = docs.join(chosen, "doc_id", "left_semi").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    texts = stored(dealt.dropDuplicates(["doc_id"]), "texts")
    facts = stored(_map_documents(texts, [("n", T.LongType(), pa.int64()), ("sketch", *_LONGS)], _sketch, width), "sketches")
    held = stored(_candidates(texts, width, threshold), "blocks")

    # every member with its block's smallest document, then with one drawn by hash
    # for each block: thousands of near copies meet dozens of them
    first = held.groupBy("key").agg(F.min("doc_id").alias("a"))
    star = held.withColumnRenamed("doc_id", "b").join(first, "key").where("a <> b").select("a", "b").distinct()
    links = stored(_linked(star, facts, texts, width, threshold), "links")
    part = connected_components(links)

    rows = _open_blocks(held, part)
    drawn = rows.groupBy("key").agg(F.min_by(F.struct(F.col("doc_id").alias("x"), F.col("component").alias("cx")), F.xxhash64("key", "doc_id")).alias("c")).select("key", "c.*")
    star = rows.join(drawn, "key").where("component <> cx").select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()
    links = stored(links.unionByName(_linked(star, facts, texts, width, threshold)), "links")
    part = connected_components(links)

    # what is still apart: all pairs of a block, compared by sketch within tasks
    rows = _open_blocks(held, part)
    apart = _pairs_within(rows, facts, threshold).distinct()
    return connected_components(links.unionByName(_linked(apart, facts, texts, width, threshold)))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by
    links, itself included) of every row."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = stored(shingled(docs, width), "shingled")
    sets = stored(known.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep")), "sets")
    part = linked_sets(docs, sets, width, threshold)
    named = sets.join(part, sets["rep"] == part["id"], "left").select("h1", "h2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    return known.join(named, ["h1", "h2", "n_shingles"], "left").select(
        F.col("doc_id").alias(doc_id), "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
