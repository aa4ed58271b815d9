"""N-gram Jaccard join with several global token orders.

Two sets whose Jaccard similarity reaches the bound share a token among the first few of both,
whatever total order the tokens are put in. One order gives many false candidates; a candidate
here must share a prefix token under *every* order, and only then are the sets compared.

1. Every text becomes its set of distinct word shingles (64-bit hashes). Texts with the same set
   are one class; only classes are compared, so copies never form pairs. One text of each class that
   has copies is written, and all that follows reads those and the texts without copies.
2. All orders put rare tokens first, tokens that occur once before all others, and differ by a
   seeded hash within levels of rarity. All tokens are counted, as sorted and packed numbers of three
   bytes or so; what is kept of the counts is a sketch of fixed size that only tokens which occur
   again fill. Any function of a token gives a valid order, so where cells are shared by chance that
   costs time, never links. With far more repeated tokens than cells few look as if they occurred
   once; ``sketch_bits`` should grow then as far as the tasks' memory allows.
3. Prefix tokens that only one class has are dropped before rows are sent: they are counted in the
   same way, and those that come again
   make a bit set. A token with up to ``PAIR_ROWS`` rows makes pairs of its classes, and pairs
   stay that meet so under every order. The classes of a token with more rows are linked to the
   smallest of them, one row each and never pairs. Two linked sets share a token under every
   order, so they are found as a pair or meet in such a star. Components of both give groups
   outside which no link exists; all other sets are not sent.
4. A group's sets travel to one task, or, when they hold more than ``cell_tokens`` tokens, to
   cells: classes are split by length (linked sets differ in length by the bound at most, so
   only neighbouring levels meet) and by hash, and every two parts that may link meet in one
   cell. In a cell, candidates must share prefix tokens under all orders; survivors are
   verified exactly. A cell grows its components breadth first and skips pairs that are already
   connected, so a large group of near copies costs about one comparison per member.
5. Components over all cells' links give the answer.

Defined results: null and empty texts have no shingles and are alone, as their own component;
fewer words than a shingle make the whole sequence one shingle; repeated rows are one class and
each is answered; a null id is answered with the smallest id of its component, null if there is
none; an empty table gives an empty one. Ties of rarity are broken by the seeded hash. Batches are cut
into pieces of half a megabyte, a longer text is a piece of its own and shingled whole. Other columns
are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import NOT_SPACE, combine, longs, mix, pieces, ranges, split_words
from clickloom.llm.bitsets import FILTER_BITS, bit_set, in_set
from clickloom.llm.graph import components
from clickloom.llm.tables import beside, read, stage, stage_alone

SHINGLE = 4
PERCENT = 85
# At most four: the order of a token travels in its two lowest bits.
ORDERS = 2
# Rows of a token up to which its classes form pairs; the classes of others form a star.
PAIR_ROWS = 16
# Cells of the rarity sketch: one bit each when it is sent to the tasks, and one byte for some.
SKETCH_BITS = 28
LEVEL_BITS = 5
# Tokens are counted by so many of their bits, in so many parts, and packed so many at a time.
COUNTED_BITS = 40
PART_BITS = 11
SKETCH_TOKENS = 1_000_000
# Text split at a time: a task holds some forty times as much for that.
PIECE_BYTES = 500_000
CELL_TOKENS = 2_000_000

CLASSES = "doc_id bigint, class bigint, n_shingles bigint"
PREFIXES = "token bigint, class bigint"
SETS = "class bigint, n int, tokens binary"
EDGES = "a bigint, b bigint"

_NONE, _FIRST = np.zeros(0, np.uint64), np.array([True])
_SEEDS = np.random.default_rng(7).integers(1, 2**63, 16, dtype=np.uint64)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and where each begins."""
    words = split_words(texts, NOT_SPACE, lower=True)
    counts = words.counts()
    hashes = words.hashes()
    rows, values = [], []
    for length in range(1, n + 1):
        # Texts shorter than a shingle are one shingle of all their words.
        use = counts >= n if length == n else counts == length
        picked = np.flatnonzero(use)
        if not len(picked):
            continue
        each = counts[picked] - length + 1
        at = ranges(words.first[:-1][picked], each)
        rows.append((picked.tolist(), each.tolist()))
        values.append(combine(hashes, length)[at])
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    # One sort per text is several times faster than one of all by text and value.
    sizes = np.zeros(len(counts), np.int64)
    parts: list[np.ndarray] = [_NONE] * len(counts)
    for picked, value in zip(rows, values, strict=True):
        at = 0
        for row, each in zip(*picked, strict=True):
            own = np.sort(value[at : at + each])
            at += each
            own = own[np.concatenate([_FIRST, own[1:] != own[:-1]])]
            parts[row], sizes[row] = own, len(own)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def class_ids(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One value per set, a function of its members; sets are sorted."""
    sizes = np.diff(first)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        place = (np.arange(len(tokens)) - np.repeat(first[:-1], sizes)).astype(np.uint64)
        mixed = mix(tokens + mix(place + np.uint64(1)))
        out[full] = mix(np.add.reduceat(mixed, first[full]) + sizes[full].astype(np.uint64))
    return out


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple]:
    for piece in pieces(batch, "text", PIECE_BYTES):
        tokens, first = shingle_sets(piece.column("text"), n)
        yield piece, tokens, first, class_ids(tokens, first)


def _classes(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, _, first, own in _sets(batch, n):
            sizes = np.diff(first)
            others = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(piece.column(c) for c in others),
                    pa.array(own.view(np.int64), mask=sizes == 0),
                    pa.array(sizes, pa.int64()),
                ],
                names=[*others, "class", "n_shingles"],
            )


def _one_each(
    tokens: np.ndarray, first: np.ndarray, own: np.ndarray, use: np.ndarray | None = None
) -> tuple:
    """Drop empty sets, all but one of equal sets within a piece, and those not in ``use``."""
    _, at = np.unique(own, return_index=True)
    keep = np.diff(first)[at] > 0
    at = at[keep if use is None else keep & use[at]]
    sizes = np.diff(first)[at]
    return tokens[ranges(first[at], sizes)], sizes, own[at]


@dataclass
class Rarity:
    """What the tasks know of the frequency of tokens: for each of ``2 ** bits`` cells of their
    hash, one bit whether a token that occurs again is in it, and for every few cells the level
    (binary logarithm) of the most frequent."""

    bits: int
    flags: bytes
    levels: np.ndarray

    def several(self, tokens: np.ndarray) -> np.ndarray:
        """False for tokens that certainly occur once."""
        cell = tokens >> np.uint64(64 - self.bits)
        byte = np.frombuffer(self.flags, np.uint8)[(cell >> np.uint64(3)).astype(np.int64)]
        return (byte >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def level(self, tokens: np.ndarray) -> np.ndarray:
        block = (tokens >> np.uint64(65 - len(self.levels).bit_length())).astype(np.int64)
        return np.where(self.several(tokens), 1 + self.levels[block].astype(np.uint64), 0).astype(np.uint64)


@dataclass
class Counted:
    """How 64-bit values are counted for a result of ``2 ** bits`` cells: by their top ``width``
    bits, in ``2 ** parts`` parts."""

    bits: int

    @property
    def parts(self) -> int:
        return min(PART_BITS, self.bits - LEVEL_BITS - 1)

    @property
    def width(self) -> int:
        # A difference within a part has 32 bits.
        return min(COUNTED_BITS, 32 + self.parts)

    def packed(self, held: list[np.ndarray]) -> pa.RecordBatch:
        """Values by part, as compressed differences."""
        values = np.sort(np.concatenate(held))
        inside = self.width - self.parts
        edges = np.searchsorted(values, np.arange((1 << self.parts) + 1) << inside)
        names, raw = [], []
        for part, (begin, end) in enumerate(itertools.pairwise(edges.tolist())):
            if begin < end:
                own = values[begin:end] - np.int64(part << inside)
                names.append(part)
                raw.append(zlib.compress(np.diff(own, prepend=0).astype(np.uint32).tobytes(), 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), pa.array(raw, pa.binary())], names=["part", "packed"]
        )

    def blocks(self, values: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """All values of a partition, packed a million or so at a time."""
        held, size = [], 0
        for some in values:
            held.append((some >> np.uint64(64 - self.width)).astype(np.int64))
            size += len(some)
            if size >= SKETCH_TOKENS:
                yield self.packed(held)
                held, size = [], 0
        if size:
            yield self.packed(held)

    def repeated(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Flags and levels of the values that come more than once, by part; one part is unpacked
        at a time."""
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                held.setdefault(part, []).append(raw)
        cells = 1 << (self.bits - self.parts)
        for part in list(held):
            values = np.sort(np.concatenate([
                np.cumsum(np.frombuffer(zlib.decompress(raw), np.uint32), dtype=np.int64) for raw in held.pop(part)
            ]))
            begin = np.flatnonzero(np.concatenate([_FIRST, values[1:] != values[:-1]]))
            times = np.diff(begin, append=len(values))
            again = times > 1
            cell = values[begin[again]] >> (self.width - self.bits)
            flags, most = np.zeros(cells, bool), np.zeros(cells >> LEVEL_BITS, np.int64)
            flags[cell] = True
            np.maximum.at(most, cell >> LEVEL_BITS, times[again])
            levels = np.ceil(np.log2(most.astype(np.float64) + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary()),
                 pa.array([levels.tobytes()], pa.binary())],
                names=["part", "flags", "levels"],
            )

    def sketch(self, counted: DataFrame) -> Rarity:
        """Put together part by part from what ``blocks`` gave; its size is fixed."""
        found = stage_alone(counted.repartition("part").mapInArrow(self.repeated, "part int, flags binary, levels binary"))
        flags = bytearray(1 << (self.bits - 3))
        levels = np.zeros((1 << self.parts, 1 << (self.bits - self.parts - LEVEL_BITS)), np.uint8)
        step = len(flags) >> self.parts
        for part, some, own in found.toLocalIterator():
            flags[part * step : (part + 1) * step] = some
            levels[part] = np.frombuffer(bytes(own), np.uint8)
        return Rarity(self.bits, bytes(flags), levels.reshape(-1))


PACKED = "part int, packed binary"


def _copies(n: int, copied, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and text of the rows whose class is in a broadcast bit set."""
    only = np.frombuffer(copied.value, np.uint8)
    for batch in batches:
        for piece, _, first, own in _sets(batch, n):
            use = np.flatnonzero(in_set(only, own) & (np.diff(first) > 0))
            yield pa.RecordBatch.from_arrays(
                [longs(own[use]), piece.column("text").take(pa.array(use))], names=["class", "text"]
            )


def _distinct(n: int, copied, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Tokens, sizes and classes of the sets of a batch, without those in ``copied``."""
    only = np.frombuffer(copied.value, np.uint8) if copied is not None else None
    for batch in batches:
        for _, tokens, first, own in _sets(batch, n):
            one = _one_each(tokens, first, own, None if only is None else ~in_set(only, own))
            if len(one[2]):
                yield one


class Classes:
    """Every class of the texts once: from the texts themselves if it has no copies, else from a
    table of one text per class."""

    def __init__(self, texts: DataFrame, members: DataFrame, n: int):
        self.n, self.texts = n, texts.select("text")
        several = members.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        flags = bit_set(several.select(F.col("class").alias("hash")))
        self.copied = copied = texts.sparkSession.sparkContext.broadcast(flags)
        found = self.texts.mapInArrow(lambda b: _copies(n, copied, b), "class bigint, text string")
        self.again = stage_alone(found.groupBy("class").agg(F.first("text").alias("text")).select("text"))

    def map(self, work, schema: str) -> DataFrame:
        """What ``work`` makes of the sets."""
        n, copied = self.n, self.copied
        alone = self.texts.mapInArrow(lambda b: work(_distinct(n, copied, b)), schema)
        return alone.unionAll(self.again.mapInArrow(lambda b: work(_distinct(n, None, b)), schema))


def rarity(sets: Classes, bits: int = SKETCH_BITS) -> Rarity:
    """The sketch over all classes."""
    counted = Counted(bits)
    return counted.sketch(sets.map(lambda s: counted.blocks(tokens for tokens, _, _ in s), PACKED))


def order_keys(tokens: np.ndarray, rare: Rarity, order: int) -> np.ndarray:
    """Keys of a total order of tokens: rarity level first, a seeded hash within it."""
    level = rare.level(tokens)
    if order:
        level = (level + np.uint64(3)) >> np.uint64(2)
    return (level << np.uint64(56)) | (mix(tokens ^ _SEEDS[order]) >> np.uint64(8))


def prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of which two linked sets share one, for every set: all but the least overlap
    plus one."""
    return sizes - (sizes * percent + 99) // 100 + 1


def prefixes(
    tokens: np.ndarray, sizes: np.ndarray, levels: Rarity, order: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Prefix tokens under one order, set by set, and how many each set has."""
    keys = order_keys(tokens, levels, order)
    take = prefix_sizes(sizes, percent)
    picked, at = [_NONE], 0
    for size, some in zip(sizes.tolist(), take.tolist(), strict=True):
        own = tokens[at : at + size]
        if some < size:
            # Equal keys of different tokens, where they happen, go by token.
            key = keys[at : at + size]
            last = np.partition(key, some - 1)[some - 1]
            below, equal = np.flatnonzero(key < last), np.flatnonzero(key == last)
            own = own[np.concatenate([below, equal[: some - len(below)]])]
        picked.append(own)
        at += size
    return np.concatenate(picked), take


def _prefix_tokens(percent: int, orders: int, levels, sets: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Prefix tokens under every order that may occur more than once, the order in the lowest
    bits, and whose they are."""
    for tokens, sizes, own in sets:
        for order in range(orders):
            shared, take = prefixes(tokens, sizes, levels.value, order, percent)
            use = levels.value.several(shared)
            shared, who = shared[use], np.repeat(own, take)[use]
            yield mix(shared ^ _SEEDS[order]) << np.uint64(2) | np.uint64(order), who


def repeated_prefixes(sets: Classes, percent: int, orders: int, levels, bits: int = FILTER_BITS) -> bytes:
    """A bit set of the prefix tokens that more than one class has; those that share their counted
    bits with another are in it as well."""
    counted = Counted(bits)
    return counted.sketch(sets.map(
        lambda s: counted.blocks(shared for shared, _ in _prefix_tokens(percent, orders, levels, s)), PACKED
    )).flags


def _prefix_rows(percent: int, orders: int, levels, wanted, sets: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """The prefix tokens that are in ``wanted``, a broadcast bit set, and whose they are."""
    only = np.frombuffer(wanted.value, np.uint8)
    for shared, who in _prefix_tokens(percent, orders, levels, sets):
        use = in_set(only, shared)
        yield pa.RecordBatch.from_arrays([longs(shared[use]), longs(who[use])], names=["token", "class"])


def _wanted_sets(wanted, sets: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """The sets of the classes in a broadcast bit set."""
    only = np.frombuffer(wanted.value, np.uint8)
    for tokens, sizes, own in sets:
        begin = np.cumsum(sizes) - sizes
        use = np.flatnonzero(in_set(only, own))
        raw = [tokens[b : b + s].tobytes() for b, s in zip(begin[use], sizes[use], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [longs(own[use]), pa.array(sizes[use].astype(np.int32)), pa.array(raw, pa.binary())],
            names=["class", "n", "tokens"],
        )


class _Cell:
    """Sets that may link, and for every order who has which prefix token."""

    def __init__(self, sets: list[np.ndarray], levels: Rarity, percent: int, orders: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        joined = np.concatenate(sets)
        self.take = prefix_sizes(self.sizes, percent)
        self.first = np.concatenate([[0], np.cumsum(self.take)])
        self.owner = np.repeat(np.arange(len(sets)), self.take)
        self.tokens, self.postings, self.begin = [], [], []
        for order in range(orders):
            shared, _ = prefixes(joined, self.sizes, levels, order, percent)
            _, number = np.unique(shared, return_inverse=True)
            self.tokens.append(number)
        self.index(np.ones(len(sets), bool))

    def index(self, alive: np.ndarray) -> None:
        """Postings of the sets that still have no component."""
        self.postings, self.begin = [], []
        for number in self.tokens:
            use = np.flatnonzero(alive[self.owner])
            order = use[np.argsort(number[use], kind="stable")]
            self.postings.append(self.owner[order])
            self.begin.append(np.searchsorted(number[order], np.arange(int(number.max()) + 2)))

    def candidates(self, x: int, alive: np.ndarray) -> np.ndarray:
        """Live sets of fitting size that share a prefix token with x under every order."""
        low, high = self.sizes * 100 >= self.percent * self.sizes[x], self.sizes[x] * 100 >= self.percent * self.sizes
        fits = alive & low & high
        for number, postings, begin in zip(self.tokens, self.postings, self.begin, strict=True):
            own = np.unique(number[self.first[x] : self.first[x + 1]])
            met = np.zeros(len(self.sets), bool)
            met[postings[ranges(begin[own], begin[own + 1] - begin[own])]] = True
            fits &= met
            if not fits.any():
                break
        return np.flatnonzero(fits)

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` reach the bound with x; compared as whole sets."""
        if not len(others):
            return others
        own = self.sets[x]
        flat = np.concatenate([self.sets[y] for y in others])
        place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        same = (own[place] == flat).astype(np.int64)
        sizes = self.sizes[others]
        both = np.add.reduceat(same, np.cumsum(sizes) - sizes)
        return others[100 * both >= self.percent * (len(own) + sizes - both)]

    def roots(self) -> np.ndarray:
        """The first set of every set's component, by growing one component after the other."""
        root = np.full(len(self.sets), -1, np.int64)
        alive = np.ones(len(self.sets), bool)
        indexed = len(self.sets)
        for seed in range(len(self.sets)):
            if not alive[seed]:
                continue
            alive[seed] = False
            root[seed] = seed
            queue = [seed]
            while queue:
                x = queue.pop()
                if 2 * int(alive.sum()) < indexed:
                    self.index(alive)
                    indexed = int(alive.sum())
                found = self.linked(x, self.candidates(x, alive))
                root[found] = seed
                alive[found] = False
                queue.extend(found.tolist())
        return root


def _cell_edges(
    levels, percent: int, orders: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Links of every cell as stars; the stream is sorted by cell."""
    cell, own, sets = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(sets) > 1:
            root = _Cell(sets, levels.value, percent, orders).roots()
            names = np.array(own, np.int64)
            moved = np.flatnonzero(root != np.arange(len(sets)))
            if len(moved):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[moved]), pa.array(names[root[moved]])], names=["a", "b"]
                )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("cell", "class", "tokens"))
        for key, name, raw in zip(*columns, strict=True):
            if key != cell:
                yield from flush()
                cell, own, sets = key, [], []
            own.append(name)
            sets.append(np.frombuffer(raw, np.uint64))
    yield from flush()


def _cells(sets: DataFrame, percent: int, cell_tokens: int) -> DataFrame:
    """Every set with the cells it takes part in.

    Group g with more tokens than a cell takes is split into length levels; level l into
    ``parts`` by hash. A cell is a pair of parts, of one level or of two neighbouring ones.
    """
    level = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    weights = sets.groupBy("grp").agg(F.sum("n").alias("_all"))
    big = beside(stage(weights.where(F.col("_all") > cell_tokens).select("grp", F.lit(True).alias("_big"))))
    rows = sets.join(big, "grp", "left").withColumn("_l", F.when(F.col("_big"), level))
    whole = rows.where("_big is null").withColumn("cell", F.concat_ws("/", "grp"))
    split = rows.where("_big")
    parts = split.groupBy("grp", "_l").agg(F.ceil(2 * F.sum("n") / cell_tokens).cast("int").alias("_p"))
    near = parts.select(
        "grp", F.explode(F.array(F.col("_l") - 1, F.col("_l"), F.col("_l") + 1)).alias("_l"),
        F.struct(F.col("_l").alias("l"), F.col("_p").alias("p")).alias("_n"),
    ).groupBy("grp", "_l").agg(F.collect_list("_n").alias("_near"))
    parts = beside(stage(parts.join(near, ["grp", "_l"])))
    placed = split.join(parts, ["grp", "_l"]).withColumn("_s", F.pmod(F.xxhash64("class"), F.col("_p")))
    mine = F.format_string("%05d.%05d", F.col("_l"), F.col("_s"))

    def with_level(n):
        other = F.transform(
            F.sequence(F.lit(0), n["p"] - 1), lambda s: F.format_string("%05d.%05d", n["l"], s)
        )
        return F.transform(
            other, lambda o: F.concat_ws("/", F.col("grp"), F.least(mine, o), F.greatest(mine, o))
        )

    cells = F.array_distinct(F.flatten(F.transform("_near", with_level)))
    placed = placed.withColumn("cell", F.explode(cells))
    columns = ["cell", "class", "tokens"]
    return whole.select(columns).unionAll(placed.select(columns))


def _stars(met: DataFrame, pair_rows: int) -> DataFrame:
    """Classes of a token with many rows, each linked to the smallest of them."""
    many = met.where((F.col("rows") > pair_rows) & (F.col("class") != F.col("hub")))
    return many.select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()


def _pairs(met: DataFrame, pair_rows: int, orders: int) -> DataFrame:
    """Pairs of classes that meet in tokens with few rows under every order.

    A token has at most ``pair_rows`` rows here, so a row makes less than that many pairs.
    """
    few = met.where(F.col("rows") <= pair_rows).groupBy("token").agg(F.collect_set("class").alias("who"))
    pairs = F.flatten(F.transform("who", lambda a: F.transform(
        F.filter("who", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    order = F.expr("shiftleft(1, cast(token & 3 as int))")
    found = few.select(order.alias("order"), F.inline(pairs).alias("a", "b"))
    every = found.groupBy("a", "b").agg(F.bit_or("order").alias("orders"))
    return every.where(F.col("orders") == (1 << orders) - 1).select("a", "b")


def classes(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS,
    cell_tokens: int = CELL_TOKENS, sketch_bits: int = SKETCH_BITS, pair_rows: int = PAIR_ROWS,
    hashed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, class, n_shingles)`` per row, ``hashed`` with the ``text_hash`` in front, and
    ``(id, root)`` for every class that is not the root of its component."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = texts.select(F.xxhash64("text").alias("text_hash"), "*") if hashed else texts
    members = stage(rows.mapInArrow(lambda b: _classes(n, b), "text_hash bigint, " * hashed + CLASSES))
    context = docs.sparkSession.sparkContext
    sets = Classes(texts, members, n)
    copied = sets.copied
    levels = context.broadcast(rarity(sets, sketch_bits))
    shared = context.broadcast(repeated_prefixes(sets, percent, orders, levels))
    rows = stage(sets.map(lambda s: _prefix_rows(percent, orders, levels, shared, s), PREFIXES))
    hubs = rows.groupBy("token").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("rows"))
    hubs = stage_alone(hubs.where("rows > 1"))
    met = stage_alone(rows.join(hubs, "token"))
    groups = components(stage_alone(_stars(met, pair_rows).unionAll(_pairs(met, pair_rows, orders))))
    named = groups.unionAll(groups.select(F.col("root").alias("id"), "root").distinct())
    named = stage(named.select(F.col("id").alias("class"), F.col("root").alias("grp")))
    wanted = context.broadcast(bit_set(named.select(F.col("class").alias("hash"))))
    sets = stage_alone(sets.map(lambda s: _wanted_sets(wanted, s), SETS).join(named, "class"))
    cells = _cells(sets, percent, cell_tokens).repartition("cell").sortWithinPartitions("cell")
    links = stage_alone(cells.mapInArrow(lambda b: _cell_edges(levels, percent, orders, b), EDGES))
    # All that was made of them is written: the tasks that follow need none of them again.
    for sent in (levels, shared, wanted, copied):
        sent.destroy()
    return members, components(links)


def similar_groups(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS,
    cell_tokens: int = CELL_TOKENS, sketch_bits: int = SKETCH_BITS, pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """Per row ``doc_id, class, n_shingles, component_id``: documents are linked when
    ``100 * |A and B| >= percent * |A or B|``; a component is named by its smallest id."""
    members, roots = classes(docs, n, percent, orders, cell_tokens, sketch_bits, pair_rows)
    roots = beside(stage(roots)).withColumnRenamed("id", "class")
    placed = members.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    # Most components are one document; only the others have a name of their own to look up.
    shared = beside(stage(
        placed.where("class is not null").groupBy("root")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_least"))
        .where("_n > 1").select("root", "_least")
    ))
    return placed.join(shared, "root", "left").select(
        "doc_id", "class", "n_shingles", F.coalesce("_least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, all columns as they were: the smallest by id, nulls last, then
    by hash of the text; of rows that agree in both, the smallest by the other columns. Documents
    without words all stay."""
    members, roots = classes(docs, n, percent, hashed=True)
    roots = beside(stage(roots)).withColumnRenamed("id", "class")
    placed = members.where("class is not null").join(roots, "class", "left")
    placed = placed.select("doc_id", "text_hash", F.coalesce("root", "class").alias("root"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    firsts = (
        placed.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.min(own).alias("_first"))
        .where("_n > 1").select("root", "_first")
    )
    # Which rows of a group of several are the one to keep, and how often that one stands there.
    judged = placed.join(beside(stage(firsts)), "root").groupBy("doc_id", "text_hash").agg(
        F.bool_or(own == F.col("_first")).alias("_keep"), F.count(F.lit(1)).alias("_n")
    )
    judged = stage(judged.where("not _keep or _n > 1").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"), F.col("_keep").alias("__keep")
    ))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text"))
    left = docs.join(beside(judged), same, "left_anti")
    repeated = judged.where("__keep")
    if repeated.isEmpty():
        return left
    again = docs.join(beside(stage(repeated)), same).groupBy("__id", "__text")
    return left.unionByName(again.agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shingles and component of every row of ``documents``; odd rows as the module says."""
    groups = similar_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 3], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 85 * (nx.n + ny.n - common)),
e2 AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT e2.y, r.c FROM r JOIN e2 ON e2.x = r.doc_id WHERE r.c < e2.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""
