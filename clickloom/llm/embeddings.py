"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking.

* Equal vectors are one class; only classes are compared.
* On a bounded sample (``SAMPLE`` classes) rotations are learned that bring the centred vectors
  close to the corners of a cube (iterative quantisation), each from its own random start; bits
  are cut at the median, so codes are balanced. Of a length that is no multiple of a piece, more
  directions than the length has are learned, to whole pieces.
* A code is cut into pieces, one hash table each. Their width follows the number of classes
  (``piece_bits``), so that buckets stay short at every size. A class stands in its bucket and
  asks in the buckets one bit away; a bit is only flipped upwards, so a pair meets once in a
  table. Pairs that differ in at most one bit of any piece are found.
* How many tables the vectors need is measured when the quantiser is fitted, on two kinds of pairs
  of rows that nothing was learned from: their real neighbours in the sample, a little above the
  asked cosine, and neighbours made at exactly that cosine by moving towards other rows, so
  along the directions that the data have. Tables are added until ``TARGET`` of both meet.
  Centring takes what all vectors share out of their cosines; where ``MOST`` tables do not make
  up for that, the cuts of the same rotations move from the median towards the origin.
* If no cut meets the target, and for vectors of any length but the most frequent one, planes
  are drawn at random through the origin. There a bit differs with the probability angle / pi
  whatever the data, so the number of tables follows from ``PROVEN`` alone.
* First only codes travel, and entries without a partner within the radius are dropped: one row
  per entry, never pairs. The radius is the mean distance of the neighbours' codes and four of
  its standard deviations. Then the vectors of the remaining entries meet in their buckets and
  are compared exactly, in double precision. A pair found in several tables counts in the first.
* A bucket with more than ``CELL_ROWS`` entries is cut into blocks that meet pairwise, each pair
  of blocks a cell of its own. Cells return links counted per class, and a spanning forest of
  their links; not the pairs.

Defined results: vectors that are null, empty, zero, or hold a null or a number that is not
finite are alone, as are vectors of a length no other has; only vectors of one length are
compared. Repeated rows count as vectors of their own. A null id is answered with the smallest
id of its component and is not kept; an empty table gives an empty one. Ties of distance do not
matter, as every pair that meets is compared with the bound. Columns beyond id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import longs, mix
from clickloom.llm.graph import components
from clickloom.llm.tables import beside, read, stage

COSINE = 0.9
SAMPLE = 20_000
ITERATIONS = 30
SUBBITS = 16  # of a piece, where the number of classes is not known
BUCKET_ROWS = 64  # entries that a bucket should hold
TABLES = 8  # to begin with
MOST = 40
TARGET = 0.93
PROVEN = 0.95
SHARES = (1.0, 0.75, 0.5, 0.25, 0.0)
TRIALS = 4000
CELL_ROWS = 2048
# Places in the number of a bucket: the length of its vectors, the table, the piece.
TABLE_AT, SIZE_AT = 32, 44

MEMBERS = "vec_id bigint, class bigint, vector binary"
ENTRIES = "bucket bigint, home boolean, class bigint, code binary"


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as doubles, with a hash of their numbers."""
    for batch in batches:
        raw, names = [], []
        for values in batch.column("embedding").to_pylist():
            vector = None
            if values and None not in values:
                vector = np.array(values, np.float64) + 0.0  # no negative zero
                if not np.isfinite(vector).all() or not vector.any():
                    vector = None
            raw.append(None if vector is None else vector.tobytes())
            names.append(None if vector is None else _hash(vector))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(names, pa.int64()), pa.array(raw, pa.binary())],
            names=["vec_id", "class", "vector"],
        )


def _hash(vector: np.ndarray) -> int:
    place = mix(np.arange(1, len(vector) + 1, dtype=np.uint64))
    return int(mix(mix(vector.view(np.uint64) + place).sum(keepdims=True)).view(np.int64)[0])


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling first keeps very large and very small numbers from overflowing when squared.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def piece_bits(classes: int) -> int:
    """The least width at which buckets of ``classes`` codes hold ``BUCKET_ROWS`` entries."""
    bits = 8
    while bits < 32 and classes * (1 + bits / 2) > BUCKET_ROWS << bits:
        bits += 1
    return bits


def neighbours(
    units: np.ndarray, cosine: float, rng: np.random.Generator, side: np.ndarray | None = None
) -> np.ndarray:
    """For each unit vector another one at that cosine, in a random direction or towards ``side``."""
    if units.shape[1] == 1:
        return units
    side = rng.standard_normal(units.shape) if side is None else side
    side = side - (side * units).sum(axis=1, keepdims=True) * units
    flat = np.abs(side).max(axis=1) < 1e-9
    if flat.any():
        side[flat] = rng.standard_normal((flat.sum(), units.shape[1]))
        side[flat] -= (side[flat] * units[flat]).sum(axis=1, keepdims=True) * units[flat]
    return cosine * units + np.sqrt(max(0.0, 1 - cosine**2)) * unit(side)


def _real_neighbours(
    units: np.ndarray, tried: np.ndarray, cosine: float, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tried row and any row, of cosines from the asked one to a quarter of the way
    to 1; about ``TRIALS``, from all tried rows alike."""
    rows = rng.permutation(np.flatnonzero(tried))
    each = max(1, TRIALS // len(rows))
    ones, others = [], []
    for begin in range(0, len(rows), 256):
        part = rows[begin : begin + 256]
        found = units[part] @ units.T
        a, b = np.nonzero((found >= cosine) & (found < cosine + (1 - cosine) / 4))
        order = rng.permutation(len(a))
        order = order[np.argsort(a[order], kind="stable")]
        a, b = a[order], b[order]
        first = np.searchsorted(a, a)
        use = np.arange(len(a)) - first < each
        ones.append(part[a[use]])
        others.append(b[use])
    return units[np.concatenate(ones)[:TRIALS]], units[np.concatenate(others)[:TRIALS]]


class Quantiser:
    """Directions, the cuts of their bits, and the radius of the codes: as many pieces of
    ``bits`` as pairs at ``cosine`` need to meet in one."""

    def __init__(
        self, vectors: np.ndarray, cosine: float = COSINE, iterations: int = ITERATIONS, seed: int = 1,
        bits: int = SUBBITS,
    ):
        rng, trial = np.random.default_rng(seed), np.random.default_rng([seed, 1])
        self.size, self.bits = vectors.shape[1], bits
        units = unit(vectors)
        centred = units - units.mean(axis=0)
        # Rotations fit the rows they are learned from better than others: every fifth row is
        # kept for the measure.
        tried = np.arange(len(units)) % 5 == 0 if len(units) >= 50 else np.ones(len(units), bool)
        shown = centred[~tried if len(units) >= 50 else tried]
        one = units[tried][trial.integers(0, tried.sum(), TRIALS)]
        pairs = [(one, neighbours(one, cosine, trial, centred[trial.integers(0, len(units), TRIALS)]))]
        real = _real_neighbours(units, tried, cosine, trial)
        if len(real[0]) >= 50:
            pairs.append(real)
        planes = np.zeros((self.size, 0))
        middle = np.zeros(0)
        for share in SHARES:
            met = [np.zeros(len(a), bool) for a, _ in pairs]
            apart = [np.zeros(len(a), np.int64) for a, _ in pairs]
            for table in range(MOST):
                here = slice(table * bits, (table + 1) * bits)
                while planes.shape[1] < here.stop:
                    turn = self._rotation(shown, iterations, rng)
                    planes = np.concatenate([planes, turn], axis=1)
                    middle = np.concatenate([middle, np.median(units @ turn, axis=0)])
                for k, (a, b) in enumerate(pairs):
                    differ = np.bitwise_count(
                        _pieces(a, planes[:, here], share * middle[here], bits)
                        ^ _pieces(b, planes[:, here], share * middle[here], bits)
                    )[:, 0]
                    met[k] |= differ <= 1
                    apart[k] += differ
                self.recall = min(float(m.mean()) for m in met)
                if table + 1 >= TABLES and self.recall >= TARGET:
                    self.planes, self.cut = planes[:, : here.stop], share * middle[: here.stop]
                    self.radius = max(int(np.ceil(x.mean() + 4 * x.std())) for x in apart)
                    return
        self._draw(cosine)

    def _rotation(self, shown: np.ndarray, iterations: int, rng: np.random.Generator) -> np.ndarray:
        """Directions whose signs are close to the rows', whole pieces of them."""
        width = -(-self.size // self.bits) * self.bits
        turn = np.linalg.qr(rng.standard_normal((width, self.size)))[0].T
        for _ in range(iterations):
            corners = np.where(shown @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(shown.T @ corners, full_matrices=False)
            turn = left @ right
        return turn

    @classmethod
    def drawn(cls, size: int, cosine: float = COSINE, bits: int = SUBBITS) -> Quantiser:
        """Without a sample: random planes through the origin."""
        model = cls.__new__(cls)
        model.size, model.bits = size, bits
        model._draw(cosine)
        return model

    def _draw(self, cosine: float) -> None:
        differs = float(np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi)
        meets = (1 - differs) ** self.bits + self.bits * differs * (1 - differs) ** (self.bits - 1)
        tables = TABLES if meets >= 1 else max(TABLES, int(np.ceil(np.log(1 - PROVEN) / np.log1p(-meets))))
        if tables > 1 << SIZE_AT - TABLE_AT:
            raise ValueError(f"a cosine of {cosine} is too small for codes")
        count = tables * self.bits
        self.planes = np.random.default_rng([self.size, 2]).standard_normal((self.size, count))
        self.cut = np.zeros(count)
        self.recall = 1 - (1 - meets) ** tables
        self.radius = int(np.ceil(count * differs + 4 * np.sqrt(count * differs * (1 - differs))))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The pieces of every vector's code, one column per table."""
        return _pieces(unit(vectors), self.planes, self.cut, self.bits)


class Quantisers:
    """The quantiser learned for the most frequent length, and drawn ones for all others."""

    def __init__(self, learned: Quantiser, cosine: float):
        self.cosine, self.bits = cosine, learned.bits
        self.by_size = {learned.size: learned}

    def of(self, size: int) -> Quantiser:
        if size not in self.by_size:
            if len(self.by_size) > 8:  # the learned one stays, as the first
                del self.by_size[list(self.by_size)[1]]
            self.by_size[size] = Quantiser.drawn(size, self.cosine, self.bits)
        return self.by_size[size]


def _pieces(units: np.ndarray, planes: np.ndarray, cut: np.ndarray, bits: int) -> np.ndarray:
    kind = np.uint16 if bits <= 16 else np.uint32
    above = (units @ planes > cut).reshape(len(units), -1, bits)
    return (above.astype(kind) << np.arange(bits, dtype=kind)).sum(axis=2, dtype=kind)


def _doubles(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of every length that occurs."""
    sizes = np.array([len(r) for r in raw])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join(raw[k] for k in rows), np.float64).reshape(len(rows), -1)


def _entries(models: Quantisers, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of every class: its own in each table, and those one raised bit away."""
    raised = 1 << np.arange(models.bits, dtype=np.int64)
    for batch in batches:
        names = batch.column("class").to_numpy()
        for rows, vectors in _doubles(batch.column("vector").to_pylist()):
            model = models.of(vectors.shape[1])
            for begin in range(0, len(rows), 1000):
                part = rows[begin : begin + 1000]
                codes = model.codes(vectors[begin : begin + 1000])
                # Whole words, as _partnered reads them.
                words = np.pad(codes, ((0, 0), (0, -codes.shape[1] % (8 // codes.itemsize))))
                raw = np.array([c.tobytes() for c in words], object)
                who, tables = np.divmod(np.arange(codes.size), codes.shape[1])
                own = codes.reshape(-1).astype(np.int64)
                up, bit = np.nonzero((own[:, None] & raised[None, :]) == 0)
                asks = own[up] | raised[bit]
                bucket = np.concatenate([tables << TABLE_AT | own, tables[up] << TABLE_AT | asks])
                at = np.concatenate([who, who[up]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket | (vectors.shape[1] << SIZE_AT)),
                        pa.array(np.arange(len(at)) < len(who)),
                        pa.array(names[part][at]),
                        pa.array(raw[at].tolist(), pa.binary()),
                    ],
                    names=["bucket", "home", "class", "code"],
                )


def _by_key(key: str, batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[tuple[pa.Table, bool]]:
    """Groups of a stream sorted by ``key``; with ``most``, a group beyond that many rows comes
    in several parts, marked as such."""
    held: list[pa.RecordBatch] = []
    count, cut, last = 0, False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for begin, end in zip([0, *edges], [*edges, len(keys)], strict=True):
            if keys[begin] != last:
                if held:
                    yield pa.Table.from_batches(held), cut
                held, count, cut, last = [], 0, False, keys[begin]
            held.append(batch.slice(begin, end - begin))
            count += end - begin
            if most is not None and count > most:
                cut = True
                yield pa.Table.from_batches(held), cut
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held), cut


def _partnered(
    models: Quantisers, radius: int | None, cell_rows: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Entries that have another class within the radius in their bucket. Entries of a bucket
    with more than ``cell_rows`` all stay: the comparison of vectors decides."""

    def emit(table: pa.Table, rows: np.ndarray) -> pa.RecordBatch:
        return table.select(["bucket", "home", "class"]).take(pa.array(rows)).combine_chunks().to_batches()[0]

    for table, cut in _by_key("bucket", batches, cell_rows):
        home = table.column("home").to_numpy()
        rows = np.arange(table.num_rows)
        if not cut:
            if table.num_rows < 2 or not home.any():
                continue
            codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(rows), -1)
            names = table.column("class").to_numpy()
            size = table.column("bucket")[0].as_py() >> SIZE_AT
            most = models.of(size).radius if radius is None else radius
            near = np.zeros(len(rows), bool)
            at = np.flatnonzero(home)
            for begin in range(0, len(rows), 256):
                part = slice(begin, begin + 256)
                apart = np.bitwise_count(codes[part, None, :] ^ codes[None, at, :]).sum(axis=2)
                met = (apart <= most) & (names[part, None] != names[None, at])
                near[part] |= met.any(axis=1)
                near[at] |= met.any(axis=0)
            rows = rows[near]
        if len(rows):
            yield emit(table, rows)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(cosine: float, models: Quantisers, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every cell: ``(class, links, root)``, the number of vectors a class is linked to
    there and the first class of its component there."""
    for table, _ in _by_key("cell", batches, None):
        n = table.num_rows
        if n < 2:
            continue
        bucket = int(table.column("bucket")[0].as_py())
        number = bucket >> TABLE_AT & (1 << SIZE_AT - TABLE_AT) - 1
        home = table.column("home").to_numpy()
        names = table.column("class").to_numpy()
        weight = table.column("n").to_numpy()
        block = table.column("block").to_numpy()
        _, first, second = table.column("cell")[0].as_py().split("/")
        crossing = first != second
        (_, vectors), = _doubles(table.column("vector").to_pylist())
        codes = models.of(vectors.shape[1]).codes(vectors)
        units = unit(vectors)
        at = np.flatnonzero(home)
        links = np.zeros(n, np.int64)
        found_a, found_b = [], []
        for begin in range(0, n, 512):
            part = np.arange(begin, min(n, begin + 512))
            a, b = np.nonzero(units[part] @ units[at].T >= cosine)
            a, b = part[a], at[b]
            # Two homes meet in either order; what asks meets homes only.
            use = (names[a] != names[b]) & (~home[a] | (names[a] < names[b]))
            if crossing:
                use &= block[a] != block[b]
            a, b = a[use], b[use]
            earlier = np.bitwise_count(codes[a, :number] ^ codes[b, :number]) <= 1
            first = ~earlier.any(axis=1)
            a, b = a[first], b[first]
            links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
            found_a.append(a)
            found_b.append(b)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if len(a):
            root = _roots(n, a, b)
            rows = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[rows]), pa.array(links[rows]), pa.array(names[root[rows]])],
                names=["class", "links", "root"],
            )


def _fitted(classes: DataFrame, sample: int, cosine: float) -> Quantisers | None:
    """Quantisers, with one learned on about ``sample`` classes for the length most of them have."""
    total = classes.count()
    if not total:
        return None
    drawn = classes.where(
        F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30)) + 1
    )
    found = sorted((r["class"], bytes(r.vector)) for r in drawn.select("class", "vector").collect())
    if not found:
        found = [(r["class"], bytes(r.vector)) for r in classes.limit(1).collect()]
    _, vectors = max(_doubles([v for _, v in found[: 2 * sample]]), key=lambda m: len(m[0]))
    return Quantisers(Quantiser(vectors, cosine, bits=piece_bits(total)), cosine)


def linked_classes(
    classes: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, radius: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame | None:
    """``(class, links, root)`` per cell with links; ``classes`` is a staged table of
    ``class, n, vector``. Without a ``radius``, the quantiser's is taken."""
    models = _fitted(classes, sample, cosine)
    if models is None:
        return None
    entries = classes.select("class", "vector").mapInArrow(lambda b: _entries(models, b), ENTRIES)
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    live = stage(dealt.mapInArrow(lambda b: _partnered(models, radius, cell_rows, b), "bucket bigint, home boolean, class bigint"))
    counts = live.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    big = counts.where(F.col("_n") > cell_rows).select("bucket", F.ceil(F.col("_n") / cell_rows).cast("int").alias("_p"))
    rows = live.join(beside(stage(big)), "bucket", "left").withColumn("_p", F.coalesce("_p", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("_p")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_p") - 1))
    rows = rows.withColumn("_o", other).withColumn(
        "cell", F.concat_ws("/", "bucket", F.least("block", "_o"), F.greatest("block", "_o"))
    )
    placed = rows.select("cell", "bucket", "home", "block", "class").join(beside(classes), "class")
    cells = placed.repartition("cell").sortWithinPartitions("cell")
    return stage(cells.mapInArrow(
        lambda b: _compared(cosine, models, b), "class bigint, links bigint, root bigint"
    ))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, radius: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Per row ``vec_id, class, n_links, component_id, kept``."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    members = stage(rows.mapInArrow(_classes, MEMBERS))
    classes = stage(
        members.where("class is not null").groupBy("class")
        .agg(F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"), F.min("vec_id").alias("least"))
    )
    found = linked_classes(classes.select("class", "n", "vector"), cosine, sample, radius, cell_rows)
    ids = members.select("vec_id", "class")
    if found is None:
        return ids.select(
            "vec_id", "class", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    links = found.groupBy("class").agg(F.sum("links").alias("_links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("class", "n", "least").join(roots.withColumnRenamed("id", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("_least"))
    answers = stage(
        named.join(smallest, "root").join(links, "class", "left")
        .select(F.col("class").alias("_class"), (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_n"), "_least")
        .where("_n > 0")
    )
    joined = ids.join(beside(answers), F.col("class") == F.col("_class"), "left")
    component = F.coalesce("_least", "vec_id")
    return joined.select(
        "vec_id", "class", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and components of all ``embeddings``; odd rows as the module says."""
    found = near_duplicates(read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


OP8_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, c) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.vec_id WHERE r.c < l.y),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT r.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.c) AS component_id, min(r.c) = r.vec_id AS kept
FROM r LEFT JOIN n ON n.x = r.vec_id GROUP BY r.vec_id
"""
