"""Near-duplicate vectors by lattice hashing: cells of the E8 lattice, their neighbours, exact cosines."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache
from math import acos, cos

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import by_batch, connected_components, packed, settle
from holdfast.llm.entries import entry, table

LEAST = 0.9
#: Independent projections, each with its own lattice cells.
TABLES = 5
#: Neighbouring cells that a vector looks into, in each table.
PROBES = 4
#: Size of the lattice: a projected unit vector has coordinates of about 1 / SCALE.
SCALE = 1.5
SEED = 8
#: Vectors of a cell that one task compares at once. Larger cells are compared in pairs of blocks.
BLOCK = 8192
#: A cell of the first table gets a core if it has over 1 / CORES of the vectors, and CORE of them.
CORES, CORE = 4096, 256
#: Pairs compared at once.
TILE = 1024


@cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, by rule: two entries of +-1; all entries +-1/2, an even number
    of them negative."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            found.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    halves = itertools.product((0.5, -0.5), repeat=8)
    found += [list(h) for h in halves if sum(x < 0 for x in h) % 2 == 0]
    return np.array(found)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest point of whole coordinates with an even sum."""
    near = np.rint(x)
    odd = near.sum(axis=-1) % 2 != 0
    miss = x - near
    worst = np.expand_dims(np.abs(miss).argmax(axis=-1), -1)
    step = np.where(np.take_along_axis(miss, worst, -1) >= 0, 1.0, -1.0) * odd[..., None]
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8: whole coordinates with an even sum, or such a point moved by halves."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1)
    return np.where(nearer[..., None], whole, half)


@cache
def _projections(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, width, 8))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, in doubles; very large and very small ones too."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cells(units: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(homes, probes): for each vector and table the key of its own cell, and of those it looks into.

    Own cell: the lattice point nearest to the projection. Looked into: the points one root away
    that are nearest to it. A key hashes width, table and point.
    """
    n, width = units.shape
    homes = np.empty((n, tables), np.int64)
    looks = np.empty((n, tables, probes), np.int64)
    rng = np.random.default_rng([seed, width])
    odd = rng.integers(-(1 << 62), 1 << 62, (tables, 8)) * 2 + 1
    base = rng.integers(-(1 << 62), 1 << 62, tables)
    steps = (2 * roots()).astype(np.int64)
    for t, projection in enumerate(_projections(width, tables, seed)):
        y = units @ projection / scale
        point = decode(y)
        homes[:, t] = base[t] + ((2 * point).astype(np.int64) * odd[t]).sum(axis=1)
        if probes:
            near = np.argpartition(-((y - point) @ roots().T), probes - 1, axis=1)[:, :probes]
            looks[:, t] = homes[:, t, None] + (steps[near] * odd[t]).sum(axis=2)
    return homes, looks


def _usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _binary(vectors: pa.Array) -> list[np.ndarray]:
    """The vectors of an array, each as a slice of one array of doubles."""
    ends = vectors.offsets.to_numpy()
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.split(values, (ends - ends[0])[1:-1])


_ENCODED = "id long, size long, unit binary, homes binary, looks binary"


def _encoder(tables: int, probes: int, scale: float, seed: int):
    def encode(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not len(batch):
            return None
        vectors = _binary(batch["vector"])
        widths = np.array([len(v) for v in vectors], np.int64)
        units, homes, looks = ([b""] * len(vectors) for _ in range(3))
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            u = unit(np.stack([vectors[i] for i in rows]))
            h, p = cells(u, tables, probes, scale, seed)
            for k, i in enumerate(rows):
                units[i], homes[i], looks[i] = u[k].tobytes(), h[k].tobytes(), p[k].tobytes()
        columns = [batch["id"], batch["size"], *(pa.array(x, pa.binary()) for x in (units, homes, looks))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "size", "unit", "homes", "looks"])

    return encode


def _flat(values: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as one array of numbers, and where each begins in it."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    width = np.dtype(kind).itemsize
    data = values.buffers()[2]
    flat = np.frombuffer(data, kind, ends[-1] // width) if data is not None and ends[-1] else np.empty(0, kind)
    return flat, ends // width


def _table(values: pa.Array, kind, *shape: int) -> np.ndarray:
    """Binary values of one size as an array with a row for each."""
    flat, ends = _flat(values, kind)
    return flat[ends[0] : ends[-1]].reshape(len(values), *shape)


def _first_homes(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys = [np.frombuffer(h, np.int64, 1)[0] for h in batch["homes"].to_pylist()]
    columns = [batch["id"], pa.array(keys, pa.int64()), batch["unit"]]
    return pa.RecordBatch.from_arrays(columns, names=["id", "cell", "unit"])


def _with_cores(encoded: DataFrame, least: float) -> DataFrame:
    """The encoded vectors with ``core``: which core each belongs to, -1 for none.

    A crowded cell of the first table gets a centre, one of its vectors. Those within half the angle
    of ``least`` from it are its core: any two of them are links, whatever else they meet, so a core
    is counted and never compared within. At most CORES cells are crowded, by their share of all
    vectors: their centres are broadcast.
    """
    homes = by_batch(encoded, _first_homes, "id long, cell long, unit binary")
    count = homes.groupBy("cell").agg(F.count("*").alias("n"))
    bound = max(CORE, encoded.count() // CORES)
    crowded = count.where(F.col("n") > bound).select("cell")
    centre = F.min_by(F.struct("id", "unit"), F.xxhash64("id"))
    centres = homes.join(F.broadcast(crowded), "cell").groupBy("cell").agg(centre.alias("c"))
    found = {r["cell"]: (r["c"]["id"], bytes(r["c"]["unit"])) for r in centres.collect()}
    shared = encoded.sparkSession.sparkContext.broadcast(found)
    near = cos(acos(least) / 2) + 1e-9  # a margin for rounding

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        core = np.full(len(batch), -1, np.int64)
        for i, (home, own) in enumerate(zip(batch["homes"], batch["unit"], strict=True)):
            at = shared.value.get(int(np.frombuffer(home.as_buffer(), np.int64, 1)[0]))
            if at and len(at[1]) == len(own.as_buffer()):
                close = np.frombuffer(own.as_buffer()) @ np.frombuffer(at[1])
                core[i] = at[0] if close >= near else -1
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(core)], names=[*batch.schema.names, "core"])

    return by_batch(encoded, mark, f"{_ENCODED}, core long")


def _dealt(tables: int, probes: int):
    """A row for each cell that a vector lives in or looks into."""

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        homes = _table(batch["homes"], np.int64, tables, 1)
        looks = _table(batch["looks"], np.int64, tables, probes)
        keys = np.concatenate([homes, looks], axis=2)
        t, k = np.divmod(np.arange(tables * (1 + probes)), 1 + probes)
        columns = {
            "cell": pa.array(keys.ravel()),
            "t": pa.array(np.tile(t, len(batch)).astype(np.int32)),
            "home": pa.array(np.tile(k == 0, len(batch))),
        }
        rest = batch.take(pa.array(np.repeat(np.arange(len(batch)), len(t))))
        return pa.RecordBatch.from_arrays([*columns.values(), *rest.columns], names=[*columns, *rest.schema.names])

    return deal


_CELLS = "cell long, t int, home boolean"
_DEALT = f"{_CELLS}, {_ENCODED}, core long"


def _paired(dealt: DataFrame, small: DataFrame, block: int) -> DataFrame:
    """The dealt rows with ``pair`` and ``side``: which comparison of the cell a row takes part in.

    Cells of up to ``block`` rows are one comparison. A larger cell is cut into blocks, by a hash, and
    by core; each pair of blocks is a comparison, but for blocks of one core. A row goes to as many
    comparisons as its cell has blocks, so no cell is too large for a task. small: the same rows,
    with cell, t and core only.
    """
    sizes = small.groupBy("cell", "t").agg(F.count("*").alias("n")).where(F.col("n") > block).drop("n")
    hot = settle(sizes, "hot")
    plain = dealt.withColumn("pair", F.lit(0).cast("long")).withColumn("side", F.lit(2))
    if hot.isEmpty():
        return plain
    key = ["cell", "t"]
    groups = small.join(hot, key).groupBy(*key, "core").agg(F.count("*").alias("n"))
    groups = groups.withColumn("blocks", F.ceil(F.col("n") * 2 / F.lit(block)).cast("int")).drop("n")
    groups = settle(groups, "groups")
    one = groups.select(*key, "core", F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("b"))
    other = one.toDF(*key, "core2", "b2")
    pairs = one.join(other, key).where(
        (F.struct("core", "b") <= F.struct("core2", "b2")) & ((F.col("core") < 0) | (F.col("core") != F.col("core2")))
    )
    pairs = settle(pairs.withColumn("pair", F.monotonically_increasing_id() + 1), "pairs")
    same = (F.col("core") == F.col("core2")) & (F.col("b") == F.col("b2"))
    left = pairs.select(*key, "core", "b", "pair", F.when(same, 2).otherwise(0).alias("side"))
    right = pairs.where(~same).select(*key, F.col("core2").alias("core"), F.col("b2").alias("b"), "pair", F.lit(1).alias("side"))
    ends = settle(left.unionAll(right), "ends")
    many = dealt.join(groups, [*key, "core"])
    many = many.withColumn("b", (F.pmod(F.xxhash64("id"), F.col("blocks")) + 1).cast("int")).drop("blocks")
    many = many.join(ends, [*key, "core", "b"]).drop("b").select(*plain.columns)
    return plain.join(hot, key, "left_anti").select(*plain.columns).unionAll(many)


def _meet(homes: np.ndarray, looks: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """Whether vectors a and b share a cell in table t: a home, or one looks into the other's."""
    found = homes[a, t] == homes[b, t]
    found |= (looks[a, t] == homes[b, t][:, None]).any(axis=1)
    return found | (looks[b, t] == homes[a, t][:, None]).any(axis=1)


def _tiles(units: np.ndarray, left: np.ndarray, right: np.ndarray, least: float):
    """Positions (a, b) of left and right vectors at a cosine of ``least`` or more, a tile at a time."""
    for i in range(0, len(left), TILE):
        for j in range(0, len(right), TILE):
            rows, columns = left[i : i + TILE], right[j : j + TILE]
            a, b = np.nonzero(units[rows] @ units[columns].T >= least)
            yield rows[a], columns[b]


def _links(rows: _Rows, at: int, to: int, least: float) -> pa.RecordBatch | None:
    """(id, n, root) for the vectors of one comparison that have links there.

    n counts links by the copies they lead to; root is the least id of the local component. A pair
    counts in the first table in which it meets, and there in its shared home or, if both look into
    the other's, in the home of the larger id: so once over all comparisons.
    """
    part = slice(at, to)
    t, ids, size, core = int(rows.t[at]), rows.id[part], rows.size[part], rows.core[part]
    home, side, homes, looks = rows.home[part], rows.side[part], rows.homes[part], rows.looks[part]
    units = rows.units(at, to)
    whole = side == 2
    found = [
        _tiles(units, np.flatnonzero(side != 1), np.flatnonzero(home & (side != 0)), least),
        _tiles(units, np.flatnonzero(side == 1), np.flatnonzero(home & (side == 0)), least),
    ]
    n, ends = np.zeros(len(ids), np.int64), []
    for k, tiles in enumerate(found):
        for a, b in tiles:
            # two at home come up in both orders, or in both rounds: one of them counts
            both = home[a] & home[b]
            keep = ~both | (k == 0) & ((ids[a] < ids[b]) | ~whole[a])
            keep &= (core[a] < 0) | (core[a] != core[b])
            a, b, both = a[keep], b[keep], both[keep]
            twice = ~both & (looks[b, t] == homes[a, t][:, None]).any(axis=1)
            keep = ~twice | (ids[a] < ids[b])
            for earlier in range(t):
                keep &= ~_meet(homes, looks, a, b, earlier)
            a, b = a[keep], b[keep]
            np.add.at(n, a, size[b])
            np.add.at(n, b, size[a])
            ends.append(_forest(a, b, len(ids)))
    some = np.flatnonzero(n)
    if not len(some):
        return None
    a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    columns = [pa.array(ids[some]), pa.array(n[some]), pa.array(ids[label[some]])]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n", "root"])


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As few pairs with the same components: each vector with its least neighbour, and the pairs
    that this leaves between different ones."""
    least = np.arange(size)
    np.minimum.at(least, a, b)
    np.minimum.at(least, b, a)
    for _ in range(2):
        least = least[least]
    own = np.flatnonzero(least != np.arange(size))
    apart = least[a] != least[b]
    return np.r_[own, a[apart]], np.r_[least[own], b[apart]]


class _Rows:
    """Dealt rows as arrays, sorted by comparison."""

    def __init__(self, batch: pa.RecordBatch, tables: int, probes: int) -> None:
        names = ("cell", "t", "pair", "id", "size", "core", "home", "side")
        plain = {c: batch[c].to_numpy(zero_copy_only=False) for c in names}
        self.t, self.id, self.size, self.core = (plain[c] for c in ("t", "id", "size", "core"))
        self.home, self.side = plain["home"], plain["side"]
        self.homes = _table(batch["homes"], np.int64, tables)
        self.looks = _table(batch["looks"], np.int64, tables, probes)
        self.flat, self.ends = _flat(batch["unit"], np.float64)
        keys = [plain[c] for c in ("cell", "t", "pair")]
        self.cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1

    def units(self, at: int, to: int) -> np.ndarray:
        """The vectors of one comparison, all of one length."""
        return self.flat[self.ends[at] : self.ends[to]].reshape(to - at, -1)


def _compared(tables: int, probes: int, least: float):
    """Links of a partition sorted by (cell, t, pair): whole comparisons, one at a time."""

    def found(rows: _Rows, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        homes = np.r_[0, np.cumsum(rows.home)]
        for at, to in itertools.pairwise(cuts):
            if to - at > 1 and homes[to] > homes[at]:
                links = _links(rows, at, to, least)
                if links is not None:
                    yield links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, rows, last = None, None, 0
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            rows = _Rows(batch, tables, probes)
            last = int(rows.cuts[-1]) if len(rows.cuts) else 0
            yield from found(rows, [0, *rows.cuts.tolist()])
            rest = batch.slice(last)  # its last comparison may go on in the next batch
        if rest is not None:
            yield from found(rows, [last, len(rows.id)])

    return run


def near_vectors(
    rows: DataFrame,
    least: float = LEAST,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """Every row in ``_row``, with ``n_links`` and ``component_id``.

    rows: vec_id, embedding. Two rows link if their cosine, in doubles, is ``least`` or more and they
    meet in the lattice: random projections to eight dimensions are decoded to E8 in several tables,
    and a vector meets those in its own cell, those whose cells it looks into and those that look
    into its own. n_links counts the other rows a row links with; component_id is the least vec_id
    it reaches over links, its own included (null only where no row it reaches has an id).

    Equal vectors are one entry of the index that counts as often as it occurs: copies link with each
    other and are never compared. Null and empty vectors, zero vectors and those with a null or
    non-finite component link with nothing. Vectors of different lengths never link. Repeated rows
    and ids give a row each, an empty table none; all columns are kept in ``_row``.
    """
    if not 0 < least <= 1:
        raise ValueError("least must lie above 0, and be 1 at most")
    vector = F.col("_row.embedding")
    every = packed(rows).select(
        "_row", F.col("_row.vec_id").cast("long").alias("v"), F.when(_usable(vector), vector).alias("vector")
    )
    twice = [F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(seed), "vector").alias("k2")]
    keyed = every.select("_row", "v", "vector", *twice)
    own = keyed.where("vector is not null").select("v", "vector", "k1", "k2")
    entries = own.groupBy("k1", "k2").agg(
        F.first("vector").alias("vector"), F.count("*").alias("size"), F.min("v").alias("least")
    )
    entries = settle(entries.withColumn("id", F.monotonically_increasing_id()), "vectors")

    encoded = by_batch(entries.select("id", "size", "vector"), _encoder(tables, probes, scale, seed), _ENCODED)
    encoded = settle(_with_cores(settle(encoded, "encoded"), least), "cores")
    deal = _dealt(tables, probes)
    dealt = by_batch(encoded, deal, _DEALT)
    small = by_batch(encoded.select("homes", "looks", "core"), deal, f"{_CELLS}, homes binary, looks binary, core long")
    order = ["cell", "t", "pair"]
    compared = _paired(dealt, small, block).repartition(*order).sortWithinPartitions(*order)
    links = settle(compared.mapInArrow(_compared(tables, probes, least), "id long, n long, root long"), "links")

    cores = encoded.where("core >= 0").select("id", "core", "size")
    sums = cores.groupBy("core").agg(F.sum("size").alias("n"))
    within = cores.join(sums, "core").select("id", (F.col("n") - F.col("size")).alias("n"), F.col("core").alias("root"))
    links = links.unionAll(within)
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    roots_ = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = entries.select("id", "k1", "k2", "size", "least").join(counts, "id", "left")
    known = known.join(roots_.withColumnRenamed("v", "id"), "id", "left")
    known = settle(known.withColumn("root", F.coalesce("root", "id")), "known")
    lows = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(lows, "root").select(
        "k1", "k2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n"), "component_id"
    )
    found = keyed.where("vector is not null").select("_row", "k1", "k2").join(known, ["k1", "k2"])
    found = found.select("_row", F.col("n").alias("n_links"), "component_id")
    alone = keyed.where("vector is null").select("_row", F.lit(0).cast("long").alias("n_links"), F.col("v").alias("component_id"))
    return found.unionAll(alone)


def drop_near_vectors(rows: DataFrame, **settings) -> DataFrame:
    """One row of each component stays: that with the smallest vec_id, with all columns.

    Of rows that share this id all stay; so do all rows of components without ids.
    """
    found = near_vectors(rows, **settings)
    return found.where(F.col("_row.vec_id").cast("long").eqNullSafe(F.col("component_id"))).select("_row.*")


SQL = """
with recursive rows as materialized (
  select vec_id::bigint as vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
),
links as materialized (
  select a.vec_id as a, b.vec_id as b from rows a join rows b
  on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.9
),
reach(v, c) as (
  select vec_id, vec_id from rows union select l.a, r.c from reach r join links l on l.b = r.v
)
select v as vec_id, (select count(*) from links where a = v)::bigint as n_links,
  min(c) as component_id, v = min(c) as kept
from reach group by v
"""


@entry("op12_lattice", SQL)
def op12_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    vec_id = F.col("_row.vec_id")
    return found.select(
        vec_id.alias("vec_id"), "n_links", "component_id", vec_id.eqNullSafe(F.col("component_id")).alias("kept")
    )
