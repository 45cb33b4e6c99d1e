"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c lie at squared distance 2 - 2c. All are rotated alike and split into blocks of a few dimensions. Two vectors
within the whole distance are, in at least one block, within that block's share of it, so joining every block by its own small
radius finds each pair that is wanted. A block is joined over a grid whose cells are two radii wide: a vector stands in its own cell
and visits those neighbours before it that its radius reaches, so two vectors meet in one place only. The pair belongs to the first block
in which it is near enough, and there its cosine decides.

Cells become tiles of bounded size. A tile sends back how many links each of its vectors has there, and a spanning forest of
them, never the pairs. Exact copies are joined beforehand and count by their number. Grid and block distances are sums of integers
that floating point holds exactly, so every task judges a pair alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import components, stage

#: Steps of a unit vector's component, and of a component of the rotation.
STEPS, TURNS = float(1 << 20), float(1 << 24)
#: Vectors of a tile; cells with up to twice as many home vectors and visitors are not divided.
TILE = 1024
#: Pairs whose block distances and cosines are looked at together.
PAIRS = 1 << 15


@dataclass(frozen=True)
class Join:
    """Smallest cosine of a link, dimensions of a block, and vectors a cell should have on average."""

    cosine: float = 0.98
    block: int = 8
    cell: int = 512


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """The same orthogonal matrix everywhere, in whole steps."""
    q, r = np.linalg.qr(np.random.default_rng(width).normal(size=(width, width)))
    return np.rint(q * np.sign(np.diag(r)) * TURNS)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled before, so that no square overflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotated(unit: np.ndarray) -> np.ndarray:
    """Rotated vectors in whole steps; every product and partial sum is a whole number below 2^53."""
    return np.rint(np.rint(unit * STEPS) @ rotation(unit.shape[1]).T / TURNS)


def radii(width: int, join: Join) -> tuple[list[slice], np.ndarray]:
    """The blocks and their radii in steps: shares of the squared distance by dimensions, and room for what rounding moves."""
    blocks = [slice(a, min(a + join.block, width)) for a in range(0, width, join.block)]
    dims = np.array([b.stop - b.start for b in blocks], float)
    most = max(0.0, 2 - 2 * join.cosine)
    return blocks, np.ceil(np.sqrt(most * dims / width) * STEPS * (1 + 1e-5) + 4 * np.sqrt(dims) + 4)


def _packed(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The bytes and the width of each vector."""
    for batch in batches:
        vectors = [None if v is None else np.array(v, kind) for v in batch.column("e").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([None if v is None else len(v) for v in vectors], pa.int32()), pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())], names=["vec_id", "label", "width", "v"])


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of one width from their bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


_CELLS = "label string, width int, block int, cell binary, visits boolean, node long, weight long, v binary"
_CELL_SCHEMA = pa.schema([("label", pa.string()), ("width", pa.int32()), ("block", pa.int32()), ("cell", pa.binary()), ("visits", pa.bool_()), ("node", pa.int64()), ("weight", pa.int64()), ("v", pa.binary())])


def cells_of(coordinates: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows and their cell: first everyone's own, then the cells before it that their radius reaches, as combinations of sides."""
    size = 2 * radius
    own = np.floor(coordinates / size)
    yield np.arange(len(own)), own, False
    # As cells are two radii wide, only the nearer neighbour in each dimension is in reach.
    inside = coordinates - own * size
    lower = inside < radius
    gap = np.where(lower, inside, size - inside) ** 2
    grid = own.shape[1]
    for sides in range(1, 1 << grid):
        flips = np.array([(sides >> i) & 1 for i in range(grid)], bool)
        # Before its own cell: the first coordinate that differs is smaller.
        rows = np.flatnonzero(lower[:, np.argmax(flips)] & (gap[:, flips].sum(axis=1) <= radius**2))
        if len(rows):
            yield rows, own[rows] + np.where(flips, np.where(lower[rows], -1, 1), 0), True


def _cells(batches: Iterator[pa.RecordBatch], join: Join, kind: str, with_vectors: bool) -> Iterator[pa.RecordBatch]:
    """Every vector once for each block and cell it stands in or visits."""
    for batch in batches:
        widths, grids = (batch.column(c).to_numpy() for c in ("width", "grid"))
        for width, grid in sorted(set(zip(widths.tolist(), grids.tolist()))):
            part = batch.take(pa.array(np.flatnonzero((widths == width) & (grids == grid))))
            turned = rotated(units(_matrix(part.column("v"), kind)))
            blocks, radius = radii(width, join)
            for b, dims in enumerate(blocks):
                for rows, cell, visits in cells_of(turned[:, dims][:, :grid], radius[b]):
                    some = part.take(pa.array(rows))
                    n = len(rows)
                    keys = [x.tobytes() for x in cell.astype(">i4")]
                    v = some.column("v") if with_vectors else pa.nulls(n, pa.binary())
                    yield pa.RecordBatch.from_arrays([some.column("label"), pa.array(np.full(n, width, np.int32)), pa.array(np.full(n, b, np.int32)), pa.array(keys, pa.binary()), pa.array(np.full(n, visits)), some.column("node"), some.column("weight"), v], schema=_CELL_SCHEMA)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row is linked to over any number of links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _near(a: np.ndarray, b: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` with at most this squared distance."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.nonzero(square <= most)


def _links(unit: np.ndarray, turned: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, b: int, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs, of ``left`` rows with ``right`` ones, that belong to block ``b``."""
    blocks, radius = radii(unit.shape[1], join)
    for l0 in range(0, len(left), TILE):
        for r0 in range(l0 if same else 0, len(right), TILE):
            rows, columns = left[l0 : l0 + TILE], right[r0 : r0 + TILE]
            i, j = _near(turned[rows, blocks[b]], turned[columns, blocks[b]], radius[b] ** 2)
            i, j = rows[i], columns[j]
            if same and r0 == l0:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), PAIRS):
                x, y = i[at : at + PAIRS], j[at : at + PAIRS]
                gap = turned[x, : blocks[b].start] - turned[y, : blocks[b].start]
                earlier = np.zeros(len(x), bool)
                for c in range(b):
                    earlier |= (gap[:, blocks[c]] ** 2).sum(axis=1) <= radius[c] ** 2
                x, y = x[~earlier], y[~earlier]
                linked = np.einsum("ij,ij->i", unit[x], unit[y]) >= join.cosine
                yield x[linked], y[linked]


_FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _tile(group: pa.Table, join: Join, kind: str) -> pa.Table:
    """Of one tile: links of each of its vectors there, and the smallest vector they lead to."""
    group = group.combine_chunks()
    nodes, weight, side = (group.column(c).to_numpy() for c in ("node", "weight", "side"))
    b, inner = group.column("block")[0].as_py(), group.column("inner")[0].as_py()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(left) * len(right) + (len(left) - 1) * len(left) * inner <= 0:
        return _FOUND.empty_table()
    unit = units(_matrix(group.column("v").combine_chunks(), kind))
    turned = rotated(unit)
    found = [_links(unit, turned, left, right, False, b, join)]
    if inner:
        found.append(_links(unit, turned, left, left, True, b, join))
    pairs = [p for f in found for p in f if len(p[0])]
    if not pairs:
        return _FOUND.empty_table()
    x, y = (np.concatenate([p[i] for p in pairs]) for i in range(2))
    links = (np.bincount(x, weight[y], len(nodes)) + np.bincount(y, weight[x], len(nodes))).astype(np.int64)
    has = np.flatnonzero(links)
    return pa.table([nodes[has], nodes[forest(len(nodes), x, y)[has]], links[has]], schema=_FOUND)


_KEY = ["label", "width", "block", "cell"]


def tiles(classes: DataFrame, join: Join, kind: str) -> DataFrame:
    """Rows of all cells with the tile they go to: ``part``, the ``side`` they are on and whether that side is joined with itself."""
    cells = lambda vectors: classes.mapInArrow(partial(_cells, join=join, kind=kind, with_vectors=vectors), _CELLS)
    sizes = cells(False).groupBy(*_KEY).agg(F.count_if(~F.col("visits")).alias("homes"), F.count_if("visits").alias("guests"))
    large = sizes.filter(F.col("homes") + F.col("guests") > 2 * TILE).select(*_KEY, F.ceil(F.col("homes") / TILE).alias("h"), F.ceil(F.col("guests") / TILE).alias("g"))
    large = stage(large)  # Spark knows its size then: while it is small the vectors are not shuffled to meet it
    dealt = cells(True).join(large, _KEY, "left").withColumn("own", F.when(F.col("visits"), F.col("h") + F.pmod(F.xxhash64("node"), F.greatest("g", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.greatest("h", F.lit(1)))))
    # A large cell: tile a of its home vectors meets itself, the tiles behind it and those of the visitors. A visitor has no partner without a home.
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")))
    every = F.sequence(F.lit(0).cast("long"), F.col("h") + F.col("g") - 1)
    home = F.transform(every, lambda x: F.struct(F.least("own", x).alias("a"), F.greatest("own", x).alias("b")))
    guest = F.transform(F.sequence(F.lit(0).cast("long"), F.col("h") - 1), lambda x: F.struct(x.alias("a"), F.col("own").alias("b")))
    pairs = F.when(F.col("h").isNull(), whole).when(F.col("h") == 0, F.array().cast("array<struct<a:bigint,b:bigint>>")).when(F.col("visits"), guest).otherwise(home)
    spread = dealt.withColumn("part", F.explode(pairs))
    side = F.when(F.col("h").isNull(), F.col("visits").cast("int")).otherwise((F.col("own") != F.col("part.a")).cast("int"))
    inner = F.col("part.a") == F.col("part.b")
    return spread.select(*_KEY, "part", side.alias("side"), inner.alias("inner"), "node", "weight", "v")


def near_duplicates(vectors: DataFrame, join: Join = Join()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: its links, and the smallest id that they lead to.

    Rows link if their labels are equal and not null and the cosine of their ``embedding``, in double precision, is at least ``join.cosine``.
    A vector that is null, empty, all zero or holds null, NaN or infinity links with nothing, nor do vectors of different widths. Every row
    is a vector of its own, also where ids repeat; ``component_id`` passes over null ids and is null only if all of a component are.
    ``kept`` is true where a row's id is that of its component. Columns other than ``vec_id``, ``embedding`` and ``label`` are not read.
    """
    e = vectors["embedding"]
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    fine = F.exists(e, lambda x: x != 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & vectors["label"].isNotNull()
    plain = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), F.when(fine, e.cast("array<float>" if kind == "<f4" else "array<double>")).alias("e"), vectors["label"].cast("string").alias("label"))
    packed = stage(plain.select("vec_id", "label", "e").mapInArrow(partial(_packed, kind=kind), "vec_id long, label string, width int, v binary"))
    able = packed.filter("v IS NOT NULL")
    copies = able.groupBy("label", "width", "v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    classes = stage(copies.withColumn("node", F.monotonically_increasing_id()))
    sizes = classes.groupBy("label", "width").agg(F.count("*").alias("n"))
    # As many dimensions of a block make up its grid as bring a cell down to the wanted size; a cell is some 0.3 of a dimension's spread.
    grid = F.least(F.col("width"), F.lit(join.block), F.greatest(F.lit(1), F.ceil(F.log(F.col("n") / join.cell) / np.log(3.5)))).cast("int")
    gridded = classes.join(sizes, ["label", "width"]).select("label", "width", grid.alias("grid"), "node", "weight", "v")
    placed = tiles(gridded, join, kind)
    found = stage(placed.repartition(*_KEY, "part").groupBy(*_KEY, "part").applyInArrow(lambda group: _tile(group, join, kind), "node long, root long, links long"))
    reach = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    labelled = classes.join(counts, "node", "left").join(reach.withColumnRenamed("label", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    told = labelled.join(smallest, "root").select("label", "width", "v", "weight", F.coalesce("links", F.lit(0)).alias("links"), "component_id")
    result = packed.join(told, ["label", "width", "v"], "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select("vec_id", F.coalesce(F.col("weight") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
