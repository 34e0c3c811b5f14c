"""Cosine similarity of sparse rows (id, feature, weight).

One target is compared with everything in a single pass. All rows are compared
with each other tile by tile: ids are hashed into tiles, a task takes the rows
of two tiles, multiplies them as small matrices and keeps only the best
neighbours, so the pairs of a feature that many rows share are never written out.
Many rows with few features in common are packed into one array per tile, which is
stored once; a task reads the tiles one after the other beside its own, and makes
their products sparse. Many rows that have most of a few features are packed into
arrays and go by larger tiles too.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewell.operators.postings import top_rows
from tidewell.session import discard, materialize, materialize_with, read_in_turn

# the block helpers travel with each task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIM_DIGITS = 6
TILE_IDS = 2048
MIN_TILE_IDS = 256
SPREAD_TILES = 8
FEW_TILES = 16
MOST_LONG_IDS = 1000
TASK_ROWS = 1_000_000
SLICE_PRODUCTS = 500_000
DENSE_FEATURES = 512
TILE_ENTRIES = 1_000_000
SPARSE_SHARE = 16
MOST_PACKED_FEATURES = 4096
PACKED_TILES = 16
PACKED_ENTRIES = 8_000_000
PIECE_ENTRIES = 500_000
STRETCH_ROWS = 2048


def unit_rows(vectors: DataFrame) -> DataFrame:
    """Scale every row to length one; rows without weight disappear."""
    lengths = vectors.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    return vectors.join(lengths.where("length > 0"), "id").select(
        "id", "feature", (F.col("weight") / F.col("length")).alias("weight")
    )


def similar_to(vectors: DataFrame, target) -> DataFrame:
    """(id, sim) of every row to row ``target``, itself and zeros included.

    The target's row is stored first: by its true size the planner sends it to all
    tasks, or shuffles if it is long.
    """
    wanted = materialize(vectors.where(F.col("id") == F.lit(target)), "target")
    length = wanted.agg(F.sqrt(F.sum(F.col("weight") * F.col("weight")))).scalar()
    product = F.coalesce(F.sum(F.col("weight") * F.col("other")), F.lit(0.0))
    own = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    sims = (
        vectors.join(wanted.select("feature", F.col("weight").alias("other")), "feature", "left")
        .groupBy("id")
        .agg(product.alias("product"), own.alias("own"))
        .select("id", F.try_divide("product", F.col("own") * length).alias("sim"))
    )
    return sims.select("id", F.round(F.coalesce("sim", F.lit(0.0)), SIM_DIGITS).alias("sim"))


def similar_to_each(vectors: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, id, sim) of every row that shares a feature with one of the ``targets`` (target), itself included."""
    lengths = vectors.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    lengths = materialize(lengths.where("length > 0"), "lengths")
    wanted = vectors.join(targets.select(F.col("target").alias("id")), "id", "left_semi")
    wanted = materialize(wanted.select(F.col("id").alias("target"), "feature", F.col("weight").alias("other")), "targets")
    products = vectors.join(wanted, "feature").groupBy("target", "id").agg(
        F.sum(F.col("weight") * F.col("other")).alias("product")
    )
    own, other = lengths.toDF("id", "own"), lengths.toDF("target", "theirs")
    sim = F.round(F.col("product") / (F.col("own") * F.col("theirs")), SIM_DIGITS).alias("sim")
    return products.join(own, "id").join(other, "target").select("target", "id", sim)


def _tile_count(n_ids: int, tile_ids: int) -> int:
    spread = min(SPREAD_TILES, -(-n_ids // MIN_TILE_IDS))
    return max(1, spread, -(-n_ids // tile_ids))


def _multiply(left: pd.DataFrame, right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense products of two sparse blocks: (left ids, right ids, matrix)."""
    left_ids, left_row = np.unique(left["id"].to_numpy(), return_inverse=True)
    right_ids, right_row = np.unique(right["id"].to_numpy(), return_inverse=True)
    both, _ = pd.factorize(pd.concat([left["feature"], right["feature"]], ignore_index=True))
    n_features = int(both.max()) + 1 if len(both) else 0
    lf, rf = both[: len(left)], both[len(left):]
    lo, ro = np.argsort(lf, kind="stable"), np.argsort(rf, kind="stable")
    lf, left_row, lw = lf[lo], left_row[lo], left["weight"].to_numpy()[lo]
    rf, right_row, rw = rf[ro], right_row[ro], right["weight"].to_numpy()[ro]
    in_left = np.bincount(lf, minlength=n_features)
    in_right = np.bincount(rf, minlength=n_features)
    shape = (len(left_ids), len(right_ids))
    product = np.zeros(shape)

    # features that fill much of the block: dense matrix products
    heavy = np.flatnonzero(in_left * in_right > shape[0] * shape[1] / 256)
    place = np.full(n_features, -1)
    for start in range(0, len(heavy), DENSE_FEATURES):
        batch = heavy[start: start + DENSE_FEATURES]
        place[:] = -1
        place[batch] = np.arange(len(batch))
        sides = []
        for feature, row, weight, n in ((lf, left_row, lw, shape[0]), (rf, right_row, rw, shape[1])):
            at = place[feature]
            used = at >= 0
            dense = np.zeros((len(batch), n))
            dense[at[used], row[used]] = weight[used]
            sides.append(dense)
        product += sides[0].T @ sides[1]

    # the rest: one product per shared entry, a bounded slice at a time
    light = np.ones(n_features, bool)
    light[heavy] = False
    keep = light[lf] & (in_right[lf] > 0)
    lf, left_row, lw = lf[keep], left_row[keep], lw[keep]
    partners = in_right[lf]
    first = (np.cumsum(in_right) - in_right)[lf]
    ends = np.cumsum(partners)
    flat = product.ravel()
    start = 0
    while start < len(lf):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_PRODUCTS, side="right")))
        n = partners[start:stop]
        entry = np.repeat(np.arange(start, stop), n)
        offset = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
        partner = first[entry] + offset
        np.add.at(flat, left_row[entry] * shape[1] + right_row[partner], lw[entry] * rw[partner])
        start = stop
    return left_ids, right_ids, product


def _best(rows: np.ndarray, columns: np.ndarray, sims: np.ndarray, k: int, itself: bool) -> pd.DataFrame:
    """The ``k`` best positive entries of every matrix row, ties by column id."""
    steps = np.rint(sims * 10**SIM_DIGITS).astype(np.int64)
    if itself:
        np.fill_diagonal(steps, 0)
    n = len(columns)
    order = steps * n + (n - 1 - np.arange(n))
    if k < n:
        chosen = np.argpartition(order, n - k, axis=1)[:, n - k:]
    else:
        chosen = np.broadcast_to(np.arange(n), steps.shape)
    values = np.take_along_axis(steps, chosen, axis=1)
    r, c = np.nonzero(values > 0)
    return pd.DataFrame(
        {"id": rows[r], "neighbor": columns[chosen[r, c]], "sim": values[r, c] / 10.0**SIM_DIGITS}
    )


@dataclass
class Layout:
    """Hashed tiles 0 .. ``hashed`` - 1, one more tile per long id, and the chunks of every tile."""

    hashed: int
    long_ids: DataFrame | None
    chunks: list[int]

    def place(self, vectors: DataFrame) -> DataFrame:
        tile = F.pmod(F.xxhash64("id"), F.lit(self.hashed)).cast("int")
        if self.long_ids is None:
            return vectors.withColumn("tile", tile)
        own = vectors.join(F.broadcast(self.long_ids), "id", "left")  # at most MOST_LONG_IDS rows
        return own.withColumn("tile", F.coalesce("own_tile", tile)).drop("own_tile")


def _cheapest(n_ids: int, total: int, n_long: int, long_rows: int, tile_ids: int, task_rows: int) -> tuple[int, bool]:
    """(hashed tiles, whether long ids get their own), such that the fewest rows and parts of pairs are moved.

    A row travels to every tile; a pair of ids has a part in each chunk of its tile pair, and counts for both of its ids.
    Tiles are taken as cut when they are half full, since hashing does not fill them evenly.
    """
    least = _tile_count(n_ids, tile_ids)
    counts, whole = [least], max(least, -(-4 * total // task_rows))
    if n_ids > FEW_TILES * tile_ids:  # parts of so many pairs are never the less
        return whole, n_long > 0
    while counts[-1] < whole:
        counts.append(min(2 * counts[-1], whole))

    def parts(rows: int, tiles: int) -> float:
        chunks = -(-4 * rows // (tiles * task_rows))
        return n_ids * n_ids * chunks if chunks > 1 else 0

    def cost(tiles: int, own: bool) -> float:
        n_own = min(n_long, MOST_LONG_IDS)
        if own:
            return total * (tiles + n_own) + parts(total - long_rows, tiles)
        # the tile of a long id is cut as often as its rows ask for
        return total * tiles + parts(total, tiles) + n_ids * n_ids / tiles * min(n_long, tiles) * (2 * long_rows // max(1, n_long * task_rows))

    return min(((tiles, own) for tiles in counts for own in ({False, n_long > 0})), key=lambda x: (cost(*x), x))


def _layout(vectors: DataFrame, tile_ids: int, task_rows: int) -> Layout:
    """Tiles and chunks such that a task holds about ``task_rows`` rows of two tiles.

    The denser the rows, the fewer ids a tile has, so that tiles need not be cut and no pair is written that is
    not among the best of its tile pair; unless the ids are so few that to cut by feature and add up their pairs moves less.
    An id with very many rows may get a tile of its own, cut into chunks by feature:
    adding up the chunks of one id's products is cheap. Should there be more long
    ids than that, their hashed tiles are cut in the same way.
    """
    sizes = vectors.groupBy("id").agg(F.count("*").alias("n"))
    is_long = F.col("n") > task_rows // 4
    n_ids, total, n_long, long_rows = sizes.agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(is_long), F.coalesce(F.sum(F.when(is_long, F.col("n"))), F.lit(0))
    ).first()
    hashed, own = _cheapest(n_ids, total, n_long, long_rows, tile_ids, task_rows)
    long_ids = None
    if own:
        first = sizes.where(is_long).orderBy(F.desc("n"), "id").limit(MOST_LONG_IDS).collect()
        kind = vectors.schema["id"].dataType.simpleString()
        rows = [(row["id"], hashed + i) for i, row in enumerate(first)]
        long_ids = vectors.sparkSession.createDataFrame(rows, f"id {kind}, own_tile int")
    layout = Layout(hashed, long_ids, [])
    layout.chunks = [1] * (hashed + (len(rows) if long_ids is not None else 0))
    for row in layout.place(vectors).groupBy("tile").count().collect():
        layout.chunks[row["tile"]] = max(1, -(-2 * row["count"] // task_rows))
    return layout


def _tiled(vectors: DataFrame, layout: Layout) -> DataFrame:
    """Send every row to the tile pairs (a <= b) where its feature can meet another row.

    A pair is cut by feature into as many chunks as its fuller tile asks for.
    """
    n_tiles = len(layout.chunks)
    placed = layout.place(vectors).select("id", "feature", "weight", "tile")
    if n_tiles <= FEW_TILES:
        sent = placed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    else:
        met = placed.groupBy("feature").agg(F.collect_set("tile").alias("tiles"))
        sent = placed.join(met, "feature").withColumn("partner", F.explode("tiles"))
    per_tile = F.lit(layout.chunks)
    n_chunks = F.greatest(per_tile[F.col("tile")], per_tile[F.col("partner")])
    return sent.select(
        F.least("tile", "partner").alias("a"), F.greatest("tile", "partner").alias("b"),
        n_chunks.alias("chunks"), F.pmod(F.xxhash64("feature"), n_chunks).alias("chunk"),
        "tile", "id", "feature", "weight",
    )


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    a, b = group["a"].iat[0], group["b"].iat[0]
    if a == b:
        return group, group, True
    return group[group["tile"] == a], group[group["tile"] == b], False


def _products(tiled: DataFrame, split: bool) -> DataFrame:
    """(left, right, product) of all pairs of a tiled frame, each pair once, left <= right."""
    kind = tiled.schema["id"].dataType
    out = T.StructType([
        T.StructField("left", kind), T.StructField("right", kind), T.StructField("product", T.DoubleType())
    ])

    def products(group: pd.DataFrame) -> pd.DataFrame:
        left, right, itself = _sides(group)
        rows, columns, matrix = _multiply(left, right)
        r, c = np.nonzero(np.triu(matrix) if itself else matrix)
        one, two = rows[r], columns[c]
        swap = one > two
        return pd.DataFrame(
            {"left": np.where(swap, two, one), "right": np.where(swap, one, two), "product": matrix[r, c]}
        )

    pairs = tiled.groupBy("a", "b", "chunk").applyInPandas(products, out)
    return pairs.groupBy("left", "right").agg(F.sum("product").alias("product")) if split else pairs


def pair_products(vectors: DataFrame, tile_ids: int = TILE_IDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(left, right, product) of all pairs with a product, each pair once, left <= right.

    For few ids: the result has a row per pair. ``vectors`` is read several times:
    hand over a materialised table with unique (id, feature).
    """
    layout = _layout(vectors, tile_ids, task_rows)
    return _products(_tiled(vectors, layout), max(layout.chunks) > 1)


def _sparse_tiles(vectors: DataFrame, tile_ids: int) -> int:
    """The number of tiles of at most TILE_ENTRIES rows, if there are many ids, none of more rows, and few products beside all pairs; else 0."""
    sizes = vectors.groupBy("id").agg(F.count("*").alias("n"))
    n_ids, total, longest = sizes.agg(F.count("id"), F.sum("n"), F.max("n")).first()
    if n_ids <= FEW_TILES * tile_ids or longest > TILE_ENTRIES:
        return 0
    sizes = vectors.groupBy("feature").agg(F.count("*").cast("double").alias("n"))
    products = sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    return max(SPREAD_TILES, -(-total // TILE_ENTRIES)) if products * SPARSE_SHARE <= n_ids * n_ids else 0


def _to_pairs(rows: DataFrame, n_tiles: int, feature: str | None = None) -> DataFrame:
    """Every row for each pair of its tile with another, or of the tiles where its ``feature`` occurs.

    ``pair`` numbers the pairs of tiles, ``second`` tells the rows of the greater tile.
    """
    placed = rows.withColumn("tile", F.pmod(F.xxhash64("id"), F.lit(n_tiles)).cast("int"))
    if feature is None or n_tiles <= FEW_TILES:
        sent = placed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    else:
        met = placed.groupBy(feature).agg(F.collect_set("tile").alias("tiles"))
        sent = placed.join(met, feature).withColumn("partner", F.explode("tiles"))
    pair = F.least("tile", "partner").cast("long") * n_tiles + F.greatest("tile", "partner")
    return sent.select(pair.alias("pair"), (F.col("tile") > F.col("partner")).alias("second"), *rows.columns)


def _ranked(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The place of every value among the sorted distinct ones, and these."""
    coded = column.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def _first_of_rows(row: np.ndarray, column: np.ndarray, steps: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The entries with the ``k`` largest ``steps`` of every row, ties by column; rows come in order.

    A row is first cut into k stretches: what is below the least of their largest entries is not among the k largest.
    """
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
    n = np.diff(np.append(heads, len(row)))
    long = n >= 4 * k
    if long.any():
        starts = heads[long, None] + n[long, None] * np.arange(k) // k
        least = np.zeros(len(n), np.int64)
        ends = np.append(starts[:, 1:], (heads + n)[long, None], axis=1)
        bounds = np.stack([starts, ends], axis=2).ravel()
        largest = np.maximum.reduceat(np.append(steps, 0), bounds)[::2]
        least[long] = largest.reshape(starts.shape).min(1)
        kept = steps >= np.repeat(least, n)
        row, column, steps = row[kept], column[kept], steps[kept]
    order = np.lexsort((column, -steps, row))
    row, column, steps = row[order], column[order], steps[order]
    first = np.searchsorted(row, row, "left")
    kept = np.arange(len(row)) - first < k
    return row[kept], column[kept], steps[kept]


def _sparse_best(left: tuple, right: tuple, n_right: int, k: int, itself: bool) -> tuple[np.ndarray, ...]:
    """(row, column, steps): the ``k`` best positive products of every row of ``left`` with rows of ``right``.

    Sides are (row, feature, weight).
    """
    order = np.argsort(right[1], kind="stable")
    right_row, rf, rw = (part[order] for part in right)
    n_features = int(max(left[1].max(initial=-1), rf.max(initial=-1))) + 1
    in_right = np.bincount(rf, minlength=n_features)
    order = np.argsort(left[0], kind="stable")
    left_row, lf, lw = (part[order] for part in left)
    return _row_products((left_row, lw), (np.cumsum(in_right) - in_right)[lf], in_right[lf], (right_row, rw), n_right, k, itself)


def _row_products(
    left: tuple, before: np.ndarray, partners: np.ndarray, right: tuple, n_right: int, k: int, itself: bool, limit: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(row, column, steps): the ``k`` best positive products of every row of ``left``, below the row's ``limit`` left out.

    Sides are (row, weight), the left one row by row; an entry meets ``partners`` entries of the right from ``before`` on.
    Whole rows are multiplied at a time, about SLICE_PRODUCTS products of entries.
    """
    met = partners > 0
    (left_row, lw), (right_row, rw) = (part[met] for part in left), right
    before, partners = before[met], partners[met]
    ends = np.cumsum(partners)

    def products(start: int, stop: int, low: int) -> tuple[np.ndarray, np.ndarray]:
        n = partners[start:stop]
        entry = np.repeat(np.arange(start, stop), n)
        partner = before[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
        return (left_row[entry] - low) * n_right + right_row[partner], lw[entry] * rw[partner]

    found, start = [], 0
    while start < len(lw):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_PRODUCTS, "right")))
        if stop < len(lw) and left_row[stop] == left_row[stop - 1]:  # back to the end of a row, if there is one
            head = int(np.searchsorted(left_row, left_row[stop], "left"))
            stop = head if head > start else int(np.searchsorted(left_row, left_row[start], "right"))
        low, n_cells = int(left_row[start]), (int(left_row[stop - 1]) - int(left_row[start]) + 1) * n_right
        n_products = ends[stop - 1] - done
        if n_products > SLICE_PRODUCTS or (n_cells <= SLICE_PRODUCTS and 4 * n_products >= n_cells):
            sums, at = np.zeros(n_cells), start
            while at < stop:
                upto = max(at + 1, int(np.searchsorted(ends[:stop], (ends[at - 1] if at else 0) + SLICE_PRODUCTS, "right")))
                key, value = products(at, upto, low)
                sums += np.bincount(key, value, minlength=n_cells)
                at = upto
            key = np.flatnonzero(sums > 0)
            sums = sums[key]
        else:
            key, value = products(start, stop, low)
            order = np.argsort(key)
            key = key[order]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, sums = key[heads], np.add.reduceat(value[order], heads)
        steps = np.rint(sums * 10**SIM_DIGITS).astype(np.int64)
        row, column = key // n_right + low, key % n_right
        kept = steps > 0
        if itself:
            kept &= row != column
        if limit is not None:
            kept &= steps >= limit[row]
        found.append(_first_of_rows(row[kept], column[kept], steps[kept], k))
        start = stop
    return tuple(np.concatenate([part[j] for part in found]) if found else np.zeros(0, np.int64) for j in range(3))


def _named(ids: pa.Array, others: pa.Array, found: tuple[np.ndarray, ...]) -> pa.Table:
    row, column, steps = found
    return pa.table({"id": ids.take(pa.array(row)), "neighbor": others.take(pa.array(column)), "sim": steps / 10.0**SIM_DIGITS})


def stored_bytes(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("values", values.type)])) as stream:
        stream.write_batch(pa.record_batch([values], ["values"]))
    return sink.getvalue().to_pybytes()


def stored_values(stored: pa.Buffer) -> pa.Array:
    return pa.ipc.open_stream(stored).read_next_batch().column(0)


def _packed_tile(table: pa.Table) -> pa.Table:
    """One row for a tile: its sorted ids, its features, and its entries of unit rows by row and by feature.

    Entries (feature or row, weight) are one stretch per row or feature, which begins at its head.
    """
    place, ids = _ranked(table.column("id"))
    weight = table.column("weight").to_numpy()
    length = np.sqrt(np.bincount(place, weight * weight, len(ids)))
    coded = table.column("feature").combine_chunks().dictionary_encode()
    used = coded.indices.is_valid().to_numpy(zero_copy_only=False) & ((length > 0) | np.isnan(length))[place]
    place, weight = place[used], weight[used] / length[place[used]]
    code = coded.indices.fill_null(0).to_numpy()[used]
    blobs = {"tile": pa.array(table.column("tile").to_pylist()[:1], pa.int32())}
    blobs |= {name: pa.array([stored_bytes(values)], pa.binary()) for name, values in (("ids", ids), ("features", coded.dictionary))}
    for name, whole, part, n in (("by_row", place, code, len(ids)), ("by_feature", code, place, len(coded.dictionary))):
        order = np.argsort(whole, kind="stable")
        heads = np.concatenate([[0], np.cumsum(np.bincount(whole, minlength=n))]).astype(np.int32)
        blob = b"".join(x.tobytes() for x in (heads, part[order].astype(np.int32), weight[order]))
        blobs[name] = pa.array([blob], pa.binary())
    return pa.table(blobs)


def _entries(blob: pa.Buffer, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(heads, places, weights) of the n stretches of a packed tile."""
    size = (len(blob) - 4 * (n + 1)) // 12
    heads, places = np.frombuffer(blob, np.int32, n + 1), np.frombuffer(blob, np.int32, size, 4 * (n + 1))
    return heads, places, np.frombuffer(blob, np.float64, size, 4 * (n + 1) + 4 * size)


class _Nearest:
    """The best neighbours of the rows of a packed tile, as far as its products with other tiles are known.

    Ids of several tiles are not compared here: what equals a row's k-th similarity stays.
    """

    def __init__(self, ids: pa.Array, features: pa.Array, by_row: pa.Buffer, k: int):
        self.ids, self.features, self.k = ids, features, k
        self.heads, self.code, self.weight = _entries(by_row, len(ids))
        self.cuts = np.unique(np.append(np.searchsorted(self.heads, np.arange(0, len(self.code), SLICE_PRODUCTS // 4)), len(ids)))
        self.limit = np.ones(len(ids), np.int64)
        self.row_steps, self.neighbor, self.fresh = (np.zeros(0, np.int64),) * 2, ids[:0], []

    def meet(self, others: pa.Array, features: pa.Array, by_feature: pa.Buffer, itself: bool) -> None:
        heads, places, weight = _entries(by_feature, len(features))
        there = pc.index_in(self.features, value_set=features)
        known = there.is_valid().to_numpy(zero_copy_only=False)
        there = there.drop_null().to_numpy()
        before, partners = np.zeros((2, len(known)), np.int32)
        before[known], partners[known] = heads[there], heads[there + 1] - heads[there]
        for low, high in zip(self.cuts[:-1], self.cuts[1:]):
            some = slice(self.heads[low], self.heads[high])
            row, code = np.repeat(np.arange(low, high), np.diff(self.heads[low : high + 1])), self.code[some]
            left, met = (row, self.weight[some]), (before[code].astype(np.int64), partners[code].astype(np.int64))
            row, column, steps = _row_products(left, *met, (places, weight), len(others), self.k, itself, self.limit)
            self.fresh.append((row, steps, others.take(pa.array(column))))
        if sum(len(steps) for _, steps, _ in self.fresh) > self.k * len(self.ids):
            self._cut()

    def _cut(self) -> None:
        row, steps = (np.concatenate(parts) for parts in zip(self.row_steps, *((row, steps) for row, steps, _ in self.fresh)))
        neighbor = pa.concat_arrays([self.neighbor, *(names for _, _, names in self.fresh)])
        order = np.lexsort((-steps, row))
        row, steps = row[order], steps[order]
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row, "left") == self.k - 1)
        self.limit[row[last]] = steps[last]
        kept = steps >= self.limit[row]
        self.row_steps, self.neighbor, self.fresh = (row[kept], steps[kept]), neighbor.take(pa.array(order[kept])), []

    def named(self) -> pa.Table:
        self._cut()
        row, steps = self.row_steps
        return pa.table({"id": self.ids.take(pa.array(row)), "neighbor": self.neighbor, "sim": steps / 10.0**SIM_DIGITS})


def _sparse_neighbors(vectors: DataFrame, k: int, n_tiles: int) -> DataFrame:
    """(id, neighbor, sim) with the ``k`` best other rows of every row among them.

    The tiles are stored once; a task reads those that its own tile meets, one after the other, and nothing is shuffled for it.
    """
    kind = vectors.schema["id"].dataType.simpleString()
    known = vectors.where(F.col("id").isNotNull() & F.col("weight").isNotNull())
    tile = F.pmod(F.xxhash64("id"), F.lit(n_tiles)).cast("int").alias("tile")
    rows = known.select(tile, "id", "feature", F.col("weight").cast("double").alias("weight"))
    packed = rows.groupBy("tile").applyInArrow(_packed_tile, "tile int, ids binary, features binary, by_row binary, by_feature binary")
    packed = materialize(packed, "packed-tiles", compression="none")  # nothing but large values, read many times
    filled = {row["tile"] for row in packed.select("tile").collect()}

    def neighbors(batches):
        nearest = None
        for batch in batches:
            for j in range(len(batch)):
                own, tile, at = (batch.column(name)[j].as_py() for name in ("own", "tile", "at"))
                ids, features, entries = (batch.column(name)[j].as_buffer() for name in ("ids", "features", "entries"))
                if own:
                    if nearest:
                        yield from nearest.named().to_batches()
                    ids, features, entries = (pa.py_buffer(blob.to_pybytes()) for blob in (ids, features, entries))
                    nearest = _Nearest(stored_values(ids), stored_values(features), entries, k)
                elif nearest:
                    nearest.meet(stored_values(ids), stored_values(features), entries, tile == at)
                else:
                    raise RuntimeError("a tile came before the task's own")
        if nearest:
            yield from nearest.named().to_batches()

    def pairs(packed: DataFrame) -> DataFrame:
        def role(own: bool, entries: str) -> DataFrame:
            return packed.select(F.lit(own).alias("own"), "tile", "ids", "features", F.col(entries).alias("entries"))

        others = role(False, "by_feature")
        tasks = ([role(True, "by_row").where(F.col("tile") == at), others] for at in sorted(filled))
        return read_in_turn([[table.withColumn("at", F.lit(at)) for table in tables] for at, tables in zip(sorted(filled), tasks)])

    found = materialize_with(packed, lambda tiles: pairs(tiles).mapInArrow(neighbors, f"id {kind}, neighbor {kind}, sim double"), "tile-neighbors")
    discard(packed)
    return found


def _packed_width(vectors: DataFrame, tile_ids: int) -> tuple[int, int]:
    """(number of rows, number of features) if there are many ids, and most of few features in most of them; else (0, 0)."""
    n_ids, n_features, total = vectors.agg(F.count_distinct("id"), F.count_distinct("feature"), F.count("*")).first()
    packed = n_ids > tile_ids and n_features <= MOST_PACKED_FEATURES and 2 * total >= n_ids * n_features
    return (total, n_features) if packed else (0, 0)


class _Best:
    """The best positive columns of a stretch of rows, as far as they are known."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.limit = n, k, np.full(n, 0.5 / 10**SIM_DIGITS)
        self.found = (np.zeros(0, np.int64),) * 3

    def add(self, sims: np.ndarray, first: int) -> None:
        """``sims`` of the rows with the columns from ``first`` on."""
        near, width = sims >= self.limit[:, None] - 1e-12, sims.shape[1]
        if np.count_nonzero(near) > 8 * self.k * self.n and self.k < width:
            order = np.rint(sims * 10**SIM_DIGITS) * width - np.arange(width)
            column = np.argpartition(order, width - self.k, axis=1)[:, width - self.k:].ravel()
            row = np.repeat(np.arange(self.n), self.k)
        else:
            row, column = np.nonzero(near)
        steps = np.rint(sims[row, column] * 10**SIM_DIGITS).astype(np.int64)
        kept = steps > 0
        if not kept.any():
            return
        new = (row[kept], column[kept] + first, steps[kept])
        row, column, steps = (np.concatenate(parts) for parts in zip(self.found, new))
        order = np.lexsort((column, -steps, row))
        row, column, steps = row[order], column[order], steps[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        last = rank == self.k - 1
        self.limit[row[last]] = (steps[last] - 0.5) / 10**SIM_DIGITS
        self.found = tuple(part[rank < self.k] for part in (row, column, steps))


def _packed_best(x: np.ndarray, y: np.ndarray, k: int, itself: bool) -> tuple[tuple, tuple]:
    """(row, column, steps) of the ``k`` best rows of y for every row of x, and of x for every row of y; the first only if ``itself``."""
    cut = [[slice(at, min(at + STRETCH_ROWS, len(side))) for at in range(0, len(side), STRETCH_ROWS)] for side in (x, y)]
    ours = [_Best(some.stop - some.start, k) for some in cut[0]]
    theirs = ours if itself else [_Best(some.stop - some.start, k) for some in cut[1]]
    for a, some in enumerate(cut[0]):
        for b, others in enumerate(cut[1]):
            if itself and b < a:
                continue
            sims = x[some] @ y[others].T
            if itself and a == b:
                np.fill_diagonal(sims, 0.0)
            ours[a].add(sims, others.start)
            if not (itself and a == b):
                theirs[b].add(np.ascontiguousarray(sims.T), some.start)

    def joined(bests: list, slices: list) -> tuple:
        parts = [(best.found[0] + some.start, *best.found[1:]) for best, some in zip(bests, slices)]
        return tuple(np.concatenate([part[j] for part in parts]) if parts else np.zeros(0, np.int64) for j in range(3))

    return joined(ours, cut[0]), joined([] if itself else theirs, cut[1])


def _packed_neighbors(rows: DataFrame, k: int, total: int, width: int) -> DataFrame:
    """(id, neighbor, sim) with the ``k`` best of every tile pair among them; a row travels as one array of doubles."""
    kind = rows.schema["id"].dataType.simpleString()
    n_tiles = max(PACKED_TILES, -(-total // PACKED_ENTRIES))
    features = rows.select("feature").distinct()  # at most MOST_PACKED_FEATURES
    places = features.select("feature", (F.row_number().over(Window.orderBy("feature")) - 1).alias("place"))

    def packed(table: pa.Table) -> pa.Table:
        row, ids = _ranked(table.column("id"))
        x = np.zeros((len(ids), width))
        x[row, table.column("place").to_numpy()] = np.nan_to_num(table.column("weight").to_numpy())
        return pa.table({"id": ids, "x": pa.array([line.tobytes() for line in x], pa.binary())})

    def neighbors(table: pa.Table) -> pa.Table:
        second = table.column("second").to_numpy()
        sides = []
        for chosen in (~second, second):
            side = table.filter(pa.array(chosen))
            place, ids = _ranked(side.column("id"))
            x = np.zeros((len(ids), width))
            x[place] = np.frombuffer(b"".join(side.column("x").to_pylist()), np.float64).reshape(-1, width)
            sides.append((ids, x))
        (ids, x), (others, y) = sides
        if table.column("pair")[0].as_py() % (n_tiles + 1) == 0:  # a tile with itself
            return _named(ids, ids, _packed_best(x, x, k, True)[0])
        ours, theirs = _packed_best(x, y, k, False)
        return pa.concat_tables([_named(ids, others, ours), _named(others, ids, theirs)])

    piece = F.pmod(F.xxhash64("id"), F.lit(-(-total // PIECE_ENTRIES))).alias("piece")
    cells = rows.join(F.broadcast(places), "feature").select(piece, "id", "place", "weight")
    arrays = cells.groupBy("piece").applyInArrow(packed, f"id {kind}, x binary")
    return _to_pairs(arrays, n_tiles).groupBy("pair").applyInArrow(neighbors, f"id {kind}, neighbor {kind}, sim double")


def top_similar(vectors: DataFrame, k: int, tile_ids: int = TILE_IDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, neighbor, sim, rank): the ``k`` most similar other rows of every row.

    Only positive similarities count. Tasks that see all of a tile pair keep its
    best neighbours at once; where a pair had to be cut, the parts are added up
    first. Many rows with few features in common, and many that have most of a few
    features, go by larger tiles. ``vectors`` is read several times: hand over a
    materialised table with unique (id, feature).
    """
    order = [F.desc("sim"), F.col("neighbor")]
    if n_tiles := _sparse_tiles(vectors, tile_ids):
        return top_rows(_sparse_neighbors(vectors, k, n_tiles), ["id"], order, k)
    total, width = _packed_width(vectors, tile_ids)
    if total:
        return top_rows(_packed_neighbors(unit_rows(vectors), k, total, width), ["id"], order, k)
    layout = _layout(vectors, tile_ids, task_rows)
    tiled = _tiled(unit_rows(vectors), layout)
    kind = vectors.schema["id"].dataType
    out = T.StructType([
        T.StructField("id", kind), T.StructField("neighbor", kind), T.StructField("sim", T.DoubleType())
    ])

    def neighbors(group: pd.DataFrame) -> pd.DataFrame:
        left, right, itself = _sides(group)
        rows, columns, sims = _multiply(left, right)
        found = _best(rows, columns, sims, k, itself)
        return found if itself else pd.concat([found, _best(columns, rows, sims.T, k, False)])

    pairs = tiled.where("chunks = 1").groupBy("a", "b", "chunk").applyInPandas(neighbors, out)
    if max(layout.chunks) > 1:
        sims = (
            _products(tiled.where("chunks > 1"), True)
            .where(F.col("left") != F.col("right"))
            .withColumn("sim", F.round("product", SIM_DIGITS))
            .where("sim > 0")
        )
        ends = F.array(
            F.struct(F.col("left").alias("id"), F.col("right").alias("neighbor")),
            F.struct(F.col("right").alias("id"), F.col("left").alias("neighbor")),
        )
        pairs = pairs.unionByName(sims.select(F.explode(ends).alias("p"), "sim").select("p.*", "sim"))
    return top_rows(pairs, ["id"], order, k)


def array_vectors(df: DataFrame, key: str, vector: Column) -> DataFrame:
    """(key, ARRAY) -> (id, feature, weight) with the position as feature."""
    return df.select(F.col(key).alias("id"), F.posexplode(vector).alias("feature", "weight")).select(
        "id", "feature", F.col("weight").cast("double").alias("weight")
    )
