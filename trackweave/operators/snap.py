"""Snapping of candidates to existing position points.

`nearest` is stateless: every candidate looks up the nearest existing point in its own and the
neighbouring cells (an equi-join on cells, then the exact distance). `snap` is the incremental form: it
goes through the priorities and, within each, through the four colours of the grid, so that cells that
touch are never worked on together and see each other's new points. Within a cell the edges are taken in
order of uuid_edge; the points that an edge creates are visible to the next one, not to itself.

What happens in a cell depends on its neighbours in earlier rounds only, so a block of cells needs no more
than a margin of one cell for each round before the last. Blocks with their margins are worked on
independently, with one shuffle for all rounds of up to `PRIORITIES` priorities; results in the margin are
dropped. In a block, every round takes the first edges of all its cells together, then the second ones, and
so on, by array operations.

Candidates travel packed: one row for those of an edge, a priority and a tile of `TILE` x `TILE` cells, with
the values of each column as the bytes of an array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells, crs, ids
from ..functions import geometry as g
from ..plans.store import cut

RADIUS = 0.25
HEIGHT_TOLERANCE = 1.0
#: Priorities of one pass (four rounds each, which set the margin of a block).
PRIORITIES = 2
#: Cells along a block's side: the first with no more than BLOCK_ROWS candidates in any block, or the last.
SIDES = (128, 64, 32, 16, 8)
BLOCK_ROWS = 200_000
#: Candidates, without margins, of one task of a pass on average, at most.
TASK_ROWS = 1 << 20
#: Cells along a tile's side; it divides every block's side.
TILE = 8
#: Candidates that are packed together.
PACK_ROWS = 1 << 18
#: What a round needs of a candidate, and what else goes into a result (`nulls` has a bit for each).
_NEEDED = {"edge_idx": "<i4", "x": "<f8", "y": "<f8", "z": "<f8", "cell": "<i8"}
_CARRIED = {"position": "<f8", "zoom": "<i4", "azimuth": "<f8"}
PP = "id_positionpoint long, zoom int, cell long, x double, y double, z double, azimuth double"
_RESULT = f"uuid_edge string, edge_idx int, position double, prio int, zoom int, x double, y double, z double, azimuth double, snapped struct<{PP.replace(' ', ':').replace(',:', ',')}>, is_new_pp boolean"
_COUNTED = "prio int, is_new_pp boolean, candidates long, points long, id_positionpoint long"


def nearest(candidates: DataFrame, existing: DataFrame, radius: float = RADIUS, height: float = HEIGHT_TOLERANCE, size: float = cells.SIZE) -> DataFrame:
    """`candidates` (x, y, z) with the nearest row of `existing` (id, x, y, z) closer than `radius` and within
    `height`: nearest_id and nearest_distance, null if there is none. Ties go to the smaller id."""
    c = candidates.withColumns({"_row": F.monotonically_increasing_id(), "_cell": F.expr(cells.cell("x", "y", size))})
    near = existing.select(F.struct("id", "x", "y", "z").alias("_e"), F.explode(cells.ring("x", "y", size)).alias("_cell"))
    gap = g.distance("named_struct('x', x, 'y', y)", "_e")
    # a missing height (NaN) is no reason against a point
    level = f"(isnan(z) OR isnan(_e.z) OR z IS NULL OR _e.z IS NULL OR abs(z - _e.z) <= {height}D)"
    j = c.join(near, "_cell", "left").withColumn("_d", F.expr(f"CASE WHEN {level} AND {gap} < {radius}D THEN {gap} END"))
    best = F.min(F.when(F.col("_d").isNotNull(), F.struct("_d", "_e.id"))).alias("_b")
    per = j.groupBy("_row", *[F.col(x) for x in candidates.columns]).agg(best)
    return per.select(*candidates.columns, F.col("_b.id").alias("nearest_id"), F.col("_b._d").alias("nearest_distance"))


class _Visible:
    """Entries that candidates can snap to, sorted by squares of the radius' size; entries are added by number."""

    def __init__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, ids: np.ndarray, radius: float, height: float):
        self.x, self.y, self.z, self.ids, self.radius, self.height = x, y, z, ids, radius, height
        i, j = (np.floor(v / radius).astype(np.int64) for v in (x, y))
        self.width = int(np.ptp(j)) + 3
        self.square = (i - i.min() + 1) * self.width + j - j.min() + 1
        self.squares, self.entries = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, entries: np.ndarray) -> None:
        entries = entries[np.argsort(self.square[entries], kind="stable")]
        at = np.searchsorted(self.squares, self.square[entries])
        self.squares, self.entries = np.insert(self.squares, at, self.square[entries]), np.insert(self.entries, at, entries)

    def nearest(self, entries: np.ndarray) -> np.ndarray:
        """The nearest visible entry of each, the smaller id of equally near ones; -1 without any."""
        square = np.concatenate([self.square[entries] + d for d in (-self.width, 0, self.width)])
        low, high = np.searchsorted(self.squares, square - 1, "left"), np.searchsorted(self.squares, square + 1, "right")
        n = high - low
        own = np.repeat(np.tile(np.arange(len(entries)), 3), n)
        p = self.entries[np.arange(len(own)) + np.repeat(low - (np.cumsum(n) - n), n)]
        c = entries[own]
        gap, rise = np.hypot(self.x[p] - self.x[c], self.y[p] - self.y[c]), np.abs(self.z[p] - self.z[c])
        # a missing height (NaN) is no reason against a point
        fits = (gap < self.radius) & (~np.isfinite(self.z[p]) | ~np.isfinite(self.z[c]) | (rise <= self.height))
        own, p, gap = own[fits], p[fits], gap[fits]
        order = np.lexsort((self.ids[p], gap, own))
        own, p = own[order], p[order]
        out = np.full(len(entries), -1)
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[first]] = p[first]
        return out


def _cell_at(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return cell // (1 << 26) - cells.OFFSET, cell % (1 << 26) - cells.OFFSET


def _waves(prio: np.ndarray, cell: np.ndarray, edge: np.ndarray, idx: np.ndarray) -> list[np.ndarray]:
    """Candidates by round (priority, colour) and, in each, by their edge's place in its cell."""
    i, j = _cell_at(cell)
    colour = i % 2 * 2 + j % 2
    order = np.lexsort((idx, edge, cell, colour, prio))
    new_cell = (np.diff(prio[order], prepend=-1) != 0) | (np.diff(cell[order], prepend=-1) != 0)
    new_cell[0] = True
    nth = np.cumsum(new_cell | (np.diff(edge[order], prepend=-1) != 0))
    wave = nth - nth[np.flatnonzero(new_cell)][np.cumsum(new_cell) - 1]
    by_wave = np.lexsort((wave, colour[order], prio[order]))
    keys = [v[by_wave] for v in (prio[order], colour[order], wave)]
    starts = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
    return np.split(order[by_wave], starts)


def packer(counted: bool = False, size: float = cells.SIZE) -> tuple[Callable, str]:
    """What packs batches of candidates (for `rounds` if `counted`), and the schema of its rows.

    A row has the tile, edge and priority of its candidates, their number and, by field, the bytes of their values."""
    fields = _NEEDED if counted else _NEEDED | _CARRIED
    schema = "_ti long, _tj long, uuid_edge string, prio int, _n long, " + ", ".join(f"{f} binary" for f in [*fields, "nulls"])

    def place(v: pa.Array) -> np.ndarray:
        """Column or row of the cell, as in `cells.cell` (0 for NaN)."""
        at = np.floor(v.to_numpy().astype(np.float64) / size)
        at[np.isnan(at)] = 0
        if (np.abs(at) >= 1 << 36).any():
            raise ValueError("coordinates out of range")
        return at.astype(np.int64)

    def packed(table: pa.Table) -> pa.RecordBatch:
        column = lambda name: table[name].combine_chunks()
        i, j = place(column("x")), place(column("y"))
        cell = pa.array((i + cells.OFFSET) * (1 << 26) + j + cells.OFFSET)
        i, j = _cell_at(cell.to_numpy())
        text = column("uuid_edge").dictionary_encode()
        edge = pc.fill_null(text.indices, len(text.dictionary)).to_numpy()
        keys = [i // TILE, j // TILE, edge, column("prio").to_numpy()]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([np.diff(k) != 0 for k in keys])]))
        upto = np.append(starts, len(order))
        nulls, values = np.zeros(len(order), np.uint8), {}
        for bit, (f, kind) in enumerate(fields.items()):
            c = column(f) if f != "cell" else cell
            if c.null_count:
                nulls |= pc.is_null(c).to_numpy(zero_copy_only=False).astype(np.uint8) << bit
                c = pc.fill_null(c, 0)
            values[f] = c.to_numpy().astype(kind, copy=False)[order]
        values["nulls"] = nulls[order]
        as_bytes = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((upto * v.itemsize).astype(np.int32)), pa.py_buffer(v)]) for v in values.values()]
        name = column("uuid_edge").take(pa.array(order[starts]))
        head = [pa.array(keys[0][starts]), pa.array(keys[1][starts]), name, pa.array(keys[3][starts].astype(np.int32)), pa.array(np.diff(upto))]
        return pa.RecordBatch.from_arrays([*head, *as_bytes], ["_ti", "_tj", "uuid_edge", "prio", "_n", *values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield packed(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield packed(pa.Table.from_batches(held))

    return run, schema


def _values(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The values of packed rows, one after the other."""
    parts = []
    for c in column.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4) if len(c) else [0, 0]
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(c.buffers()[2], kind, (ends[-1] - ends[0]) // np.dtype(kind).itemsize, ends[0]))
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _unpack(packed: pa.Table, fields: dict[str, str], key: tuple, side: int, margin: int) -> tuple[pa.Table, pa.Array, np.ndarray]:
    """Candidates of a block and its margin, the names of edges and, for each candidate, the place of its edge's name."""
    cell = _values(packed["cell"], fields["cell"])
    at = [(v - k.as_py() * side) for v, k in zip(_cell_at(cell), key)]
    inside = np.flatnonzero(np.logical_and.reduce([(v >= -margin) & (v < side + margin) for v in at]))
    n = packed["_n"].to_numpy()
    nulls = _values(packed["nulls"], "u1")[inside]
    columns = {"prio": pa.array(np.repeat(packed["prio"].to_numpy(), n)[inside])}
    for bit, (f, kind) in enumerate(fields.items()):
        gone = nulls >> bit & 1
        columns[f] = pa.array(_values(packed[f], kind)[inside], mask=gone.astype(bool) if gone.any() else None)
    names = packed["uuid_edge"].combine_chunks().dictionary_encode()
    places = pc.fill_null(names.indices, len(names.dictionary)).to_numpy()
    return pa.table(columns), names.dictionary, np.repeat(places, n)[inside]


def _snap_block(radius: float, height: float, size: float, side: int, margin: int, fields: dict[str, str], counted: bool):
    def run(key: tuple, packed: pa.Table, known: pa.Table) -> pa.Table:
        names = ["edge_idx", "position", "prio", "zoom", "x", "y", "z", "azimuth"]
        new, text, place = _unpack(packed, fields, key, side, margin)
        # the known points, then the candidates
        carried = ["id_positionpoint", "zoom", "cell", "x", "y", "z", "azimuth"]
        both = {f: pa.chunked_array([*known[f].chunks, *new[f].chunks], known.schema.field(f).type).combine_chunks() for f in carried[1:] if f in fields}
        x, y, z, cell = (both[f].to_numpy(zero_copy_only=False) for f in ("x", "y", "z", "cell"))
        before, total = len(known), len(known) + len(new)
        ids_ = np.zeros(total, np.int64)
        ids_[:before] = known["id_positionpoint"].to_numpy()
        snapped, is_new = np.zeros(total, np.int64), np.zeros(total, bool)
        i, j = _cell_at(cell)
        core = (i // side == key[0].as_py()) & (j // side == key[1].as_py())
        core[:before] = False
        prio = new["prio"].to_numpy()
        if core.any():
            own, local = np.unique(cell[before:], return_inverse=True)
            used = np.zeros(len(own), np.int64)
            local = np.concatenate([np.zeros(before, np.int64), local])
            _, once = np.unique(ids_[:before], return_index=True)
            near = (np.abs(np.floor(x[once] / size) - i[once]) <= 1) & (np.abs(np.floor(y[once] / size) - j[once]) <= 1) & np.isin(cell[once], own)
            np.add.at(used, np.searchsorted(own, cell[once][near]), 1)
            rank = np.empty(len(text) + 1, np.int64)
            rank[pc.array_sort_indices(text).to_numpy()] = np.arange(len(text))
            rank[-1] = len(text)  # an edge without a name comes last
            visible = _Visible(x, y, z, ids_, radius, height)
            visible.add(np.arange(before))
            for wave in _waves(prio, cell[before:], rank[place], new["edge_idx"].to_numpy()):
                wave = wave + before  # sorted by cell
                best = visible.nearest(wave)
                found, made = best >= 0, wave[best < 0]
                snapped[wave[found]], snapped[made], is_new[made] = best[found], made, True
                at = local[made]
                number = used[at] + np.arange(len(at)) - np.searchsorted(at, at)
                if (full := (number >= ids.PER_CELL) & core[made]).any():
                    raise ValueError(f"too many points in cell {cell[made][full][0]}")
                np.add.at(used, at, 1)
                ids_[made] = (((cell[made].view(np.uint64) & np.uint64((1 << ids.CELL_BITS) - 1)) << np.uint64(12)) + number.astype(np.uint64)).view(np.int64)
                visible.add(made)  # from the next edge on
        kept = np.flatnonzero(core)
        to = snapped[kept]
        if counted:
            return _counted(prio[kept - before], is_new[kept], ids_[to])
        none = lambda f: pa.nulls(len(kept), pa.from_numpy_dtype(_CARRIED[f]))
        point = [pa.array(ids_[to]), *(both[f].take(pa.array(to)) if f in both else none(f) for f in carried[1:])]
        edge = place[kept - before]
        rows = new.take(pa.array(kept - before))
        uuid = text.take(pa.array(edge, mask=edge == len(text)))
        out = [uuid, *(rows[f] if f in rows.column_names else none(f) for f in names), pa.StructArray.from_arrays(point, carried), pa.array(is_new[kept])]
        return pa.table(out, names=["uuid_edge", *names, "snapped", "is_new_pp"])

    return run


def _alone(block):
    """`block` where no points are known."""
    kinds = {"id_positionpoint": pa.int64(), "zoom": pa.int32(), "cell": pa.int64(), **dict.fromkeys(("x", "y", "z", "azimuth"), pa.float64())}

    def run(key: tuple, packed: pa.Table) -> pa.Table:
        return block(key, packed, pa.schema(list(kinds.items())).empty_table())

    return run


def _counted(prio: np.ndarray, is_new: np.ndarray, to: np.ndarray) -> pa.Table:
    """By priority the new points, which no other block makes; by priority and point the candidates snapped to it."""
    out = []
    for p in np.unique(prio):
        new = to[(prio == p) & is_new]
        if len(new):
            out.append(([p], [True], [len(new)], [len(np.unique(new))], [None]))
        point, n = np.unique(to[(prio == p) & ~is_new], return_counts=True)
        out.append((np.full(len(point), p), np.zeros(len(point), bool), n, np.zeros(len(point), np.int64), point))
    kinds = {"prio": pa.int32(), "is_new_pp": pa.bool_(), "candidates": pa.int64(), "points": pa.int64(), "id_positionpoint": pa.int64()}
    columns = [pa.chunked_array([pa.array(v).cast(kind) for v in part], kind) for part, kind in zip(zip(*out), kinds.values())] if out else [pa.chunked_array([], k) for k in kinds.values()]
    return pa.table(columns, names=list(kinds))


def _in_blocks(df: DataFrame, i: str, j: str, side: int, margin: int) -> DataFrame:
    """A row for each block (_bi, _bj) of `side` cells or tiles that holds the row's, itself or in its margin."""
    block = lambda at, by: f"cast(floor(({at} + {by}) / {side}D) AS bigint)"
    df = df.withColumns({f"_{n}{end}": F.expr(block(at, by)) for n, at in (("i", i), ("j", j)) for end, by in ((0, -margin), (1, margin))})
    blocks = "flatten(transform(sequence(_i0, _i1), a -> transform(sequence(_j0, _j1), b -> named_struct('i', a, 'j', b))))"
    df = df.withColumn("_b", F.explode(F.expr(f"CASE WHEN _i0 = _i1 AND _j0 = _j1 THEN array(named_struct('i', _i0, 'j', _j0)) ELSE {blocks} END")))
    return df.withColumns({"_bi": F.col("_b.i"), "_bj": F.col("_b.j")}).drop("_b", "_i0", "_i1", "_j0", "_j1")


def _per_block(cand: DataFrame, side: int) -> DataFrame:
    per = _in_blocks(cand.select("prio", "_ti", "_tj", "_n"), "_ti", "_tj", side // TILE, 0)
    return per.groupBy("prio", "_bi", "_bj").agg(F.sum("_n").alias("n"))


def _side(new: DataFrame, most: int) -> int:
    """The side of a pass's blocks; with the first, no block has more than `most` candidates."""
    if most <= BLOCK_ROWS:
        return SIDES[0]
    for side in SIDES[:-1]:
        if _per_block(new, side).groupBy("_bi", "_bj").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= BLOCK_ROWS:
            return side
    return SIDES[-1]


def _passes(candidates: DataFrame, existing: DataFrame | None, radius: float, height: float, size: float, counted: bool) -> list[DataFrame]:
    """The result of each pass; if `counted`, without what rounds don't need, and that of the last one as counts."""
    spark = candidates.sparkSession
    if "_ti" not in candidates.columns:
        pack, schema = packer(counted, size)
        types = {"prio": "int", "zoom": "int", "z": "double", "azimuth": "double"}
        names = ["edge_idx", "prio", "x", "y", "z", *([] if counted else _CARRIED)]
        rows = candidates.select("uuid_edge", *(F.col(f).cast(types[f]).alias(f) if f in types else F.col(f) for f in names))
        candidates = rows.where("x IS NOT NULL AND y IS NOT NULL AND prio IS NOT NULL").mapInArrow(pack, schema)
    fields = {f: kind for f, kind in (_NEEDED | _CARRIED).items() if f in candidates.columns}
    cand = cut(candidates, "candidates")
    sizes = {r["prio"]: r for r in _per_block(cand, SIDES[0]).groupBy("prio").agg(F.max("n").alias("most"), F.sum("n").alias("rows")).collect()}
    prios = sorted(sizes)
    known = existing.select(*[f.split()[0] for f in PP.split(", ")]) if existing is not None else None
    done: list[DataFrame] = []
    for first in range(0, len(prios), PRIORITIES):
        some = prios[first : first + PRIORITIES]
        last = first + PRIORITIES >= len(prios)
        new, margin = cand.where(F.col("prio").isin(some)), 4 * len(some) - 1
        side = _side(new, sum(sizes[p]["most"] for p in some))
        left = _in_blocks(new, "_ti", "_tj", side // TILE, -(-margin // TILE)).drop("_ti", "_tj")
        by = ["_bi", "_bj"]
        blocks = left.select(*by).distinct()
        if (tasks := -(-sum(sizes[p]["rows"] for p in some) // TASK_ROWS)) > int(spark.conf.get("spark.sql.shuffle.partitions")):
            left = left.repartition(tasks, *by)
        only = counted and last
        block, schema = _snap_block(radius, height, size, side, margin, fields, only), _COUNTED if only else _RESULT
        if known is None:
            out = left.groupBy(*by).applyInArrow(_alone(block), schema)
        else:
            i, j = f"(_cell div {1 << 26} - {cells.OFFSET})", f"(_cell % {1 << 26} - {cells.OFFSET})"
            right = _in_blocks(known.withColumn("_cell", F.expr(cells.cell("x", "y", size))), i, j, side, margin + 1).drop("_cell")
            right = right.join(blocks, by, "left_semi")
            out = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(block, schema)
        if not last:
            out = cut(out, "snapped")
            more = out.where("is_new_pp").select("snapped.*")
            known = known.unionByName(more) if known is not None else more
        done.append(out)
    return done


def snap(candidates: DataFrame, existing: DataFrame | None = None, radius: float = RADIUS, height: float = HEIGHT_TOLERANCE, size: float = cells.SIZE) -> DataFrame:
    """One row per candidate with the point that it is mapped to (`snapped`) and whether that is new.

    Candidates may be those of `packer` (with the same size of cells), made where the points of edges are.
    The last pass is not written: callers that use the result more than once write it themselves."""
    done = _passes(candidates, existing, radius, height, size, False)
    return reduce(DataFrame.unionByName, done) if done else candidates.sparkSession.createDataFrame([], _RESULT)


def rounds(candidates: DataFrame, existing: DataFrame | None = None, radius: float = RADIUS, height: float = HEIGHT_TOLERANCE, size: float = cells.SIZE) -> DataFrame:
    """By priority and is_new_pp, the candidates that `snap` maps and their different points.

    The last pass is counted in its blocks. Candidates may be packed, as in `snap`; they need no position, zoom and azimuth."""
    *earlier, last = _passes(candidates, existing, radius, height, size, True) or [candidates.sparkSession.createDataFrame([], _COUNTED)]
    one = lambda df: df.selectExpr("prio", "is_new_pp", "1L AS candidates", "0L AS points", "snapped.id_positionpoint")
    both = reduce(DataFrame.unionByName, [*map(one, earlier), last])
    per = both.groupBy("prio", "is_new_pp", "id_positionpoint").agg(F.sum("candidates").alias("candidates"), F.sum("points").alias("points"))
    return per.groupBy("prio", "is_new_pp").agg(F.sum("candidates").alias("candidates"), (F.sum("points") + F.count("id_positionpoint")).alias("points"))


def points(snapped: DataFrame, source_crs: str = "EPSG:2056") -> DataFrame:
    """New position points: id, zoom, cell, x, y, z, lng, lat, azimuth and token."""
    lng, lat = crs.transform(source_crs, "EPSG:4326", "x", "y")
    new = snapped.where("is_new_pp").select("snapped.*")
    return new.select(
        "id_positionpoint", F.col("zoom").cast("short").alias("zoom"), "cell", "x", "y", F.col("z").cast("float").alias("z"),
        F.expr(lng).alias("lng"), F.expr(lat).alias("lat"), F.col("azimuth").cast("float").alias("azimuth"), ids.token("id_positionpoint").alias("token"),
    )


def direction(candidate: str, point: str) -> str:
    """1 within 45 degrees of the point's azimuth, -1 within 45 degrees of its opposite, else null."""
    turn = f"acos(cos(({candidate}) - ({point})))"  # as in SQL, which decides at 45 and 135 degrees
    return f"cast(CASE WHEN {turn} < pi() / 4 THEN 1 WHEN {turn} > 3 * pi() / 4 THEN -1 END AS smallint)"


def mapping(snapped: DataFrame) -> DataFrame:
    """PP mapping: id_positionpoint, direction, zoom, uuid_edge, position and edge_idx of each candidate."""
    return snapped.select("snapped.id_positionpoint", F.expr(direction("azimuth", "snapped.azimuth")).alias("direction"), F.col("zoom").cast("short").alias("zoom"), "uuid_edge", "position", "edge_idx")
