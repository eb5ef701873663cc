"""MinHash near-dedup with tensored banding.

1. Scan: each text's set of five-word shingles is reduced to a digest of the set and to two small collections
   of half keys, each of `ROWS` minhashes. Texts with equal sets form one class and go on as one
   representative (the smallest doc_id).
2. Every pair of a left and a right half key is the key of one table: h**2 tables for the price of
   2 * h * ROWS minhashes. A table key can be shared only if both its halves are, so the few half keys that
   two documents or more have are found first, and only their products become table keys.
3. Documents joined by shared table keys, directly or over others, are a family. All candidates lie within
   one. Families of more than `FAMILY` bytes are worked on by their shared left half keys instead.
4. A task holds one block of a family at a time (`BLOCK` bytes of text, or two such blocks) and compares its
   documents with each other: only those of different components, of similar size, and whose bitmaps don't
   exclude the similarity (an exact bound); each is confirmed on the full shingle sets before it links. As
   linked documents become one component at once, a task sends a forest, not pairs.
5. Families of one block are settled by that. Of larger ones the blocks run one by one first, then a few
   documents of each component meet; last, all pairs of blocks that hold different components do, documents
   being dealt to blocks by component, so that a large group of copies never meets itself again.

No candidate is given up and no number of partners is capped. At the threshold a pair shares a table key
with probability 0.9997, above it with more (the number of half keys follows from the threshold).

Defined cases: null and empty texts have no shingles and are linked with nothing (their component is
their own doc_id); fewer than five words make one shingle; a null doc_id can be neither named nor
linked: component_id is null and the row is kept; repeated doc_ids stand for one document (`keep_one`
leaves one of its identical rows); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import materialise, small_batches
from .words import LOWER, buffers, mix, slices, window_keys, word_keys, word_spans

SHINGLE = 5
PERCENT = 85
ROWS = 4
#: A pair at the threshold is missed with this probability at most.
MISSED = 3e-4
SLICE = 1 << 20
#: Bytes of text of one block, and of a family that is compared as a whole.
BLOCK = 6 << 20
FAMILY = 96 << 20
#: Documents of a component that meet those of others before all blocks do.
MEETING = 4
#: Bits of a bitmap for each shingle of the largest set, and 64-bit words of a bitmap at most.
BITS, WORDS = 8, 512
#: Rows to be compared are broadcast up to this number (40 bytes each), and joined by a shuffle beyond it.
BROADCAST_ROWS = 1_000_000
_LOW = np.uint64(63)


def halves_for(percent: int) -> int:
    """Half keys a side, so that a pair at the threshold shares a left and a right one."""
    missed = 1 - (percent / 100) ** ROWS
    return next(h for h in range(1, 32) if 2 * missed**h <= MISSED)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts (two 64-bit keys each), sorted within each text, and how many each has."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, counts = word_spans(data, offsets)
    keys = word_keys(data, starts, ends)
    first, second, per = window_keys(keys, counts, SHINGLE)
    doc = np.repeat(np.arange(len(counts)), per)
    at = np.cumsum(counts) - counts
    for n in range(1, SHINGLE):
        few = np.flatnonzero(counts == n)
        if len(few):
            own = (at[few][:, None] + np.arange(n)).ravel()
            a, b, _ = window_keys((keys[0][own], keys[1][own]), np.full(len(few), n), n)
            first, second, doc = np.concatenate([first, mix(a ^ np.uint64(n))]), np.concatenate([second, b]), np.concatenate([doc, few])
    order = np.lexsort((first, doc))
    first, second, doc = first[order], second[order], doc[order]
    fresh = np.ones(len(first), dtype=bool)
    fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (doc[1:] != doc[:-1])
    return first[fresh], second[fresh], np.bincount(doc[fresh], minlength=len(counts))


def half_keys(shingles: np.ndarray, sizes: np.ndarray, halves: int) -> np.ndarray:
    """2 * halves half keys of each set that isn't empty; the low six bits of a key say which it is."""
    rng = np.random.Generator(np.random.PCG64(977))
    by, plus = rng.integers(1, 2**63, (2 * halves, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, (2 * halves, ROWS), dtype=np.uint64)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), 2 * halves), dtype=np.uint64)
    for i in range(2 * halves if len(starts) else 0):
        for r in range(ROWS):
            out[:, i] = mix(out[:, i] + np.minimum.reduceat(shingles * by[i, r] + plus[i, r], starts))
        out[:, i] = out[:, i] & ~_LOW | np.uint64(i)
    return out


def _sign(halves: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                first, second, sizes = shingle_sets(piece.column("text"))
                full = sizes > 0
                starts = (np.cumsum(sizes) - sizes)[full]
                digest = np.zeros((2, len(sizes)), dtype=np.uint64)
                if len(starts):
                    digest[0, full] = np.add.reduceat(mix(first ^ mix(second)), starts)
                    digest[1, full] = np.add.reduceat(mix(second ^ mix(first + np.uint64(0x5851F42D4C957F2D))), starts)
                raw = iter(half_keys(first, sizes, halves).astype("<u8"))
                keys = pa.array([next(raw).tobytes() if x else None for x in full], pa.binary())
                columns = [piece.column("doc_id"), piece.column("tag"), pa.array(sizes, pa.int64()), piece.column("size"), *(pa.array(d.view(np.int64)) for d in digest), keys]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "n_shingles", "size", "d1", "d2", "halves"])

    return scan


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.octet_length(text).cast("long").alias("size"), text.alias("text"))


def classes(docs: DataFrame, halves: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and one row per distinct shingle set with its smallest doc_id (node)."""
    kinds = "doc_id long, tag long, n_shingles long, size long, d1 long, d2 long, halves binary"
    signed = materialise(_texts(docs).mapInArrow(_sign(halves), kinds), "near-signatures")
    linked = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").alias("node"), "tag", "size", "halves")).alias("f")
    return signed, linked.groupBy("d1", "d2").agg(first, F.count("*").alias("members")).select("d1", "d2", "members", "f.*")


def _matrix(column: pa.Array, halves: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, 2 * halves)


def _half_rows(halves: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                piece = batch.slice(i, 4096)
                node = piece.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(_matrix(piece.column("halves"), halves).ravel().view(np.int64)), pa.array(np.repeat(node, 2 * halves))], ["half", "node"])

    return scan


def _table_rows(halves: int):
    """The keys of those tables both of whose halves are shared."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                piece = batch.slice(i, 1024)
                half, mask = _matrix(piece.column("halves"), halves), piece.column("mask").to_numpy().view(np.uint64)
                shared = (mask[:, None] >> np.arange(2 * halves, dtype=np.uint64) & np.uint64(1)).astype(bool)
                both = shared[:, :halves, None] & shared[:, None, halves:]
                keys = mix(half[:, :halves, None] * np.uint64(0x9E3779B97F4A7C15) + half[:, None, halves:])
                nodes = np.broadcast_to(piece.column("node").to_numpy()[:, None, None], both.shape)
                yield pa.RecordBatch.from_arrays([pa.array(keys[both].view(np.int64)), pa.array(nodes[both])], ["key", "node"])

    return scan


def _left_rows(halves: int):
    """A document's shared left half keys, as groups."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half, mask = _matrix(batch.column("halves"), halves)[:, :halves], batch.column("mask").to_numpy().view(np.uint64)
            row, at = np.nonzero(mask[:, None] >> np.arange(halves, dtype=np.uint64) & np.uint64(1))
            own = batch.take(pa.array(row)).select(["node", "tag", "size"])
            yield pa.RecordBatch.from_arrays([pa.array(half[row, at].view(np.int64)), *own.columns], ["group", "node", "tag", "size"])

    return scan


def families(sets: DataFrame, halves: int) -> DataFrame:
    """(group, node, tag, size): the documents that share table keys with others, in the groups whose members
    are to be compared. sets: node, tag, size, halves."""
    rows = sets.select("node", "halves").mapInArrow(_half_rows(halves), "half long, node long")
    shared = rows.groupBy("half").agg(F.min("node").alias("m"), F.max("node").alias("o")).where("m <> o")
    masks = rows.join(shared, "half", "left_semi").groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, cast(half & 63 AS int))")).alias("mask"))
    left = (1 << halves) - 1
    masks = masks.where(f"(mask & {left}L) <> 0 AND (mask & {left << halves}L) <> 0")
    some = materialise(sets.join(masks, "node").select("node", "tag", "size", "halves", "mask"), "near-open")
    keys = some.select("node", "halves", "mask").mapInArrow(_table_rows(halves), "key long, node long")
    first = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("o")).where("a <> o").select("key", "a")
    found = components(keys.join(first, "key").where("node <> a").select("a", F.col("node").alias("b")))
    found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    members = materialise(some.join(found, "node"), "near-families")
    large = materialise(members.groupBy("root").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > FAMILY), "near-large")
    out = members.join(large, "root", "left_anti").select(F.col("root").alias("group"), "node", "tag", "size")
    if large.isEmpty():
        return out
    by_left = members.join(large, "root", "left_semi").select("node", "tag", "size", "halves", "mask")
    return out.unionByName(by_left.mapInArrow(_left_rows(halves), "group long, node long, tag long, size long"))


def _bitmaps(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    words = min(WORDS, max(4, 1 << (int(sizes.max()) * BITS // 64).bit_length()))
    out = np.empty((len(sizes), words), dtype=np.uint64)
    ends = np.cumsum(sizes)
    for i in range(0, len(sizes), 1024):
        some = sizes[i : i + 1024]
        flags = np.zeros((len(some), words * 64), dtype=bool)
        own = shingles[ends[i] - sizes[i] : ends[i + len(some) - 1]]
        flags[np.repeat(np.arange(len(some)), some), own >> np.uint64(64 - (words * 64).bit_length() + 1)] = True
        out[i : i + 1024] = np.packbits(flags, axis=1).view(np.uint64)
    return out


def similar(texts: pa.Array, comps: np.ndarray, sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the components of `texts` (all equal, or those of different sides only): a forest."""
    parts = [shingle_sets(p.column("text")) for p in slices(pa.table({"text": texts}), "text", SLICE)]
    first, second, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    starts = np.cumsum(sizes) - sizes
    maps = _bitmaps(first, sizes)
    order = np.argsort(sizes, kind="stable")
    size, maps, label, side = sizes[order], maps[order], np.unique(comps, return_inverse=True)[1][order], sides[order]
    two = (side != side[0]).any()
    upto = np.searchsorted(size, size * 100 // percent, side="right")
    out = []
    for i in range(len(size)):
        to = np.arange(i + 1, upto[i])
        differs = label[to] != label[i]
        to = to[differs & (side[to] != side[i])] if two else to[differs]
        if not len(to):
            continue
        apart = np.bitwise_count(maps[to] ^ maps[i]).sum(axis=1, dtype=np.int64)
        for j in to[apart * (100 + percent) <= (100 - percent) * (size[to] + size[i])]:
            if label[j] == label[i]:
                continue
            x, y = (slice(starts[order[k]], starts[order[k]] + size[k]) for k in (i, j))
            at = np.minimum(np.searchsorted(first[y], first[x]), size[j] - 1)
            both = int(((first[y][at] == first[x]) & (second[y][at] == second[x])).sum())
            if 100 * both >= percent * (size[i] + size[j] - both):
                out.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return out


def _compare(percent: int):
    """Links within each run of rows with equal group, x and y; rows come sorted by these."""

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        key = np.stack([rows.column(c).to_numpy() for c in ("group", "x", "y")])
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0).any(axis=0), [True]]))
        found = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            own = rows.slice(lo, hi - lo)
            if hi - lo > 1:
                node, comp, side = (own.column(c).to_numpy() for c in ("node", "comp", "block"))
                found += [(node[i], node[j]) for i, j in similar(own.column("text").combine_chunks(), comp, side, percent)]
        if found:
            a, b = np.array(found, dtype=np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = np.ones(held.num_rows, dtype=bool)
            for c in ("group", "x", "y"):
                v = held.column(c).to_numpy()
                last &= v == v[-1]
            at = held.num_rows - int(last.sum())  # the last run may go on in the next batch
            yield from out(held.slice(0, at))
            held = held.slice(at)
        if held is not None:
            yield from out(held)

    return scan


def confirmed(rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found among `rows` (group, x, y, block, node, tag, comp) that share group, x and y."""
    rows = materialise(rows.select("group", "x", "y", "block", "node", "tag", "comp"), "near-rows")
    n = rows.count()
    bound = lambda df: F.broadcast(df) if n <= BROADCAST_ROWS else df
    need = bound(rows.select(F.col("node").alias("_id"), F.col("tag").alias("_tag")).distinct())
    once = texts.join(need, (F.col("doc_id") == F.col("_id")) & (F.col("tag") == F.col("_tag")), "left_semi").groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.first("text").alias("text"))
    joined = once.join(bound(rows), (F.col("node") == F.col("_id")) & (F.col("tag") == F.col("_tag")))
    wide = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 10_000)
    met = joined.select("group", "x", "y", "block", "node", "comp", "text").repartition(wide, "group", "x", "y").sortWithinPartitions("group", "x", "y")
    return materialise(met.mapInArrow(_compare(percent), "a long, b long"), "near-links")


def _dealt(rows: DataFrame, by: Column) -> DataFrame:
    """`rows` with a block of its group for each, about `BLOCK` bytes; rows with equal `by` go together."""
    blocks = rows.groupBy(F.col("group").alias("_g")).agg(F.ceil(F.sum("size") / BLOCK).alias("blocks"))
    out = rows.join(blocks, rows["group"] == blocks["_g"]).drop("_g")
    return out.withColumn("block", F.pmod(F.xxhash64("group", by), F.greatest("blocks", F.lit(1))))


def _alone(rows: DataFrame) -> DataFrame:
    """Each block for itself."""
    return rows.withColumns({"x": F.col("block"), "y": F.col("block")})


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` (node, root) after more links: only the links between components are contracted anew."""
    at = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
    moved = components(between.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return materialise(roots.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root")).unionByName(moved), "near-roots")


def _with_comp(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """`rows` of groups that hold several components, with comp."""
    rows = materialise(rows.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root"), "near-comps")
    mixed = rows.groupBy("group").agg(F.min("comp").alias("m"), F.max("comp").alias("o")).where("m <> o")
    return rows.join(mixed, "group", "left_semi")


def _meeting(rows: DataFrame) -> DataFrame:
    """A few documents of each component of a group, in blocks."""
    own = ["node", "tag", "size"]
    drawn = [F.min(F.struct(F.xxhash64(F.lit(seed), "node"), *own)) for seed in range(MEETING)]
    some = rows.groupBy("group", "comp").agg(F.array_distinct(F.transform(F.array(*drawn), lambda x: F.struct(x["node"].alias("node"), x["tag"].alias("tag"), x["size"].alias("size")))).alias("_some"))
    return _alone(_dealt(some.select("group", "comp", F.explode("_some").alias("_s")).select("group", "comp", "_s.*"), F.col("node")))


def _crossing(rows: DataFrame) -> DataFrame:
    """All pairs of blocks that hold different components: large components have blocks of their own."""
    per = rows.groupBy("group", "comp").agg(F.sum("size").alias("_bytes"))
    per = materialise(per.withColumn("_own", F.col("_bytes") * 2 >= BLOCK), "near-sizes")
    rest = per.where("NOT _own").groupBy("group").agg(F.ceil(F.sum("_bytes") / BLOCK).alias("_rest"))
    rows = rows.join(per, ["group", "comp"]).join(rest, "group", "left")
    own = F.xxhash64(F.lit(1), "comp", F.pmod(F.xxhash64("node"), F.ceil(F.col("_bytes") / BLOCK)))
    shared = F.xxhash64(F.lit(2), F.pmod(F.xxhash64("comp"), F.greatest("_rest", F.lit(1))))
    rows = rows.select("group", "node", "tag", "comp", F.when(F.col("_own"), own).otherwise(shared).alias("block"), F.when(F.col("_own"), F.col("comp")).alias("only"))
    rows = materialise(rows, "near-blocks")
    blocks = rows.select("group", "block", "only").distinct()
    other = blocks.select(F.col("group").alias("_g"), F.col("block").alias("y"), F.col("only").alias("_o"))
    pairs = blocks.withColumnRenamed("block", "x").join(other, F.col("group") == F.col("_g"))
    pairs = pairs.where("(x < y AND coalesce(only <> _o, true)) OR (x = y AND only IS NULL)").select("group", "x", "y")
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("x", "y"))))
    return rows.drop("only").join(sides, ["group", "block"])


def links_of(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(node, root): components of all links among `members` (group, node, tag, size); roots left out."""
    members = materialise(members, "near-members")
    first = _dealt(members, F.col("node")).withColumn("comp", F.col("node"))
    roots = components(confirmed(_alone(first), texts, percent))
    several = members.groupBy("group").agg(F.sum("size").alias("_bytes")).where(F.col("_bytes") > BLOCK).select("group")
    several = materialise(several, "near-several")
    if several.isEmpty():
        return roots
    rest = members.join(several, "group", "left_semi")
    for rows in (_meeting, _crossing):
        roots = _joined(roots, confirmed(rows(_with_comp(rest, roots)), texts, percent))
    return roots


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (doc_id, text)."""
    small_batches(docs.sparkSession)
    halves = halves_for(percent)
    signed, sets = classes(docs, halves)
    sets = materialise(sets, "near-classes")
    roots = links_of(families(sets.select("node", "tag", "size", "halves"), halves), _texts(docs).drop("size"), percent)
    small = sets.join(roots, "node", "left").where("members > 1 OR root IS NOT NULL")
    named = materialise(small.select("d1", "d2", F.coalesce("root", "node").alias("component_id")), "near-components")
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0) | F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay when one document of each component does, unchanged."""
    found = materialise(near_dedup(docs, percent).select("doc_id", "kept"), "near-kept")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    twice = materialise(found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id"), "near-twice")
    if twice.isEmpty():
        return left
    same = docs["doc_id"] == F.col("_id")
    return left.join(twice, same, "left_anti").unionByName(left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))
