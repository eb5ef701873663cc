"""Substring dedup: words covered by a window whose word sequence starts earlier are removed.

1. Scan: every window of `width` consecutive words gets Rabin-Karp values over a prime field. A task sorts
   the distinct values of a few million windows, cut to a few more bits than their number needs, and sends
   each range of them as one packed row, with the chunk (a range of doc_id) that each was seen in: three or
   four bytes a window instead of a row.
2. Count: the rows of one range meet in one task, which names for every chunk the values that other chunks
   have, too. A value enters once per chunk and task, however often it repeats there.
3. Each chunk's texts meet the values named for it and send the full keys (124 bits) of those windows, which
   are counted in the same way; what comes back are the keys that an earlier chunk has.
4. Removal: windows with such a key, and windows that repeat inside the chunk, are removed; overlapping
   windows merge into maximal intervals.

The number of chunks and of ranges grows with the input, so no task's share does; a window that very many
chunks hold brings one entry for each of them into one range.

Defined cases: null and empty texts have no words, and texts of fewer than `width` words lose none; of
rows with the same doc_id the order of (xxhash64 of the text, text) says which is earlier (equal rows: either,
and one of them keeps its words); null doc_ids come after all others; rows of one doc_id, or of none, are
split into chunks by that hash if they are many; an empty table gives an empty result; other columns pass
through unless a result column has their name, which then replaces them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import materialise
from .words import LANES, buffers, slices, window_keys, word_keys, word_spans

WIDTH = 20
CHUNK_BYTES = 6 << 20
FLUSH_WINDOWS = 1_500_000
RANGE_WINDOWS = 400_000
#: Bits of the values counted first, beyond those that number all windows.
EXTRA_BITS = 10
SLICE = 1 << 20
COARSE = 2048


class Ranges:
    """Order-preserving chunks of (doc_id, hash of the text): quantile ranges of doc_id, each cut into `fine` equal
    widths; a doc_id that fills several quantiles, and the rows without one, are cut by the hash."""

    def __init__(self, edges: list[int], fine: int, nulls: int = 1, total: int = 0):
        self.edges, many = np.unique(np.array(edges, dtype=np.int64), return_counts=True)
        self.hot, self.fine, self.nulls, self.total = (many - 1) * fine, fine, nulls, total
        self.base = np.concatenate([[0], np.cumsum(self.hot + fine)])

    @classmethod
    def of(cls, texts: DataFrame, chunk_bytes: int) -> Ranges:
        coarse = [i / COARSE for i in range(COARSE + 1)]
        size = F.octet_length("text")
        row = texts.agg(F.sum(size).alias("n"), F.sum(F.when(F.col("doc_id").isNull(), size)).alias("nulls"), F.percentile_approx("doc_id", coarse, 10000).alias("q")).first()
        chunks = max(64, -(-(row["n"] or 0) // chunk_bytes))
        edges = list(row["q"] or [0])
        if chunks < len(edges):
            edges = [edges[i * (len(edges) - 1) // chunks] for i in range(chunks + 1)]
        return cls(edges, max(1, -(-chunks // len(edges))), max(1, -(-(row["nulls"] or 0) // chunk_bytes)), row["n"] or 0)

    def chunk(self, ids: np.ndarray, null: np.ndarray, tags: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(self.edges, ids, side="right") - 1, 0, len(self.edges) - 1)
        low = self.edges[at].astype(np.float64)
        wide = np.where(at + 1 < len(self.edges), self.edges[np.minimum(at + 1, len(self.edges) - 1)] - low, 1)
        part = np.clip((ids - low) / np.maximum(wide, 1) * self.fine, 0, self.fine - 1).astype(np.int64)
        share = (tags.astype(np.float64) + 2.0**63) / 2.0**64  # in the order of the hashes
        slot = lambda n: np.minimum((share * n).astype(np.int64), np.maximum(n - 1, 0))
        inner = np.where((ids == self.edges[at]) & (self.hot[at] > 0), slot(self.hot[at]), self.hot[at] + part)
        return np.where(null, self.base[-1] + slot(np.int64(self.nulls)), self.base[at] + inner).astype(np.int32)

    def of_rows(self, rows: pa.RecordBatch | pa.Table) -> np.ndarray:
        ids, tags = rows.column("doc_id"), rows.column("_tag").to_numpy()
        null = ids.is_null().to_numpy() if isinstance(ids, pa.ChunkedArray) else ids.is_null().to_numpy(zero_copy_only=False)
        return self.chunk(pa.compute.fill_null(ids, 0).to_numpy(), null, tags)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the same weight together, as many of each value as the largest one needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    out = np.zeros(((len(raw) - 1) // raw[0], 8), dtype=np.uint8)
    out[:, : raw[0]] = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(raw[0], -1).T
    return out.view("<u8").ravel()


def _pack(h: np.ndarray) -> bytes:
    return _planes(np.diff(h, prepend=np.uint64(0)))


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(raw), dtype=np.uint64)


def _windows(texts: pa.Array, width: int, lanes: int = LANES) -> tuple[np.ndarray, ...]:
    """Keys of all windows (an array for two lanes each), and how many each text has."""
    data, offsets = buffers(texts)
    starts, ends, counts = word_spans(data, offsets)
    return window_keys(word_keys(data, starts, ends), counts, width, lanes)


def _batch(part: list, low: list, keys: list, chunks: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(low, pa.int32()), pa.array(keys, pa.binary()), pa.array(chunks, pa.binary())], ["part", "low", "keys", "chunks"])


def _scan(ranges: Ranges, width: int, bits: int, shift: int):
    def flush(keys: list[np.ndarray], chunks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, c = np.concatenate(keys), np.concatenate(chunks)
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        h, c = h[fresh], c[fresh]
        part = (h >> np.uint64(shift)).astype(np.int64)
        bounds, low = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(h)], int(c.min())
        rows = [(int(part[a]), low, _pack(h[a:b]), _planes(c[a:b] - low)) for a, b in zip(bounds, bounds[1:], strict=False)]
        for i in range(0, len(rows), 512):
            yield _batch(*map(list, zip(*rows[i : i + 512], strict=True)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, chunks, held = [], [], 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                h, per = _windows(piece.column("text"), width, 2)
                if not len(h):
                    continue
                keys.append(h >> np.uint64(64 - bits))
                chunks.append(np.repeat(ranges.of_rows(piece), per))
                held += len(h)
                if held >= FLUSH_WINDOWS:
                    yield from flush(keys, chunks)
                    keys, chunks, held = [], [], 0
        if held:
            yield from flush(keys, chunks)

    return scan


def _by_chunk(c: np.ndarray, *keys: np.ndarray) -> pa.Table:
    """A row for each chunk with its keys, sorted by the first ones."""
    order = np.lexsort((keys[0], c))
    c, keys = c[order], [k[order] for k in keys]
    bounds = [*np.flatnonzero(np.diff(c, prepend=-1)).tolist(), len(c)]
    packed = [_pack(keys[0][a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    more = [b"".join(k[a:b].tobytes() for k in keys[1:]) for a, b in zip(bounds, bounds[1:], strict=False)]
    return pa.table({"chunk": pa.array(c[bounds[:-1]], pa.int32()), "keys": pa.array(packed, pa.binary()), "more": pa.array(more, pa.binary())})


def _shared(table: pa.Table) -> pa.Table:
    """For one range of values: those of every chunk that another chunk has, too."""
    low = table.column("low").to_pylist()
    h = np.concatenate([_unpack(x) for x in table.column("keys").to_pylist()])
    c = np.concatenate([_unplanes(x).astype(np.int32) + np.int32(at) for at, x in zip(low, table.column("chunks").to_pylist(), strict=True)])
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    h, c = h[fresh], c[fresh]
    same = h[1:] == h[:-1]
    many = np.zeros(len(h), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    return _by_chunk(c[many], h[many])


def _keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the keys of rows made by `_by_chunk`, sorted."""
    none = [np.zeros(0, dtype=np.uint64)]
    first = np.concatenate([_unpack(x) for x in table.column("keys").to_pylist()] or none)
    second = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table.column("more").to_pylist()] or none)
    order = np.lexsort((second, first))
    return first[order], second[order]


def _full(ranges: Ranges, width: int, bits: int, shift: int):
    """Full keys of a chunk's windows whose short values other chunks have, too."""

    def send(docs: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows and found.num_rows:
            values = np.sort(np.concatenate([_unpack(x) for x in found.column("keys").to_pylist()]))
            firsts, seconds = [], []
            for piece in slices(docs, "text", SLICE):
                a, b, _ = _windows(piece.column("text"), width)
                short = a >> np.uint64(64 - bits)
                hit = values[np.minimum(np.searchsorted(values, short), len(values) - 1)] == short
                firsts.append(a[hit])
                seconds.append(b[hit])
            a, b = np.concatenate(firsts), np.concatenate(seconds)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = np.ones(len(a), dtype=bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            a, b = a[fresh], b[fresh]
            part = (a >> np.uint64(64 - bits) >> np.uint64(shift)).astype(np.int64)
            bounds, chunk = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(a)], int(ranges.of_rows(docs.slice(0, 1))[0])
            rows = [(int(part[x]), chunk, _pack(a[x:y]), b[x:y].tobytes()) for x, y in zip(bounds, bounds[1:], strict=False)]
        kinds = (("part", pa.int64()), ("chunk", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()))
        return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})

    return send


def _later(table: pa.Table) -> pa.Table:
    """For one range of keys: those of every chunk that an earlier chunk has."""
    packed = table.column("keys").to_pylist()
    a = [_unpack(x) for x in packed]
    c = np.repeat(table.column("chunk").to_numpy(), [len(x) for x in a])
    a, b = np.concatenate(a), np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table.column("more").to_pylist()])
    order = np.lexsort((c, b, a))
    a, b, c = a[order], b[order], c[order]
    late = np.zeros(len(a), dtype=bool)
    late[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return _by_chunk(c[late], a[late], b[late])


def _removal(width: int, with_text: bool, names: list[str]):
    def remove(docs: pa.Table, found: pa.Table) -> pa.Table:
        n = docs.num_rows
        if not n:
            return pa.table({c: docs.column(c) for c in names} | {c: pa.array([], k) for c, k in (("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *((("kept_text", pa.string()),) if with_text else ()))})
        key = pa.table({"id": docs.column("_id"), "tag": docs.column("_tag"), "text": docs.column("text")})
        docs = docs.take(pa.compute.sort_indices(key, sort_keys=[("id", "ascending"), ("tag", "ascending"), ("text", "ascending")], null_placement="at_end"))
        # pass 1: keys of the whole chunk, to see what repeats inside it and what is earlier elsewhere
        texts = docs.column("text").combine_chunks()
        parts = [_windows(piece.column("text"), width) for piece in slices(pa.table({"text": texts}), "text", SLICE)]
        a, b, per = (np.concatenate(x) for x in zip(*parts, strict=True))
        own, (ea, eb) = len(a), _keys_of(found)
        order = np.lexsort((np.concatenate([np.arange(own), np.full(len(ea), -1)]), np.concatenate([b, eb]), np.concatenate([a, ea])))
        a, b = np.concatenate([a, ea])[order], np.concatenate([b, eb])[order]
        again = order[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])]
        drop = np.zeros(own, dtype=bool)
        drop[again[again < own]] = True
        ends = np.cumsum(per)
        # pass 2: cut the words of the marked windows
        n_words, n_removed, sha, kept = [], [], [], []
        for i, text in enumerate(texts):
            words = (text.as_py() or "").encode().split()
            marks = np.flatnonzero(drop[ends[i] - per[i] : ends[i]])
            n_words.append(len(words))
            if len(marks):
                delta = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(delta, marks, 1)
                np.add.at(delta, marks + width, -1)
                stay = np.flatnonzero(np.cumsum(delta[:-1]) == 0)
                n_removed.append(len(words) - len(stay))
                words = [words[j] for j in stay]
            else:
                n_removed.append(0)
            joined = b" ".join(words)
            sha.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                kept.append(joined.decode() if len(marks) else text.as_py())
        out = {c: docs.column(c) for c in names}
        out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(kept, pa.string())} if with_text else {}))

    return remove


def dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The columns of `docs` with n_words, n_removed, kept_sha256 (and kept_text: the text as it was if no
    word goes, else the kept words joined by one space)."""
    spark = docs.sparkSession
    new = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    docs = docs.drop(*new)
    names = docs.columns if with_text else [c for c in docs.columns if c != "text"]
    tag = F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("_tag"), F.col("text").cast("string").alias("text"))
    ranges = Ranges.of(texts, chunk_bytes)
    total = ranges.total
    parts = (max(256, total // 6 // RANGE_WINDOWS) - 1).bit_length()
    bits = min(62, max(parts, total.bit_length() + EXTRA_BITS))  # a window takes two bytes at least, words being apart
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // (24 << 20)))
    packed = texts.mapInArrow(_scan(ranges, width, bits, bits - parts), "part long, low int, keys binary, chunks binary")
    found = materialise(packed.repartition(wide, "part").groupBy("part").applyInArrow(_shared, "chunk int, keys binary, more binary"), "substring-shared")

    @F.arrow_udf("int")
    def chunk_of(ids: pa.Array, tags: pa.Array) -> pa.Array:
        return pa.array(ranges.of_rows(pa.table({"doc_id": ids, "_tag": tags})), pa.int32())

    sent = texts.withColumn("_chunk", chunk_of("doc_id", "_tag")).groupBy("_chunk").cogroup(found.groupBy("chunk"))
    sent = sent.applyInArrow(_full(ranges, width, bits, bits - parts), "part long, chunk int, keys binary, more binary")
    late = materialise(sent.repartition(wide, "part").groupBy("part").applyInArrow(_later, "chunk int, keys binary, more binary"), "substring-later")
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_tag": tag})
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(c, T.StringType() if c.startswith("kept") else T.LongType()) for c in new])
    dealt = keyed.withColumn("_chunk", chunk_of("_id", "_tag")).groupBy("_chunk")
    return dealt.cogroup(late.groupBy("chunk")).applyInArrow(_removal(width, with_text, names), schema)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
