"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

1. Word vectors: every token (a run of letters and digits, or of other marks) falls into one of
   `BUCKETS` buckets, each with a fixed sparse ternary index vector. A bucket's word vector is the sum
   of the index vectors of its neighbours in all documents, without any label; these are integers, so
   the sum is the same in any order.
2. A document is the mean and the mean square of its word vectors, weighted down for frequent words, the
   share of its tokens with the word vector of a token shortly before, and its length.
3. A network with one hidden layer is trained with Adam on a bounded sample of labelled rows
   (`max_rows`, the rows with the smallest hashes of doc_id; none of the held-out fold). A temperature
   fitted on a part kept from training calibrates its probabilities.

Only the text is an input of a score. Texts stay on the executors; the driver receives the sums of all
buckets, which are of fixed size, and one pooled vector for each sampled row.

Defined cases: null and empty texts get the score of a text without tokens; repeated rows are scored
alike; several labels of one doc_id count as the smallest, and of several texts the smallest is
learned from; null labels are ignored; a null doc_id is not
held out and has no label; without labels of both classes every score is the share of label 1 (0.5
without any); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise, smallest
from .words import buffers, slices, word_hashes

BUCKETS = 1 << 14
DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
LAGS = (1, 2, 3, 4)
HIDDEN = 24
MAX_ROWS = 6000
FOLDS = 5
THRESHOLD = 0.3
SLICE = 1 << 20
_SUMS = [f"s{d}" for d in range(DIMENSIONS)]
_KIND = np.full(256, 2, dtype=np.uint8)  # 0: white space, 1: letters and digits, 2: other marks
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def index_vectors() -> np.ndarray:
    """The fixed ternary index vector of each bucket."""
    rng = np.random.Generator(np.random.PCG64(31))
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.int64)
    place = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, place, rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO)), axis=1)
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token, and the number of tokens of each text."""
    data, offsets = buffers(texts)
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    if len(data):
        edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    full = kind[starts] > 0 if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[full], ends[full]
    buckets = (word_hashes(data, starts, ends) >> np.uint64(64 - 14)).astype(np.int32)
    return buckets, np.diff(np.searchsorted(starts, offsets))


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that a task has seen: how often, and the sum of its neighbours' index vectors."""
    index = index_vectors()
    place = np.nonzero(index)[1].reshape(BUCKETS, NONZERO)
    sign = np.take_along_axis(index, place, axis=1).astype(np.float64)
    sums, seen = np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            b, per = tokens(piece.column("text"))
            doc = np.repeat(np.arange(len(per)), per)
            seen += np.bincount(b, minlength=BUCKETS)
            for k in range(1, WINDOW + 1):
                near = doc[k:] == doc[:-k]
                for x, y in ((b[:-k][near], b[k:][near]), (b[k:][near], b[:-k][near])):
                    cells = (x[:, None] * DIMENSIONS + place[y]).ravel()
                    sums += np.bincount(cells, weights=sign[y].ravel(), minlength=len(sums)).astype(np.int64)
    found = np.flatnonzero(seen)
    parts = sums.reshape(BUCKETS, DIMENSIONS)[found]
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(seen[found]), *[pa.array(parts[:, d]) for d in range(DIMENSIONS)]], ["bucket", "seen", *_SUMS])


def word_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of neighbours' index vectors, and counts, of all buckets over the texts of all rows. A task takes up to
    eight parts of the scan, though four tasks run for each core at least, so that what they add up stays small."""
    tasks = max(4 * docs.sparkSession.sparkContext.defaultParallelism, docs.rdd.getNumPartitions() // 8)
    kinds = "bucket int, seen long, " + ", ".join(f"{c} long" for c in _SUMS)
    each = docs.select(F.col("text").cast("string").alias("text")).coalesce(tasks).mapInArrow(_context, kinds)
    total = each.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("seen", *_SUMS)]).toArrow()  # BUCKETS rows at most
    sums, seen = np.zeros((BUCKETS, DIMENSIONS), dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    at = total["bucket"].to_numpy()
    seen[at] = total["seen"].to_numpy()
    sums[at] = np.column_stack([total[c].to_numpy() for c in _SUMS])
    return sums, seen


def word_table(sums: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Word vectors of unit length and their squares, weighted by 1 / (1 + 1000 * share of all tokens), and the weight."""
    v = sums / np.maximum(np.sqrt((sums.astype(np.float64) ** 2).sum(axis=1, keepdims=True)), 1e-9)
    weight = 1 / (1 + 1000 * seen / max(int(seen.sum()), 1))[:, None]
    return np.hstack([v * weight, v * v * weight, weight]).astype(np.float32)


def pooled(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """One vector for each text."""
    b, per = tokens(texts)
    sums = np.zeros((len(per), table.shape[1]))
    full = per > 0
    if full.any():
        sums[full] = np.add.reduceat(table[b], (np.cumsum(per) - per)[full], axis=0, dtype=np.float64)
    mean = sums[:, :-1] / np.maximum(sums[:, -1:], 1e-9)
    doc = np.repeat(np.arange(len(per)), per)
    again = [np.bincount(doc[k:][(doc[k:] == doc[:-k]) & (b[k:] == b[:-k])], minlength=len(per)) / np.maximum(per - k, 1) for k in LAGS]
    return np.column_stack([mean, *again, np.log1p(per)])


class Network:
    """Two layers; `logit` over standardised inputs, `score` with the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7):
        self.constant = None
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.Generator(np.random.PCG64(seed))
        order = rng.permutation(len(y))
        held, fit = order[: len(y) // 5], order[len(y) // 5 :]
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        n = x.shape[1]
        p = [rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
                a, want = x[part], y[part]
                h = np.tanh(a @ p[0] + p[1])
                err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - want) / len(part)
                back = np.outer(err, p[2]) * (1 - h * h)
                grads = [a.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ err + 1e-4 * p[2], np.array([err.sum()])]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.weights, self.temperature = p, 1.0
        z, want = self._logit(x[held]), y[held]
        if len(held):
            loss = lambda s: float(np.mean(np.logaddexp(0, z / s) - want * z / s))
            self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(x @ w[0] + w[1]) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -40, 40)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, and the network from `max_rows` labelled rows at most."""
    table = word_table(*word_sums(docs))
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = materialise(smallest(marked, F.xxhash64(F.lit(5), "doc_id"), max_rows), "quality-rows")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows ids at most
    rows = materialise(rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "quality-sample")

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                x = pooled(piece.column("text"), table)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "quality", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    got = rows.select("doc_id", "quality", "text").mapInArrow(pool, f"doc_id {kinds['doc_id']}, quality {kinds['quality']}, x binary").collect()  # max_rows at most
    got.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"]) for r in got]).reshape(len(got), 2 * DIMENSIONS + len(LAGS) + 1)
    return table, Network(x, np.array([float(r["quality"] > 0) for r in got]))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text)."""
    table, network = fit(docs, labels, max_rows)
    model = docs.sparkSession.sparkContext.broadcast((table, vars(network)))  # of fixed size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, state = model.value
        network = Network.__new__(Network)
        vars(network).update(state)
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                s = network.score(pooled(piece.column("text"), table))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scan, "doc_id long, held_out boolean, score double, predicted int")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
