"""Benchmark decontamination by spaced seeds [DataFrame functions only].

1. Each mask keeps some positions of a window of words and ignores the others, so that a window still
   hashes to the same value after a substitution at an ignored position. Masked windows of the test
   items (few, and counted before they are broadcast) meet those of all texts in a hash join.
2. A hit aligns an item with a text. Around it the whole item is compared word by word: its words that
   stand at their aligned place, over all alignments that a hit supports, are counted.
3. A text is contaminated by an item if at least `MIN_PERCENT` of the item's words are found so, or if one
   alignment has a run of `RUN` words of the item of which all but one agree, so that a part of a long item
   counts, too. The masks hit every such run.

Words are lower-cased runs of letters and digits. Items shorter than the masks are looked for as a whole: from
`SHORT` words on by three masks that ignore every third word, so that one changed word is tolerated
(`SHORT_PERCENT`); with fewer words, exactly.

Defined cases: null and empty texts and items without a word match nothing; repeated rows and ties
give one result row for each doc_id and item_id; a null doc_id or item_id is a value like any other; an
empty table gives an empty result; other columns are ignored by `overlaps` and kept by `keep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise

#: The masks; 1 keeps a word's position, 0 ignores it.
MASKS = ("11101101011", "11011100111", "11110010111")
SPAN = len(MASKS[0])
MIN_PERCENT = 60
RUN = 13
SHORT = 8
SHORT_PERCENT = 85
#: Seeds and hits are broadcast up to these numbers of rows, and joined by a shuffle beyond them.
BROADCAST_SEEDS = 2_000_000
BROADCAST_HITS = 1_000_000


def words(text: str = "text") -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _seeds(rows: DataFrame, keep: list[str], masks: list[str]) -> DataFrame:
    """keep, seed and pos of each masked window; rows: keep and the words `_w`. Each word is put beside those that
    follow it, so that all masks of its window are hashed by generated code after one explode."""
    wide = max(map(len, masks))
    hashed = rows.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    shifted = [F.slice("_h", j + 1, F.greatest(F.size("_h"), F.lit(1))).alias(f"c{j}") for j in range(wide)]
    beside = hashed.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "_z")).select(*keep, "pos", "_z.*")
    whole = lambda k, m: F.xxhash64(F.lit(k), *[F.col(f"c{j}") for j, c in enumerate(m) if c == "1"])
    found = [F.when(F.col(f"c{len(m) - 1}").isNotNull(), whole(k, m)) for k, m in enumerate(masks)]
    return beside.select(*keep, F.explode(F.array(*found)).alias("seed"), "pos").where("seed IS NOT NULL")


def short_masks(n: int) -> list[str]:
    """Masks of an item of n words, fewer than `SPAN`."""
    return ["".join("0" if j % 3 == r else "1" for j in range(n)) for r in range(3)] if n >= SHORT else ["1" * n]


def _limited(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def _found(docs: DataFrame, benchmark: DataFrame, min_percent: int) -> DataFrame:
    """The items of each doc_id and text (`_text`, its hash), with their matched words."""
    items = materialise(benchmark.select("item_id", words().alias("_w")).where("size(_w) > 0").distinct(), "bench-items")
    short = sorted(r[0] for r in items.where(F.size("_w") < SPAN).select(F.size("_w")).distinct().collect())  # SPAN - 1 values at most
    own_masks = [m for n in short for m in short_masks(n)]
    masks = [*MASKS, *own_masks]
    wanted = _seeds(items.where(F.size("_w") >= SPAN), ["item_id", "_w"], list(MASKS))
    for k, m in enumerate(own_masks, len(MASKS)):
        own = items.where(F.size("_w") == len(m)).withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
        kept = ", ".join(f"get(_h, {j})" for j, c in enumerate(m) if c == "1")
        wanted = wanted.unionByName(own.select("item_id", "_w", F.expr(f"xxhash64({k}, {kept})").alias("seed"), F.lit(0).alias("pos")))
    wanted = wanted.select("item_id", F.xxhash64("_w").alias("_item"), "seed", F.col("pos").alias("item_pos"))
    wanted = _limited(materialise(wanted, "bench-seeds"), BROADCAST_SEEDS)
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), words().alias("_w"))
    found = _seeds(texts, ["doc_id", "_text"], masks).join(wanted, "seed")
    hits = materialise(found.select("doc_id", "_text", "item_id", "_item", (F.col("pos") - F.col("item_pos")).alias("at")).distinct(), "bench-hits")
    aligned = hits.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"), "item_id", "_item", "at")
    aligned = _limited(aligned, BROADCAST_HITS)
    source = docs.select("doc_id", "text").withColumn("_text", F.xxhash64("text"))
    both = source.join(aligned, source["doc_id"].eqNullSafe(F.col("_d")) & (source["_text"] == F.col("_t")))
    both = both.select("doc_id", "_text", "item_id", "_item", "at", words().alias("_w"))
    named = items.select(F.col("item_id").alias("_id"), F.xxhash64("_w").alias("_item2"), F.col("_w").alias("_v"))
    both = both.join(named, both["item_id"].eqNullSafe(named["_id"]) & (both["_item"] == named["_item2"]))
    same = F.expr("filter(sequence(0, size(_v) - 1), j -> get(_w, at + j) = get(_v, j))")
    run = F.expr(f"size(_s) >= {RUN - 1} AND exists(sequence(0, greatest(size(_s) - {RUN - 1}, 0)), i -> get(_s, i + {RUN - 2}) - get(_s, i) < {RUN})")
    placed = both.select("doc_id", "_text", "item_id", "_item", "at", F.size("_v").alias("item_words"), same.alias("_s"))
    placed = placed.select("doc_id", "_text", "item_id", "_item", "at", "item_words", run.alias("_run"), F.explode("_s").alias("_j"))
    per = placed.groupBy("doc_id", "_text", "item_id", "_item", "item_words").agg(
        F.count_distinct("_j").alias("matched_words"), F.min(F.col("at") + F.col("_j")).alias("first_word"), F.max(F.col("at") + F.col("_j")).alias("last_word"),
        F.max("_run").alias("_run"),
    )
    least = F.when(F.col("item_words") < SPAN, F.lit(max(SHORT_PERCENT, min_percent))).otherwise(F.lit(min_percent))
    return per.where(F.col("_run") | (100 * F.col("matched_words") >= least * F.col("item_words")))


def overlaps(docs: DataFrame, benchmark: DataFrame, min_percent: int = MIN_PERCENT) -> DataFrame:
    """doc_id, item_id, matched_words, item_words, first_word, last_word and contaminated (always true):
    one row for each document and the items it holds. Of several texts with one doc_id any counts."""
    per = _found(docs, benchmark, min_percent)
    best = F.max(F.struct("matched_words", "item_words", -F.col("first_word"), "last_word")).alias("b")
    return per.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("b.matched_words").cast("long").alias("matched_words"), F.col("b.item_words").cast("long").alias("item_words"),
        (-F.col("b.col3")).cast("long").alias("first_word"), F.col("b.last_word").cast("long").alias("last_word"), F.lit(True).alias("contaminated"),
    )


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item of `benchmark`, unchanged; of several texts of one doc_id only those that hold one go."""
    gone = _found(docs, benchmark, MIN_PERCENT).select(F.col("doc_id").alias("_gone"), F.col("_text").alias("_gone_text")).distinct()
    gone = _limited(materialise(gone, "bench-gone"), BROADCAST_HITS)
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone")) & (F.xxhash64(docs["text"]) == F.col("_gone_text")), "left_anti")


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def _oracle() -> str:
    split = "list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '')"
    kept = lambda mask: " || ' ' || ".join(f"w[p + {j + 1}]" for j, c in enumerate(mask) if c == "1")
    seeds = lambda t, k: " UNION ALL ".join(
        f"SELECT {k}, '{n}:' || {kept(m)} AS seed, p FROM (SELECT *, unnest(range(0, len(w) - {SPAN - 1})) AS p FROM {t})" for n, m in enumerate(MASKS)
    )
    third = lambda w: f"'s' || n || ':' || r || ':' || array_to_string(list_filter({w}, lambda x, i: (i - 1) % 3 <> r), ' ')"
    return f"""
    WITH d AS (SELECT DISTINCT doc_id, {split} AS w FROM documents), i AS (SELECT DISTINCT item_id, {split} AS w FROM benchmark),
    short AS (SELECT item_id, w, len(w) AS n, r FROM i, (VALUES (0), (1), (2), (3)) t(r) WHERE len(w) BETWEEN 1 AND {SPAN - 1} AND (len(w) >= {SHORT}) = (r < 3)),
    ds AS ({seeds("d", "doc_id, w")} UNION ALL
      SELECT doc_id, w, {third("w[p + 1:p + n]")}, p FROM (SELECT *, unnest(range(0, len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n, r FROM short))),
    bs AS ({seeds("i", "item_id, w")} UNION ALL SELECT item_id, w, {third("w")}, 0 FROM short),
    hits AS (SELECT DISTINCT doc_id, ds.w, item_id, bs.w AS v, ds.p - bs.p AS diag FROM ds JOIN bs USING (seed)),
    same AS (SELECT doc_id, w, item_id, v, diag, j FROM (SELECT *, unnest(range(0, len(v))) AS j FROM hits) WHERE diag + j >= 0 AND w[diag + j + 1] = v[j + 1]),
    placed AS (SELECT *, coalesce(lead(j, {RUN - 2}) OVER (PARTITION BY doc_id, w, item_id, v, diag ORDER BY j) - j < {RUN}, false) AS run FROM same),
    per AS (SELECT doc_id, item_id, len(v) AS item_words, count(DISTINCT j) AS matched_words, min(diag + j) AS first_word, max(diag + j) AS last_word, bool_or(run) AS run FROM placed GROUP BY doc_id, w, item_id, v),
    best AS (SELECT * FROM per WHERE run OR 100 * matched_words >= CASE WHEN item_words < {SPAN} THEN {SHORT_PERCENT} ELSE {MIN_PERCENT} END * item_words
      QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched_words DESC, item_words DESC, first_word, last_word DESC) = 1)
    SELECT doc_id, item_id, matched_words, item_words, first_word, last_word, true AS contaminated FROM best"""


ORACLE = _oracle()
