"""Quality rules whose thresholds adapt to each language and source [DataFrame functions only].

1. Per text, in one row-wise pass without a shuffle: words, word characters, symbols, repeated lines
   and words inside repeated three-word windows.
2. Quantile sketches per (lang, source): integer histograms over fixed bins of each ratio (three significant
   digits, so a quantile is at most 1% off). Counts add up, so sketches merge without error in any order:
   source sketches merge into language sketches and those into one sketch of all rows.
3. A limit follows from the quantiles of its sketch alone: the upper quartile plus `FENCE` times its distance from
   the median, but for shares that most texts lack not less than a tail quantile (`TAIL`, per mille). The limit of
   a group is drawn towards that of its language, and this towards that of all rows, as `NEIGHBOURS` rows would.
   Texts above a limit of their group are rejected by a join with the (small) limits.

Defined cases: null or empty texts have no words, so they fail the base rule; null lang or source is a
group of its own; repeated rows are judged alike; an empty table gives an empty result; columns that
are not named here are ignored by `verdicts` and kept unchanged by `keep`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import materialise

SPACE = "\\x20\\x09-\\x0D"
TRIM = " \t\n\x0b\f\r"
#: Ratios: numerator, denominator, scale (thousandths; the mean word length in hundredths).
FEATURES = {
    "symbols_pm": ("n_symbols", "word_chars", 1000),
    "dup_lines_pm": ("n_dup_lines", "n_lines", 1000),
    "repeats_pm": ("n_repeat_words", "n_words", 1000),
    "word_len_ch": ("word_chars", "n_words", 100),
}
#: Share of a group's rows (per mille) that no limit of these shares falls below.
TAIL = {"symbols_pm": 950, "dup_lines_pm": 995, "repeats_pm": 995}
FENCE = 4
#: Rows that the language counts as in the limit of a group.
NEIGHBOURS = 100
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per input row: the columns in `keep` and the counts of its text."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(TRIM))
    out = docs.select(
        *keep,
        text.alias("_t"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+")).alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"),
    )
    hashes = F.expr(
        "CASE WHEN size(_w) < 3 THEN cast(array() AS array<bigint>) ELSE "
        "transform(sequence(0, size(_w) - 3), i -> xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))) END"
    )
    out = out.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("_h"),
    )
    # windows in hash order, so that equal ones are neighbours; only for texts that repeat any
    ordered = F.expr(
        "CASE WHEN size(array_distinct(_h)) = size(_h) THEN cast(array() AS array<struct<h: bigint, i: int>>) "
        "ELSE sort_array(transform(_h, (h, i) -> struct(h, i))) END"
    )
    out = out.withColumn("_s", ordered).drop("_h")
    starts = F.expr("sort_array(transform(filter(_s, (x, k) -> get(_s, k - 1).h <=> x.h OR get(_s, k + 1).h <=> x.h), x -> x.i))")
    out = out.withColumn("_p", starts).drop("_s")
    covered = F.expr("aggregate(_p, struct(0L AS n, -3 AS last), (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)")
    return out.withColumn("n_repeat_words", covered).drop("_p")


def _bin(n: str, of: str, times: int) -> Column:
    """The ratio, cut to three significant digits."""
    whole = f"(({times} * {n}) div greatest({of}, 1))"
    unit = f"cast(pow(10, greatest(length(cast({whole} AS string)) - 3, 0)) AS bigint)"
    return F.expr(f"{whole} div {unit} * {unit}")


def ratios(m: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.withColumns({"base_failed": failed} | {f: _bin(*ratio) for f, ratio in FEATURES.items()})


def sketches(m: DataFrame) -> DataFrame:
    """Mergeable histograms (lang, source, feature, bin, n) of the rows that pass the base rule."""
    stacked = m.where(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])).alias("x")
    )
    return stacked.groupBy("lang", "source", "x.feature", "x.bin").agg(F.count("*").alias("n"))


def _limits(sketch: DataFrame, by: list[str], rows: str, allowed: str) -> DataFrame:
    """The limit of each feature in the merged sketches of `by`, and their number of rows."""
    w = Window.partitionBy(*by, "feature")
    running = sketch.groupBy(*by, "feature", "bin").agg(F.sum("n").alias("n")).select(
        *by, "feature", "bin", F.sum("n").over(w).alias(rows), F.sum("n").over(w.orderBy("bin")).alias("upto")
    )
    at = lambda share: F.min(F.when(1000 * F.col("upto") >= share * F.col(rows), F.col("bin")))
    tail = reduce(lambda c, kv: c.when(F.col("feature") == kv[0], kv[1]), TAIL.items(), F).otherwise(0)
    q = running.groupBy(*by, "feature").agg(F.first(rows).alias(rows), at(500).alias("q50"), at(750).alias("q75"), at(tail).alias("tail"))
    return q.select(*by, "feature", rows, F.greatest(F.col("q75") + FENCE * (F.col("q75") - F.col("q50")), "tail").alias(allowed))


def _drawn(rows: str, own: str, to: str) -> Column:
    return F.expr(f"({rows} * {own} + {NEIGHBOURS} * {to}) div ({rows} + {NEIGHBOURS})")


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source) with the highest value allowed of each feature."""
    own = _limits(sketch, ["lang", "source"], "rows", "allowed")
    lang = _limits(sketch, ["lang"], "rows_l", "allowed_l").withColumnsRenamed({"lang": "lang_l", "feature": "f_l"})
    every = _limits(sketch, [], "rows_a", "allowed_a").withColumnRenamed("feature", "f_a")
    joined = own.join(lang, own["lang"].eqNullSafe(lang["lang_l"]) & (own["feature"] == lang["f_l"])).join(every, F.col("feature") == F.col("f_a"))
    joined = joined.withColumn("near", _drawn("rows_l", "allowed_l", "allowed_a"))
    joined = joined.withColumn("limit", _drawn("rows", "allowed", "near"))
    return joined.groupBy("lang", "source").agg(*[F.max(F.when(F.col("feature") == f, F.col("limit"))).alias(f"max_{f}") for f in FEATURES])


def verdicts(docs: DataFrame, key: list[str]) -> DataFrame:
    """`key` columns, counts, base_failed and kept of every row."""
    need = list(dict.fromkeys([*key, "lang", "source"]))
    m = materialise(ratios(measures(docs, need)), "quality-measures")
    limits = thresholds(sketches(m)).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    out = m.join(limits, m["lang"].eqNullSafe(limits["_lang"]) & m["source"].eqNullSafe(limits["_source"]), "left")
    fits = reduce(lambda a, b: a & b, [F.col(f) <= F.col(f"max_{f}") for f in FEATURES])
    return out.select(
        *key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(~F.col("base_failed") & fits, F.lit(False)).alias("kept"),
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged. Rows are told apart by doc_id and a hash of the
    text, lang and source, on which the verdict depends."""
    names = docs.columns
    tag = F.xxhash64("text", "lang", "source")
    tagged = docs.withColumn("_tag", tag)
    rejected = verdicts(tagged, ["doc_id", "_tag"]).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("_tag").alias("_tag2")).distinct()
    same = tagged["doc_id"].eqNullSafe(rejected["_id"]) & (tagged["_tag"] == rejected["_tag2"])
    return tagged.join(rejected, same, "left_anti").select(*names)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"), ["doc_id"])


def _oracle() -> str:
    tail = "CASE feature " + " ".join(f"WHEN '{f}' THEN {s}" for f, s in TAIL.items()) + " ELSE 0 END"
    whole = {f: f"(({k} * {n}) // greatest({of}, 1))" for f, (n, of, k) in FEATURES.items()}
    unit = {f: f"power(10, greatest(length({x}::varchar) - 3, 0))::bigint" for f, x in whole.items()}

    def limits(by: str) -> str:
        cols = f"{by}, feature" if by else "feature"
        at = lambda share: f"min(bin) FILTER (WHERE 1000 * upto >= {share} * total)"
        return f"""SELECT {cols}, any_value(total) AS total, greatest({at(750)} + {FENCE} * ({at(750)} - {at(500)}), {at(tail)}) AS allowed
            FROM (SELECT {cols}, bin, sum(n) OVER (PARTITION BY {cols}) AS total, sum(n) OVER (PARTITION BY {cols} ORDER BY bin) AS upto
                  FROM (SELECT {cols}, bin, count(*) AS n FROM stacked GROUP BY {cols}, bin)) GROUP BY {cols}"""

    drawn = lambda n, own, to: f"({n} * {own} + {NEIGHBOURS} * {to}) // ({n} + {NEIGHBOURS})"
    fits = " AND ".join(f"{f} <= max(CASE WHEN t.feature = '{f}' THEN t.allowed END)" for f in FEATURES)
    return f"""
    WITH w AS (
      SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM documents),
    g AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    m AS (
      SELECT w.r, doc_id, lang, source, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
        len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cov USING (r)),
    f AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
        {", ".join(f"{whole[f]} // {unit[f]} * {unit[f]} AS {f}" for f in FEATURES)} FROM m),
    stacked AS ({" UNION ALL ".join(f"SELECT lang, source, '{f}' AS feature, {f} AS bin FROM f WHERE NOT base_failed" for f in FEATURES)}),
    own AS ({limits("lang, source")}), la AS ({limits("lang")}), al AS ({limits("")}),
    t AS (SELECT own.lang, own.source, own.feature, {drawn("own.total", "own.allowed", drawn("la.total", "la.allowed", "al.allowed").join("()"))} AS allowed
      FROM own JOIN la ON own.lang IS NOT DISTINCT FROM la.lang AND own.feature = la.feature JOIN al ON own.feature = al.feature)
    SELECT any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
      any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed,
      coalesce(NOT any_value(base_failed) AND {" AND ".join(f"any_value({f}) <= max(CASE WHEN t.feature = '{f}' THEN t.allowed END)" for f in FEATURES)}, false) AS kept
    FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source GROUP BY r"""


ORACLE = _oracle()
