"""Operator 9: quality rules with adaptive thresholds.

The base statistics of every whole text are counted by vectorised kernels. For
each (language, source) and statistic a log-bucket quantile sketch (relative
error 1 %) is built: its counts add up, so partial sketches merge in any order
to the same result. The quartiles give fences (quartile -/+ 3 interquartile
ranges, never narrower than a stated slack) that replace fixed cut-offs, and
the documents are joined with the fences of their group and filtered.

A group that is partly junk must not set its fence by the junk. So a second
fence bounds the first: its sketch is that of the group and, weighing ``PRIOR``
documents, ``POINTS`` even quantiles of the language's sketch, which in turn holds
those of the whole corpus; and the quartile on the fence's side is the other
one mirrored at the median, which junk on one side moves little until it is
half of the group. A group of a few documents is thus judged by its language,
a rare language by the corpus, large ones by themselves, without a switch.
Documents of a kind that is less than half of its group and far above the rest
are, to this rule, junk.

A hot (language, source) is pre-aggregated to at most a sketch per task before
the shuffle. The fences have one row per group; they are broadcast only if
their count, checked at run time, is at most ``BROADCAST_GROUPS``.

Defined results: a null text has no words and fails the base rule; a null
language or source is a group of its own; a statistic without a value (no
words) is in no sketch and not tested; repeated rows are judged alike; an empty
table gives no rows; other columns never clash with the operator's own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.llm import kernels as K
from aisle.llm.store import kept, packed

WINDOW = 5
MIN_WORDS = 10
MOST_REPEAT_PCT = 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True

BROADCAST_GROUPS = 20_000
ERROR = 0.01                                  # of the sketch, relative
GAMMA = (1 + ERROR) / (1 - ERROR)
ZERO_BUCKET = -1_000_000                      # of values <= 0
REACH = 3.0                                   # interquartile ranges
PRIOR, POINTS = 48, 8                         # documents that a parent's quantiles weigh, and their number

#: statistic -> (value, least slack below the lower quartile, above the upper one)
STATISTICS: dict[str, tuple[str, float | None, float | None]] = {
    "mean_word": ("try_divide(word_chars, n_words)", 2.5, 5.0),
    "symbol_share": ("try_divide(n_symbols, n_words)", None, 0.3),
    "dup_line_share": ("try_divide(n_dup_lines, n_lines)", None, 0.4),
    "upper_share": ("try_divide(n_upper, word_chars)", None, 0.4),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _repeats(wh: np.ndarray, wdoc: np.ndarray, n: int) -> np.ndarray:
    """Words inside a 5-word window that its document has twice or more."""
    h, at = K.word_grams(wh, wdoc, WINDOW)
    if len(h) == 0:
        return np.zeros(n, np.int64)
    key = K.mix(h ^ (wdoc[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    ranked = key[order]
    twin = np.zeros(len(key), bool)
    same = ranked[1:] == ranked[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    first = at[order[twin]]
    cover = np.zeros(len(wh) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + WINDOW, -1)
    return K.per_doc_sum((np.cumsum(cover)[:-1] > 0).astype(np.int64), wdoc, n)


def _dup_lines(t: K.Texts, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line."""
    s, e, doc = K.lines(t)
    if len(s) == 0:
        return np.zeros(t.n, np.int64), np.zeros(t.n, np.int64)
    text = np.concatenate(([0], np.cumsum(~K.IS_SPACE[t.data])))
    full = text[e] > text[s]
    s, e, doc = s[full], e[full], doc[full]
    n_lines = np.bincount(doc, minlength=t.n)
    key = K.mix(K.span_hash(prefix, s, e) ^ (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    return n_lines, n_lines - np.bincount(doc[first], minlength=t.n)


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for every text."""
    parts: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS}
    for _, t in K.slices(texts):
        s, e, wdoc = K.words(t)
        prefix = K.prefix_hash(t)
        wh = K.span_hash(prefix, s, e)
        n_lines, dup = _dup_lines(t, prefix)
        parts["n_words"].append(np.bincount(wdoc, minlength=t.n))
        parts["word_chars"].append(K.per_doc_bytes(t, ~K.IS_SPACE[t.data] & ((t.data & 0xC0) != 0x80)))
        parts["n_symbols"].append(K.per_doc_bytes(t, SYMBOLS[t.data]))
        parts["n_upper"].append(K.per_doc_bytes(t, UPPER[t.data]))
        parts["n_lines"].append(n_lines)
        parts["n_dup_lines"].append(dup)
        parts["n_repeat_words"].append(_repeats(wh, wdoc, t.n))
    return {c: np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64) for c, v in parts.items()}


def with_counts(rows: DataFrame, keep_text: bool) -> DataFrame:
    """``rows`` (with a column ``text``) and their counts."""
    out = [f for f in rows.schema.fields if keep_text or f.name != "text"]

    def run(batches):
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            counts = count_texts(text)
            cols = [b.column(b.schema.get_field_index(f)) for f in names]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(counts[c]) for c in COUNTS]], names=[*names, *COUNTS])

    names = [f.name for f in out]
    return rows.mapInArrow(run, T.StructType([*out, *[T.StructField(c, T.LongType()) for c in COUNTS]]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEAT_PCT)


def sketches(counted: DataFrame) -> DataFrame:
    """Rows (lang, source, statistic, bucket, n): the merged sketches of the
    documents that pass the base rule."""
    bucket = lambda v: F.when(v <= 0, ZERO_BUCKET).otherwise(F.ceil(F.log(v) / math.log(GAMMA))).cast("int")
    values = F.array(*[F.struct(F.lit(s).alias("statistic"), F.expr(x).cast("double").alias("v"))
                       for s, (x, _, _) in STATISTICS.items()])
    return (counted.filter(~base_failed()).select("lang", "source", F.explode(values).alias("x"))
            .filter(F.col("x.v").isNotNull())
            .groupBy("lang", "source", F.col("x.statistic").alias("statistic"), bucket(F.col("x.v")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def quantile(q: float, upto: str = "_upto", everything: str = "_all") -> Column:
    """Aggregate: the value of the first bucket that reaches rank q * n."""
    b = F.min(F.when(F.col(upto) >= F.ceil(F.col(everything) * q), F.col("bucket")))
    return F.when(b == ZERO_BUCKET, 0.0).otherwise(F.pow(F.lit(GAMMA), b) * (2 / (1 + GAMMA)))


def _summed(sketch: DataFrame, group: list[str], n: str = "n", upto: str = "_upto", everything: str = "_all") -> DataFrame:
    """``sketch`` with its running and whole sums. A window reads one sketch, whose
    size its error bounds."""
    w = Window.partitionBy(*group, "statistic")
    return (sketch.withColumn(everything, F.sum(n).over(w))
            .withColumn(upto, F.sum(n).over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))))


def _points(sketch: DataFrame, group: list[str]) -> DataFrame:
    """(group, statistic, bucket, n): ``POINTS`` even quantiles that weigh ``PRIOR`` documents."""
    at = [F.min(F.when(F.col("_upto") * (2 * POINTS) >= F.col("_all") * k, F.col("bucket"))) for k in range(1, 2 * POINTS, 2)]
    return (_summed(sketch, group).groupBy(*group, "statistic").agg(F.array(*at).alias("_at"))
            .select(*group, "statistic", F.explode("_at").alias("bucket"), F.lit(PRIOR // POINTS).cast("long").alias("n")))


def with_parents(merged: DataFrame) -> DataFrame:
    """Rows (lang, source, statistic, bucket, own, n): the group's sketch (``own``),
    and the same with its parents' quantiles (``n``)."""
    corpus = _points(merged.groupBy("statistic", "bucket").agg(F.sum("n").alias("n")), [])      # 32 rows
    langs = merged.groupBy("lang", "statistic", "bucket").agg(F.sum("n").alias("n"))
    langs = langs.unionByName(langs.select("lang", "statistic").distinct().join(F.broadcast(corpus), "statistic"))
    above = kept(_points(langs, ["lang"])).withColumnsRenamed({"lang": "_lang", "statistic": "_statistic"})
    if above.count() <= BROADCAST_GROUPS:
        above = F.broadcast(above)
    groups = merged.select("lang", "source", "statistic").distinct()
    more = groups.join(above, groups["lang"].eqNullSafe(above["_lang"]) & (groups["statistic"] == above["_statistic"]))
    return (merged.withColumn("own", F.col("n"))
            .unionByName(more.drop("_lang", "_statistic").withColumn("own", F.lit(0).cast("long"))))


def fences(merged: DataFrame) -> DataFrame:
    """(lang, source, <statistic>_lo, <statistic>_hi): one row per group."""
    group = ["lang", "source"]
    both = _summed(_summed(with_parents(kept(merged)), group), group, "own", "_upto_own", "_own")
    q = both.groupBy(*group, "statistic").agg(
        *[quantile(x, "_upto_own", "_own").alias(f"q{i}") for i, x in ((1, 0.25), (3, 0.75))],
        *[quantile(x).alias(f"m{i}") for i, x in ((1, 0.25), (2, 0.5), (3, 0.75))])
    spread = (F.col("q3") - F.col("q1")) * REACH
    under, over = F.col("m2") - F.col("m1"), F.col("m3") - F.col("m2")
    cols = []
    for s, (_, below, above) in STATISTICS.items():
        this = F.col("statistic") == s
        if below is not None:
            lo = F.greatest(F.col("q1") - F.greatest(spread, F.lit(below)),
                            F.col("m2") - over - F.greatest(over * (2 * REACH), F.lit(below)))
            cols.append(F.max(F.when(this, lo)).alias(f"{s}_lo"))
        if above is not None:
            hi = F.least(F.col("q3") + F.greatest(spread, F.lit(above)),
                         F.col("m2") + under + F.greatest(under * (2 * REACH), F.lit(above)))
            cols.append(F.max(F.when(this, hi)).alias(f"{s}_hi"))
    return q.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*cols)


def judged(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``."""
    limits = kept(limits)
    side = F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits
    cond = counted["lang"].eqNullSafe(side["_lang"]) & counted["source"].eqNullSafe(side["_source"])
    ok = F.lit(True)
    for s, (x, below, above) in STATISTICS.items():
        v = F.expr(x).cast("double")
        if below is not None:
            ok = ok & F.coalesce(v >= F.col(f"{s}_lo"), F.lit(True))
        if above is not None:
            ok = ok & F.coalesce(v <= F.col(f"{s}_hi"), F.lit(True))
    joined = counted.join(side, cond, "left")
    return (joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ok)
            .drop(*limits.columns))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. The counts are
    made twice (for the fences, then beside the whole rows) so that no text is
    shuffled or written in between."""
    light = with_counts(docs.select("lang", "source", "text"), keep_text=False)
    limits = fences(sketches(light))
    rows = packed(docs, lang=F.col("lang"), source=F.col("source"), text=F.col("text"))
    return judged(with_counts(rows, keep_text=False), limits).filter("kept").select("_row.*")


def op9_adaptive_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "text")
    counted = kept(with_counts(docs, keep_text=False))
    return judged(counted, fences(sketches(counted))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _fence_sql() -> tuple[str, str, str]:
    """(values of the statistics, fence columns, conditions) for ``SQL``."""
    values, cols, ok = [], [], []
    for s, (x, below, above) in STATISTICS.items():
        a, b = x.removeprefix("try_divide(").removesuffix(")").split(", ")
        v = f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / {b} END"
        values.append(f"{{'stat': '{s}', 'v': {v}}}")
        for side, slack, sign, q, cmp in (("lo", below, "-", "q1", ">="), ("hi", above, "+", "q3", "<=")):
            if slack is not None:
                half, pick = ("(m3 - m2)", "greatest") if side == "lo" else ("(m2 - m1)", "least")
                cols.append(f"max({pick}({q} {sign} greatest((q3 - q1) * {REACH}::DOUBLE, {slack}::DOUBLE), "
                            f"m2 {sign} {half} {sign} greatest({half} * {2 * REACH}::DOUBLE, {slack}::DOUBLE))) "
                            f"FILTER (stat = '{s}') AS {s}_{side}")
                ok.append(f"coalesce({v} {cmp} {s}_{side}, true)")
    return ", ".join(values), ", ".join(cols), " AND ".join(ok)


_VALUES, _COLS, _OK = _fence_sql()
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
          FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= {WINDOW})),
twins AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT i + j) AS n FROM twins, range(0, {WINDOW}) AS o(j) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
          FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (SELECT doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n_dup, 0) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
      FROM d LEFT JOIN lines l USING (rid) LEFT JOIN repeats r USING (rid)),
x AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT_PCT} * n_words AS base_failed FROM c),
v AS (SELECT lang, source, s.stat AS stat,
             CASE WHEN s.v <= 0 THEN {ZERO_BUCKET} ELSE CAST(ceil(ln(s.v) / {math.log(GAMMA)!r}::DOUBLE) AS INTEGER) END AS b
      FROM (SELECT lang, source, unnest([{_VALUES}]) AS s FROM x WHERE NOT base_failed) WHERE s.v IS NOT NULL),
sk AS (SELECT lang, source, stat, b, count(*) AS n FROM v GROUP BY ALL),
cs AS (SELECT stat, b, sum(n) AS n FROM sk GROUP BY ALL),
cp AS (SELECT stat, k, min(b) AS b FROM (SELECT stat, b, sum(n) OVER (PARTITION BY stat ORDER BY b) AS upto, sum(n) OVER (PARTITION BY stat) AS n FROM cs),
                                        range(1, {2 * POINTS}, 2) AS t(k) WHERE upto * {2 * POINTS} >= n * k GROUP BY stat, k),
ls AS (SELECT lang, stat, b, sum(n) AS n FROM (
         SELECT lang, stat, b, n FROM sk
         UNION ALL SELECT lang, stat, b, {PRIOR // POINTS} FROM (SELECT DISTINCT lang, stat FROM sk) JOIN cp USING (stat)) GROUP BY ALL),
lp AS (SELECT lang, stat, k, min(b) AS b
       FROM (SELECT lang, stat, b, sum(n) OVER (PARTITION BY lang, stat ORDER BY b) AS upto, sum(n) OVER (PARTITION BY lang, stat) AS n FROM ls),
            range(1, {2 * POINTS}, 2) AS t(k) WHERE upto * {2 * POINTS} >= n * k GROUP BY lang, stat, k),
gs AS (SELECT lang, source, stat, b, sum(own) AS own, sum(n) AS n FROM (
         SELECT lang, source, stat, b, n AS own, n FROM sk
         UNION ALL SELECT g.lang, g.source, g.stat, lp.b, 0, {PRIOR // POINTS}
         FROM (SELECT DISTINCT lang, source, stat FROM sk) AS g JOIN lp ON g.lang IS NOT DISTINCT FROM lp.lang AND g.stat = lp.stat) GROUP BY ALL),
r AS (SELECT *, CASE WHEN b = {ZERO_BUCKET} THEN 0.0 ELSE pow({GAMMA!r}::DOUBLE, b) * {2 / (1 + GAMMA)!r}::DOUBLE END AS y,
             sum(own) OVER o AS upto_own, sum(own) OVER w AS all_own, sum(n) OVER o AS upto, sum(n) OVER w AS n_all
      FROM gs WINDOW w AS (PARTITION BY lang, source, stat), o AS (PARTITION BY lang, source, stat ORDER BY b)),
q AS (SELECT lang, source, stat, min(y) FILTER (upto_own >= ceil(all_own * 0.25)) AS q1, min(y) FILTER (upto_own >= ceil(all_own * 0.75)) AS q3,
             min(y) FILTER (upto >= ceil(n_all * 0.25)) AS m1, min(y) FILTER (upto >= ceil(n_all * 0.5)) AS m2,
             min(y) FILTER (upto >= ceil(n_all * 0.75)) AS m3
      FROM r GROUP BY lang, source, stat),
f AS (SELECT lang AS f_lang, source AS f_source, {_COLS} FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_OK} AS kept
FROM x LEFT JOIN f ON x.lang IS NOT DISTINCT FROM f_lang AND x.source IS NOT DISTINCT FROM f_source"""
