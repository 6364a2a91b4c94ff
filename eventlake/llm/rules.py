"""Quality rules whose thresholds follow each language and source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import settle

#: White space that ends a word, and the characters that count as symbols.
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

LEAST_WORDS = 50

#: Metric to its place in the sketch: whole numbers, from 0 to the last bin, which also
#: holds whatever is larger. Shares are in thousandths, word lengths in hundredths.
METRICS = {
    "symbol_share": "least(1000 * n_symbols div greatest(word_chars, 1), 1000)",
    "dup_line_share": "least(1000 * n_dup_lines div greatest(n_lines, 1), 1000)",
    "repeat_share": "least(1000 * n_repeat_words div greatest(n_words, 1), 1000)",
    "word_length": "least(100 * word_chars div greatest(n_words, 1), 5000)",
}
#: Threshold of what most documents have none of: the quantile that one document in TAIL exceeds,
#: half as much again, and one bin.
TAIL = 64
#: Metrics of which too little is as odd as too much. Their thresholds lie this many times the
#: distance of the quartiles beyond these, and one bin.
BOTH_WAYS = ["word_length"]
REACH = 4
#: Documents that the level above counts for when a group's thresholds are blended with it.
PRIOR = 100

#: Levels at which sketches are kept, from the finest.
LEVELS = (["lang", "source"], ["lang"], [])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of its whole texts: n_words, word_chars, n_symbols,
    n_lines (lines with a word), n_dup_lines, n_repeat_words. A null text counts as empty.

    Three-word windows are compared by 64-bit hash within one text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, " " + SPACES, "")) > 0
    )
    counted = docs.withColumns(
        {
            "words": words,
            "lines": lines,
            "word_chars": F.length(F.translate(text, " " + SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    )
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"),
            i.alias("at"),
        ),
    )
    counted = counted.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "windows": F.sort_array(windows),
        }
    )
    repeated = F.filter(
        "windows",
        lambda w, i: (w["hash"] == F.get("windows", i - 1)["hash"])
        | (w["hash"] == F.get("windows", i + 1)["hash"]),
    )
    covered = F.transform(
        repeated, lambda w: F.array(w["at"], w["at"] + 1, w["at"] + 2)
    )
    n_repeat = F.size(F.array_distinct(F.flatten(covered))).cast("long")
    return counted.withColumn("n_repeat_words", n_repeat).drop("words", "lines", "windows")


def _bins() -> Column:
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.expr(value).cast("int").alias("bin"))
        for name, value in METRICS.items()
    ]
    return F.inline(F.array(*pairs))


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, docs): a quantile sketch per group and metric, as the
    number of documents in each bin. Sketches merge by adding; a quantile read from one
    is exact to the bin. Documents that fail the base rules are not in it."""
    sound = counts.filter(~base_failed())
    return (
        sound.select("lang", "source", _bins())
        .groupBy("lang", "source", "metric", "bin")
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, <metric>_low, <metric>_high) of every group in the sketch.

    Each level has fences of its own, the lower levels' sketches being merged. Those of a language
    are blended with those of all, and those of a group with those of its language, by documents:
    a small group follows its language, a large one itself, and between them there is no step.
    """
    found = sketch.select("lang", "source").distinct().select(
        "*", F.explode(F.array(*map(F.lit, METRICS))).alias("metric")
    )
    low = high = F.lit(None).cast("double")
    for depth, level in reversed(list(enumerate(LEVELS))):
        limits = _limits(sketch, level)
        names = {c: f"{c}{depth}" for c in limits.columns}
        keys = [*level, "metric"]
        same = [F.col(c).eqNullSafe(F.col(names[c])) for c in keys]
        found = found.join(limits.withColumnsRenamed(names), reduce(Column.__and__, same), "left")
        low, high = (_blended(F.col(f"{end}{depth}"), F.col(f"docs{depth}"), above)
                     for end, above in (("low", low), ("high", high)))
    by_metric = found.select("lang", "source", "metric", low.alias("low"), high.alias("high"))
    ends = [
        F.max(F.when(F.col("metric") == metric, F.col(end))).alias(f"{metric}_{end}")
        for metric in METRICS
        for end in ("low", "high")
    ]
    return by_metric.groupBy("lang", "source").agg(*ends)


def _blended(own: Column, docs: Column, above: Column) -> Column:
    """``own`` of so many documents, and ``above`` as if of PRIOR ones."""
    both = (docs * own + F.lit(float(PRIOR)) * above) / (docs + F.lit(float(PRIOR)))
    return F.coalesce(both, own, above)


def _limits(sketch: DataFrame, level: list[str]) -> DataFrame:
    """(<level>, metric, docs, low, high) from the sketches of ``level``, those below it
    merged. A group has at most as many rows as there are bins."""
    merged = sketch.groupBy(*level, "metric", "bin").agg(F.sum("docs").alias("docs"))
    group = Window.partitionBy(*level, "metric")
    running = F.sum("docs").over(group.orderBy("bin"))
    total = F.sum("docs").over(group)
    ranked = merged.select(*level, "metric", "bin", running.alias("rank"), total.alias("total"))
    quantile = {
        name: F.min(F.when(of * F.col("rank") >= part * F.col("total"), F.col("bin"))).cast("double")
        for name, part, of in (("q1", 1, 4), ("q3", 3, 4), ("top", TAIL - 1, TAIL))
    }
    found = ranked.groupBy(*level, "metric").agg(
        F.max("total").cast("double").alias("docs"), *[q.alias(n) for n, q in quantile.items()]
    )
    reach = REACH * (F.col("q3") - F.col("q1")) + 1
    both_ways = F.col("metric").isin(BOTH_WAYS)
    high = F.when(both_ways, F.col("q3") + reach).otherwise(F.col("top") * 1.5 + 1)
    low = F.when(both_ways, F.col("q1") - reach)
    return found.select(*level, "metric", "docs", low.alias("low"), high.alias("high"))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept) of every row of ``docs`` (doc_id, text, lang, source).

    A document is kept if it passes the base rules and none of its metrics lies beyond
    the thresholds of its language and source. Null languages and sources are groups like
    any other; null and empty texts fail the base rules; repeated rows each count.
    Only built-in functions are used.
    """
    counts = settle(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "counts")
    limits = thresholds(settle(sketches(counts), "sketches")).withColumnsRenamed(
        {"lang": "group_lang", "source": "group_source"}
    )
    same = F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(
        F.col("group_source")
    )
    within = F.lit(True)
    for name, value in METRICS.items():
        within &= F.coalesce(F.expr(value) >= F.col(f"{name}_low"), F.lit(True))
        within &= F.coalesce(F.expr(value) <= F.col(f"{name}_high"), F.lit(True))
    kept = ~base_failed() & within
    return counts.join(limits, same, "left").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        kept.alias("kept"),
    )


ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text
    FROM documents
), counted AS (
    SELECT r, doc_id, lang, source,
           regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM docs
), word AS (
    SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM counted
), windows AS (
    SELECT r, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
    FROM word WINDOW o AS (PARTITION BY r ORDER BY i)
), again AS (
    SELECT r, i FROM windows WHERE w3 IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY r, w, w2, w3) > 1
), covered AS (
    SELECT r, count(DISTINCT i + d) AS n
    FROM again CROSS JOIN (VALUES (0), (1), (2)) AS steps(d) GROUP BY r
), counts AS (
    SELECT doc_id, lang, source, len(words) AS n_words, word_chars, n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words
    FROM counted LEFT JOIN covered USING (r)
), metrics AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           least(1000 * n_symbols // greatest(word_chars, 1), 1000) AS m1,
           least(1000 * n_dup_lines // greatest(n_lines, 1), 1000) AS m2,
           least(1000 * n_repeat_words // greatest(n_words, 1), 1000) AS m3,
           least(100 * word_chars // greatest(n_words, 1), 5000) AS m4
    FROM counts
), sound AS (SELECT * FROM metrics WHERE NOT base_failed
), long AS (
    SELECT lang, source, 1 AS m, m1 AS v FROM sound UNION ALL
    SELECT lang, source, 2, m2 FROM sound UNION ALL
    SELECT lang, source, 3, m3 FROM sound UNION ALL
    SELECT lang, source, 4, m4 FROM sound
), quantiles AS (
    SELECT grouping(lang, source) AS level, lang, source, m, count(*)::DOUBLE AS n,
           quantile_disc(v, 0.25)::DOUBLE AS q1, quantile_disc(v, 0.75)::DOUBLE AS q3,
           quantile_disc(v, 0.984375)::DOUBLE AS top
    FROM long GROUP BY GROUPING SETS ((lang, source, m), (lang, m), (m))
), fences AS (
    SELECT level, lang, source, m, n,
           CASE WHEN m = 4 THEN q3 + 4 * (q3 - q1) + 1 ELSE top * 1.5::DOUBLE + 1 END AS high,
           CASE WHEN m = 4 THEN q1 - 4 * (q3 - q1) - 1 END AS low
    FROM quantiles
), joined AS (
    SELECT g.lang, g.source, g.m, a.n AS n0, a.low AS low0, a.high AS high0,
           b.n AS n1, b.low AS low1, b.high AS high1, c.low AS low2, c.high AS high2
    FROM (SELECT DISTINCT lang, source, m FROM sound, range(1, 5) AS metrics(m)) g
    LEFT JOIN fences a ON a.level = 0 AND a.m = g.m AND a.lang IS NOT DISTINCT FROM g.lang
                       AND a.source IS NOT DISTINCT FROM g.source
    LEFT JOIN fences b ON b.level = 1 AND b.m = g.m AND b.lang IS NOT DISTINCT FROM g.lang
    LEFT JOIN fences c ON c.level = 3 AND c.m = g.m
), by_lang AS (
    SELECT *, coalesce((n1 * low1 + 100.0::DOUBLE * low2) / (n1 + 100.0::DOUBLE), low1, low2) AS low12,
           coalesce((n1 * high1 + 100.0::DOUBLE * high2) / (n1 + 100.0::DOUBLE), high1, high2) AS high12
    FROM joined
), best AS (
    SELECT lang, source, m,
           coalesce((n0 * low0 + 100.0::DOUBLE * low12) / (n0 + 100.0::DOUBLE), low0, low12) AS low,
           coalesce((n0 * high0 + 100.0::DOUBLE * high12) / (n0 + 100.0::DOUBLE), high0, high12) AS high
    FROM by_lang
), wide AS (
    SELECT lang, source, max(high) FILTER (m = 1) AS h1, max(high) FILTER (m = 2) AS h2,
           max(high) FILTER (m = 3) AS h3, max(low) FILTER (m = 4) AS l4,
           max(high) FILTER (m = 4) AS h4
    FROM best GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(m1 <= h1, true) AND coalesce(m2 <= h2, true)
           AND coalesce(m3 <= h3, true) AND coalesce(m4 >= l4, true) AND coalesce(m4 <= h4, true)
           AS kept
FROM metrics LEFT JOIN wide ON metrics.lang IS NOT DISTINCT FROM wide.lang
                           AND metrics.source IS NOT DISTINCT FROM wide.source
"""
