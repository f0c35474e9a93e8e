"""Quality rules with adaptive thresholds.

Each text gets counts; their ratios are gathered in mergeable quantile sketches per language and
source, and a document is judged against the quartiles of its own group instead of fixed cutoffs:
a ratio far outside them, by ``reach`` times their distance, rejects it. Base rules come first.

Null and empty texts have no words and fail the base rules. A null language or source is a group
of its own. Groups of fewer than ``least_rows`` rows are judged by the merged sketch of their
language, and where that is small too, of the whole table. Copies are judged each. An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import word_list
from etalage.session import write_through

#: Fixed values of the base rules: fewest words, highest percentage of repeated words, window length.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8

#: The ratios that are judged: numerator, denominator, side of the quartiles that is bad, and the
#: least distance between the quartiles that counts. Where nearly all texts agree, a ratio is thus
#: still free to differ by ``reach`` times that much.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words", "both", 1.0),
    "symbols_per_word": ("n_symbols", "n_words", "high", 0.05),
    "capitals_per_char": ("n_capitals", "word_chars", "high", 0.08),
    "dup_line_share": ("n_dup_lines", "n_lines", "high", 0.12),
    "echo_share": ("n_echoes", "n_words", "high", 0.05),
    "repeat_share": ("n_repeat_words", "n_words", "high", 0.06),
}


def count_columns(docs: DataFrame, keep: dict[str, Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of each text."""
    rows = docs.select(
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("_kept"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    )
    rows = rows.select("_kept", "_text", word_list(F.col("_text")).alias("_words"))
    windows = F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    rows = rows.select(
        "_kept",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.size(F.filter("_words", lambda w, i: (i > 0) & (F.get("_words", i - 1) == w))).cast("bigint").alias("n_echoes"),
        lines.alias("_lines"),
        F.when(F.size("_words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("_hashes"),
    )
    rows = rows.withColumn("_repeats", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    # Only texts with some window twice are sorted.
    marked = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_marked", F.when(F.col("_repeats"), marked))
    starts = F.transform(
        "_marked",
        lambda x, i: F.when(
            (F.get("_marked", i + 1)["h"] == x["h"]) | ((i > 0) & (F.get("_marked", i - 1)["h"] == x["h"])), x["i"]
        ),
    )
    rows = rows.withColumn("_starts", F.array_sort(F.filter(starts, lambda i: i.isNotNull())))
    # Each window adds the words up to where the next one begins.
    covered = F.aggregate(
        F.transform("_starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - s, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return rows.select(
        "_kept.*",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_capitals",
        "n_echoes",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def _ratio(name: str) -> Column:
    above, below, _, _ = RATIOS[name]
    return F.col(above) / F.when(F.col(below) > 0, F.col(below))


def _group_key(name: str) -> Column:
    """A column that is never null: joins and groups on it keep null apart from any text."""
    return F.when(F.col(name).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(name)))


def sketches(counts: DataFrame, accuracy: int = 2048, salts: int = 64) -> DataFrame:
    """_lang, _source, n and a sketch of every ratio, over the rows that pass the base rules.

    Each task sketches what it has; the sketches of a group are merged in ``salts`` tasks first and
    then in one, so that no task merges those of all tasks.
    """
    good = counts.where(~base_failed())
    some = good.groupBy(
        _group_key("lang").alias("_lang"), _group_key("source").alias("_source"), (F.spark_partition_id() % salts).alias("_salt")
    ).agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(_ratio(r), F.lit(accuracy)).alias(r) for r in RATIOS])
    return some.groupBy("_lang", "_source").agg(F.sum("n").alias("n"), *_merged())


def _merged() -> list[Column]:
    return [F.kll_merge_agg_double(r).alias(r) for r in RATIOS]


def thresholds(sketched: DataFrame, least_rows: int = 200, reach: float = 5.0) -> DataFrame:
    """_lang, _source and, for every ratio, ``<ratio>_low`` and ``<ratio>_high``; null is no limit."""
    sketched = write_through(sketched, "sketches")
    by_lang = sketched.groupBy("_lang").agg(F.sum("n").alias("n"), *_merged())
    # One row: a sketch of each ratio, whose size does not depend on the data.
    overall = by_lang.agg(*_merged()).first()
    named = by_lang.select("_lang", *[F.col(c).alias(f"lang_{c}") for c in ("n", *RATIOS)])
    levels = sketched.join(named, "_lang")

    def chosen(ratio: str) -> Column:
        return F.when(F.col("n") >= least_rows, F.col(ratio)).when(
            F.col("lang_n") >= least_rows, F.col(f"lang_{ratio}")
        ).otherwise(F.lit(overall[ratio]))

    picked = levels.select("_lang", "_source", *[chosen(r).alias(r) for r in RATIOS])
    limits = []
    for ratio, (_, _, side, least) in RATIOS.items():
        some = F.kll_sketch_get_n_double(F.col(ratio)) > 0
        q1, q3 = (F.when(some, F.kll_sketch_get_quantile_double(F.col(ratio), F.lit(q))) for q in (0.25, 0.75))
        width = F.greatest(q3 - q1, F.lit(least)) * reach
        low = q1 - width if side == "both" else F.lit(None).cast("double")
        limits += [(q3 + width).alias(f"{ratio}_high"), low.alias(f"{ratio}_low")]
    return picked.select("_lang", "_source", *limits)


def judge(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``counts`` with base_failed and kept. A group without limits (none of its rows passes the base
    rules) has nothing to judge."""
    keyed = counts.select("*", _group_key("lang").alias("_lang"), _group_key("source").alias("_source"))
    joined = keyed.join(limits, ["_lang", "_source"], "left")
    bad = F.lit(False)
    for ratio in RATIOS:
        value = _ratio(ratio)
        for outside in (value > F.col(f"{ratio}_high"), value < F.col(f"{ratio}_low")):
            bad = bad | F.coalesce(outside, F.lit(False))
    return joined.select(*counts.columns, base_failed().alias("base_failed"), (~base_failed() & ~bad).alias("kept"))


def quality(docs: DataFrame, keep: dict[str, Column], text: str = "text", **options) -> DataFrame:
    """The columns ``keep`` (besides lang and source), the counts, base_failed and kept of every row of ``docs``."""
    own = {**keep, "lang": F.col("lang"), "source": F.col("source")}
    counts = write_through(count_columns(docs, own, text), "counts")
    limits = write_through(thresholds(sketches(counts), **options), "limits")
    return judge(counts, limits)
