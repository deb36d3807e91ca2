"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document gets measures in whole thousandths (so all sums and thresholds are exact and
reruns agree). Per language and source, every measure has a quantile sketch: a histogram
with exact bins for small values and 11 leading bits for larger ones (relative error below
0.1 %). Such histograms add up bin by bin, so they merge in any order over any split of the
rows. A group's thresholds are outer fences, the quartiles widened by ``REACH`` times their
distance (at least ``SPREAD`` of the measure), instead of fixed cutoffs; the sketches'
thresholds are joined back and a document beyond one of them is rejected.

Defined results: a null or empty text has no words, fails the base rules and enters no
sketch. Null languages and sources are groups of their own. Rows given twice count twice and
are judged alike. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcat.llm.support import stage

#: Characters that end words, and characters counted as symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[^#*$%&|<>]+"
#: Quartile distances beyond a quartile at which a document is rejected.
REACH = 3
#: Per measure: the least quartile distance that counts (thousandths), and whether low values are rejected too.
SPREAD = {"word_length": (500, True), "symbols": (30, False), "dup_lines": (120, False), "repeats": (120, False), "capitals": (80, False)}
#: Values below 2**BITS have bins of their own.
BITS = 11


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def base(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` and the base counts of each row's whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("text_"), words(F.col("text").cast("string")).alias("words_"))
    rows = rows.select(
        *keep, F.size("words_").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text_", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text_", SYMBOL, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text_", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.filter(F.split("text_", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines_"),
        F.transform("words_", lambda w: F.xxhash64(w)).alias("hash_"))
    rows = rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_capitals", F.size("lines_").cast("long").alias("n_lines"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.expr("case when n_words < 4 then array() else transform(slice(hash_, 1, cast(n_words as int) - 2), "
               "(x, i) -> xxhash64(x, hash_[i + 1], hash_[i + 2])) end").alias("window_"))
    return rows.select(*[c for c in rows.columns if c != "window_"], repeated("window_").alias("n_repeat_words"))


def repeated(windows: str) -> Column:
    """Words inside three-word windows that occur twice or more, from the windows' hashes in
    text order: sorted with their places, equal neighbours give the places of repeats."""
    return F.expr(f"""
        if(size(array_distinct({windows})) = size({windows}), 0L, cast(size(array_distinct(flatten(
            transform(array(sort_array(transform({windows}, (h, i) -> struct(h, i)))), s -> flatten(
                transform(s, (e, k) -> if(get(s, k - 1).h <=> e.h or get(s, k + 1).h <=> e.h,
                                          array(e.i, e.i + 1, e.i + 2), cast(array() as array<int>)))))))) as bigint))""")


def measures(rows: DataFrame) -> DataFrame:
    """The measures in thousandths, null without words."""
    def share(a: str, b: str) -> Column:
        return F.expr(f"if(n_words > 0, cast(1000 * {a} as bigint) div greatest({b}, 1L), null)")

    return rows.withColumns({"word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"),
                             "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
                             "capitals": share("n_capitals", "word_chars")})


def bin_of(value: str) -> str:
    """The sketch's bin of a value (SQL): its lower end."""
    shift = f"greatest(length(bin({value})) - {BITS}, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, low, high) from the merged sketches."""
    names = ", ".join(f"'{m}', {m}" for m in SPREAD)
    sketch = (rows.where("n_words > 0").select("lang", "source", F.expr(f"stack({len(SPREAD)}, {names}) as (measure, value)"))
              .select("lang", "source", "measure", F.expr(bin_of("value")).alias("bin"))
              .groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n")))
    group = Window.partitionBy("lang", "source", "measure")
    ranked = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group)})
    quart = ranked.groupBy("lang", "source", "measure").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"))
    least = F.element_at(F.create_map(*[F.lit(x) for m, (s, _) in SPREAD.items() for x in (m, s)]), F.col("measure"))
    both = F.element_at(F.create_map(*[F.lit(x) for m, (_, b) in SPREAD.items() for x in (m, b)]), F.col("measure"))
    reach = REACH * F.greatest(F.col("q3") - F.col("q1"), least)
    return quart.select("lang", "source", "measure", F.when(both, F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def judge(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns (lang and source apart), the base counts, ``base_failed`` and ``kept``."""
    keep = [c for c in keep if c not in ("lang", "source")]
    rows = stage(measures(base(docs, *keep, "lang", "source")), "measures")
    fences = thresholds(rows).groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in SPREAD for side in ("low", "high")])
    fences = fences.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *[f"{m}_{s}" for m in SPREAD for s in ("low", "high")])
    rows = rows.join(fences, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    beyond = F.lit(False)
    for m in SPREAD:
        beyond = beyond | F.coalesce(F.col(m) < F.col(f"{m}_low"), F.lit(False)) | F.coalesce(F.col(m) > F.col(f"{m}_high"), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(*keep, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & ~beyond).alias("kept"), *SPREAD)
