"""Quality rules: a table of thresholds compiled into one projection.

Measures of length, symbols, stop words and lines are Spark expressions over
one row, so no rule needs a shuffle or a user function, and a document's
verdict depends on that document alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import let, words

# --- Fixed values: frequent function words, by language ---
STOP_WORDS = {
    "en": "the be to of and that have with a in is was it for on are as by this not",
    "de": "der die das und ist nicht ein eine zu den von mit sich des auf für im dem als auch",
    "fr": "le la les un une de des du et est en que qui dans pour pas sur par au avec",
    "es": "el la los las un una de del y en que es por con para no se su al lo",
}
# --- End of fixed values ---


@dataclass(frozen=True)
class Rule:
    """A measure must lie between ``low`` and ``high``, both included."""

    measure: str
    low: float | None = None
    high: float | None = None

    def passed(self) -> Column:
        value = F.col(self.measure)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok


RULES = (
    Rule("mean_word_chars", low=2.0, high=12.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.05),
    Rule("dup_line_ratio", high=0.5),
    Rule("ellipsis_line_ratio", high=0.3),
    Rule("bullet_line_ratio", high=0.9),
)


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


#: Positions below this bound fit beside 40 bits of a hash in one long.
PACKED_POSITIONS = 1 << 24


def beside_equal(sorted_items: Column, same: Callable[[Column, Column], Column], pick) -> Column:
    """``pick(item)`` of the items that equal a neighbour in sorted order."""

    def flags(items: Column) -> Column:
        return F.transform(
            items,
            lambda x, k: F.when(
                same(x, F.get(items, k - 1)) | same(x, F.get(items, k + 1)), pick(x)
            ),
        )

    return F.array_compact(let(sorted_items, flags))


def repeat_candidates(hashes: Column) -> Column:
    """Positions of all windows that may have a twin, and few others.

    Hash prefix and position share a long, so the sort runs on plain longs.
    Texts too long for that keep all positions.
    """
    mask = F.lit(-PACKED_POSITIONS)
    packed = F.sort_array(
        F.transform(hashes, lambda h, i: h.bitwiseAND(mask).bitwiseOR(i.cast("bigint")))
    )
    near = beside_equal(
        packed,
        lambda x, y: F.coalesce(x.bitwiseXOR(y).bitwiseAND(mask) == 0, F.lit(False)),
        lambda x: x.bitwiseAND(F.lit(PACKED_POSITIONS - 1)).cast("int"),
    )
    everything = F.sequence(F.lit(0), F.size(hashes) - 1)
    return F.when(F.size(hashes) < 2, F.array().cast("array<int>")).when(
        F.size(hashes) < PACKED_POSITIONS, near
    ).otherwise(everything)


def repeated_window_words(hashes: Column, candidates: Column, width: int) -> Column:
    """Words in windows whose hash occurs again, each counted once.

    Candidates are sorted by (hash, position), which puts equal windows side
    by side; the positions of those are then walked in order.
    """
    places = F.sort_array(
        F.transform(candidates, lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i")))
    )
    again = beside_equal(
        places, lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)), lambda x: x["i"]
    )
    start = F.struct(F.lit(-width).cast("int").alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.sort_array(again),
        start,
        lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def window_hashes(tokens: Column, width: int) -> Column:
    n = F.size(tokens)
    return F.when(
        n >= width,
        F.transform(
            F.sequence(F.lit(0), n - width),
            lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(width))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Counts and measures of every row; a null text counts as empty."""
    stop = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        words(F.col(text_col)).alias("tokens"),
        F.filter(
            F.split(text, "\n"),
            lambda line: line.rlike(r"[^\x20\x09-\x0D]"),
        ).alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    hashed = split.withColumn("hashes", window_hashes(F.col("tokens"), width)).withColumn(
        "candidates", repeat_candidates(F.col("hashes"))
    )
    counted = hashed.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("hashes"), F.col("candidates"), width).alias("n_repeat_words"),
        F.size(F.filter("tokens", lambda w: w.isin(stop))).alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_ellipsis"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_bullets"),
    )
    return counted.select(
        "*",
        ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        ratio(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_ratio"),
        ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        ratio(F.col("n_ellipsis"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        ratio(F.col("n_bullets"), F.col("n_lines")).alias("bullet_line_ratio"),
    )


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Measures of every row, ``base_failed``, ``failed`` (names of broken rules), ``kept``.

    Base: fewer than ``min_words`` words, or more than ``max_repeat_percent``
    of the words inside repeated windows. Null, empty and blank texts have no
    words and fail the base; ratios over nothing are 0. Rows are judged one by
    one, so repeated rows get equal verdicts and an empty table none.
    """
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    broken = F.array_compact(
        F.array(*(F.when(~rule.passed(), F.lit(rule.measure)) for rule in rules))
    )
    return (
        measured(docs, id_col, text_col)
        .select("*", base.alias("base_failed"), broken.alias("failed"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )
