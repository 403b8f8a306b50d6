"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import let, words_of

WINDOW = 5

# Very common words of English, French, Spanish and German.
STOP_WORDS = (
    "the of and to in is that it was for with as at by an be or on a "
    "le la les de des du un une et en est que dans pour "
    "el los las una y con por se su al "
    "der die das den dem und ein eine von mit ist im zu nicht für auf sich"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes while ``low <= numerator / denominator <= high``; 0 / 0 passes.

    Texts of fewer than ``min_words`` words pass: their ratios say little.
    """

    name: str
    numerator: str
    denominator: str | None
    low: float | None = None
    high: float | None = None
    min_words: int = 0

    def failed(self) -> Column:
        value = F.col(self.numerator).cast("double")
        if self.denominator:
            value = F.try_divide(value, F.col(self.denominator).cast("double"))
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | (value < self.low)
        if self.high is not None:
            bad = bad | (value > self.high)
        return F.coalesce(bad & (F.col("n_words") >= self.min_words), F.lit(False))


RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 1.5, 25.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None, min_words=50),
    Rule("shouted_ratio", "n_shouted", "n_words", None, 0.5),
)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more in the text, the first place included.

    Windows are hashed; a text without equal hashes has no repeated window and is done. Otherwise
    the windows are sorted by a 128-bit hash, equal neighbours are kept, and the union of their
    places is measured. All of it is linear, but for the sorts.
    """

    def hashed(ws: Column, i: Column, salt: list[Column]) -> Column:
        return F.xxhash64(*salt, *[F.get(ws, i + k) for k in range(window)])

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (a["g"] == b["g"])

    def measured(places: Column) -> Column:
        ends = F.transform(
            places, lambda p, j: F.coalesce(F.least(F.lit(window), F.get(places, j + 1) - p), F.lit(window))
        )
        return F.aggregate(ends, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def repeated(ws: Column, hs: Column) -> Column:
        keyed = F.sort_array(
            F.transform(hs, lambda h, i: F.struct(h.alias("h"), hashed(ws, i, [F.lit(1)]).alias("g"), i.alias("i")))
        )

        def places(keys: Column) -> Column:
            hit = F.transform(
                keys,
                lambda x, j: F.when(
                    F.coalesce(same(F.get(keys, j - 1), x), F.lit(False))
                    | F.coalesce(same(F.get(keys, j + 1), x), F.lit(False)),
                    x["i"],
                ),
            )
            return F.sort_array(F.filter(hit, F.isnotnull))

        return let(keyed, lambda keys: let(places(keys), measured))

    def judged(ws: Column) -> Column:
        windows = F.sequence(F.lit(0), F.size(ws) - window)
        hashes = F.transform(windows, lambda i: hashed(ws, i, []))
        found = let(
            hashes,
            lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), repeated(ws, hs)).otherwise(F.lit(0)),
        )
        return F.when(F.size(ws) >= window, found).otherwise(F.lit(0)).cast("bigint")

    return let(words, judged)


def text_counts(text: Column) -> Column:
    """A struct with the counts that rules may use."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    shouted = r"^[^a-zß-öø-ÿ]*[A-ZÀ-ÖØ-Þ]{2}[^a-zß-öø-ÿ]*$"

    def counted(ws: Column) -> Column:
        long = lambda c: c.cast("bigint")
        return F.struct(
            long(F.size(ws)).alias("n_words"),
            long(F.length(F.array_join(ws, ""))).alias("word_chars"),
            long(F.size(F.split(text, r"[#*$%&|<>]")) - 1).alias("n_symbols"),
            let(lines, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
            repeated_words(ws).alias("n_repeat_words"),
            long(F.size(F.filter(ws, lambda w: F.lower(w).isin(STOP_WORDS)))).alias("n_stop_words"),
            long(F.size(F.filter(ws, lambda w: w.rlike(shouted)))).alias("n_shouted"),
        )

    return let(words_of(text), counted)


def quality_rules(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds the counts, ``base_failed``, ``failed_rules`` (names) and ``kept`` to every row; no shuffle.

    A text is kept when it passes the base rule (at least 10 words, at most a fifth of them in
    repeated 5-word windows) and every rule of the table. A NULL text counts as empty, and fails.
    Rows are judged one by one: repeated rows get the same verdict, an empty table gives an empty
    result. Other columns stay; columns that have a name of ours are replaced.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_shouted"]
    rest = [c for c in df.columns if c not in (*own, "base_failed", "failed_rules", "kept", "_c")]
    # Exploding one struct computes it once: a filter on the verdict can't be pushed below it, where
    # it would repeat the counts for every rule.
    measured = df.select(*rest, F.explode(F.array(text_counts(F.col(text)))).alias("_c")).select(
        *rest,
        *[
            F.col({"n_lines": "_c.lines.n", "n_dup_lines": "_c.lines.dup"}.get(c, f"_c.{c}")).alias(c)
            for c in own
        ],
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules]))
    return (
        measured.withColumn("base_failed", base)
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
