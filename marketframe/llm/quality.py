"""Quality rules: counts of a text, and its distance from how its language usually looks.

Every language gets two reference distributions from the whole corpus: shares of character classes,
and shares of its common words, with one share for all other words. Under ``CORPUS_RULES`` each
distinct text that passes the base rules counts once there, however many copies of it there are. Words
are counted by hash cell, so that a language is a table of fixed size and no vocabulary is shuffled. A
document is compared with them by Jensen-Shannon distance (base 2, so 0 to 1). Documents too short for a
histogram are not compared. Built-in functions only; a document's counts stay within its row and are
written once, and only the references are aggregated.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import discard, spill, words_of

# Patterns of the character classes, in the order in which they are taken out of a text; what is
# left is the last class.
CLASSES = ("[a-z]", "[ \\t-\\r]", "[A-Z]", "[0-9]", "[#*$%&|<>!]", "[\\x21-\\x7E]")
SYMBOLS = "[^#*$%&|<>]+"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the verdict. ``common_share``: a word (or the words of one hash cell) is common in a
    language if it makes up this share of its words, so that there are at most 1 / common_share.
    ``distinct_texts``: references count each text that passes the base rules once, not every row."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200
    max_char_distance: float = 0.32
    max_word_distance: float = 0.46
    common_share: float = 0.002
    cells: int = 8192
    max_languages: int = 200
    distinct_texts: bool = False


# For whole corpora, where one group of copies can outweigh the rest of its language.
CORPUS_RULES = QualityRules(distinct_texts=True)


# Up to so many repeated hashes are looked up one by one, more by sorting all windows: the same
# suspects either way.
FEW_TWICE = 16


def _window_hashes(words: Column) -> Column:
    """Hashes of the 3-word windows, in text order."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _beside(ordered: Column, value: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    """Whether an element of an ordered array has the value of a neighbour."""
    return lambda x, k: F.coalesce(value(x) == value(F.get(ordered, k + 1)), F.lit(False)) | (
        (k > 0) & (value(x) == value(F.get(ordered, F.greatest(k - 1, F.lit(0)))))
    )


def _twice(ordered: Column) -> Column:
    """Values that an ordered array holds more than once."""
    return F.array_distinct(
        F.filter(ordered, lambda x, k: (k > 0) & (x == F.get(ordered, F.greatest(k - 1, F.lit(0)))))
    )


def _windows(words: Column, at: Column) -> Column:
    """(window, position) of the windows at some positions, ordered by window.

    Equal windows have equal hashes, so that among those whose hash occurs twice none is missed;
    comparing the windows themselves then leaves out those that only share a hash.
    """
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return F.sort_array(
        F.transform(at, lambda x: F.struct(window(x["i"]).alias("s"), x["i"].alias("i")))
    )


def _repeats(ordered: Column) -> Column:
    """Start positions, ascending, of windows equal to a neighbour in ``ordered``."""
    twice = F.filter(ordered, _beside(ordered, lambda x: x["s"]))
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words in windows of three that begin at ``starts``."""
    gap = F.transform(
        starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))
    )
    return F.aggregate(gap, F.lit(0).cast("long"), lambda total, g: total + g)


def with_repeats(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds ``out``: words inside 3-word windows that occur twice or more in the text."""
    df = df.withColumn("_q_hashes", _window_hashes(F.col(words)))
    some = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    df = df.withColumn("_q_sorted", F.when(some, F.sort_array("_q_hashes")).otherwise(F.array()))
    df = df.withColumn("_q_twice", _twice(F.col("_q_sorted")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.transform("_q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    many = F.size("_q_twice") > FEW_TWICE
    df = df.withColumn("_q_placed", F.when(many, F.sort_array(placed)).otherwise(none))
    few = F.filter(placed, lambda x: F.array_contains("_q_twice", x["h"]))
    sorted_out = F.filter("_q_placed", _beside(F.col("_q_placed"), lambda x: x["h"]))
    at = F.when(many, sorted_out).when(F.size("_q_twice") > 0, few).otherwise(none)
    df = df.withColumn("_q_at", at)
    df = df.withColumn("_q_ordered", _windows(F.col(words), F.col("_q_at")))
    df = df.withColumn("_q_starts", _repeats(F.col("_q_ordered")))
    df = df.withColumn(out, _covered(F.col("_q_starts")))
    return df.drop("_q_hashes", "_q_sorted", "_q_twice", "_q_placed", "_q_at", "_q_ordered", "_q_starts")


def word_cells(words: Column, cells: int) -> Column:
    """The histogram cell of each word: a hash of its lower-case form."""
    return F.transform(
        words, lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(cells).cast("long")).cast("int")
    )


def _class_counts(df: DataFrame, text: Column, prefix: str) -> DataFrame:
    """Columns ``prefix``0.. with the number of characters of each class."""
    left, names = f"{prefix}left", []
    df = df.withColumn(left, text)
    for i, pattern in enumerate(CLASSES):
        rest = f"{prefix}rest"
        df = df.withColumn(rest, F.regexp_replace(left, f"{pattern}+", ""))
        df = df.withColumn(f"{prefix}{i}", F.length(left) - F.length(rest))
        df = df.drop(left).withColumnRenamed(rest, left)
        names.append(f"{prefix}{i}")
    last = f"{prefix}{len(CLASSES)}"
    return df.withColumn(last, F.length(left)).drop(left)


def _class_names(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(len(CLASSES) + 1)]


def _measured(docs: DataFrame, names: Sequence[str], rules: QualityRules) -> DataFrame:
    """The columns ``names``, the language, and all that is read off a row's own text: counts, class counts,
    word cells and hash. Everything later rests on these, so that each text is taken apart once."""
    text = F.col("_q_text")
    df = docs.select(
        *names,
        F.coalesce("lang", F.lit("")).alias("_q_lang"),
        F.coalesce("text", F.lit("")).alias("_q_text"),
    )
    df = df.withColumn("_q_words", words_of(text))
    df = with_repeats(df, "_q_words", "_q_repeat")
    df = df.withColumn("_q_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]")))
    df = _class_counts(df, text, "_q_c")
    small = "array<smallint>" if rules.cells <= 1 << 15 else "array<int>"
    return df.select(
        *names,
        "_q_lang",
        F.xxhash64(text).alias("_q_hash"),
        word_cells(F.col("_q_words"), rules.cells).cast(small).alias("_q_cells"),
        *_class_names("_q_c"),
        F.size("_q_words").cast("long").alias("n_words"),
        (F.length(text) - F.col("_q_c1")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"),
    )


def _base_failed(rules: QualityRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def language_references(measured: DataFrame, rules: QualityRules) -> DataFrame:
    """Per language: class_shares, the place of each cell among the common ones (0: none), and their
    common_shares. A null language is one; a language without reference texts has no row.

    With ``distinct_texts``, the texts that pass the base rules count once per language. Copies are told
    by their hash, and put together before they are shuffled.
    """
    texts = measured.filter(F.col("n_words") >= rules.min_words)
    if rules.distinct_texts:
        texts = texts.filter(~_base_failed(rules))
    texts = texts.select(
        F.col("_q_lang").alias("lang"), F.col("_q_hash").alias("text_hash"),
        *[F.col(f"_q_c{i}").alias(f"c{i}") for i in range(len(CLASSES) + 1)],
        F.col("_q_cells").alias("cells"),
    )
    if rules.distinct_texts:
        texts = texts.distinct()
    # Classes go along as cells below zero, so that one pass counts both.
    one = F.lit(1).cast("long").alias("n")
    words = F.transform("cells", lambda c: F.struct(c.cast("int").alias("cell"), one))
    kinds = F.array(
        *[
            F.struct(F.lit(-1 - i).alias("cell"), F.col(c).cast("long").alias("n"))
            for i, c in enumerate(_class_names("c"))
        ]
    )
    cells = texts.select("lang", F.inline(F.concat(words, kinds)))
    both = cells.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    both = spill(both, "cells")  # at most ``cells`` rows per language, and the classes
    counts, kinds = both.filter("cell >= 0"), both.filter("cell < 0")
    n_of = [F.sum(F.when(F.col("cell") == -1 - i, F.col("n"))) for i in range(len(CLASSES) + 1)]
    classes = kinds.groupBy("lang").agg(F.array(*[n / F.sum("n") for n in n_of]).alias("class_shares"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    common = (
        counts.join(totals, "lang")
        .filter(F.col("n") >= rules.common_share * F.col("total"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("cell", (F.col("n") / F.col("total")).alias("p")))).alias("w"))
        .select(
            "lang",
            F.transform(
                F.sequence(F.lit(0), F.lit(rules.cells - 1)),
                lambda c: F.array_position(F.col("w.cell"), c).cast("int"),
            ).alias("place"),
            F.col("w.p").alias("common_shares"),
        )
    )
    return classes.join(common, "lang", "left")


def _entropy_gap(p: Column, q: Column) -> Column:
    """A class's part of the Jensen-Shannon divergence, in bits."""
    middle = (p + q) / 2
    side = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(F.lit(0.0))
    return (side(p) + side(q)) / 2


def _distance(parts: Column) -> Column:
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def _word_distance(df: DataFrame) -> DataFrame:
    """Distance of common-word shares, from the sorted positions of a document's common words."""
    hits, n = F.col("_q_hits"), F.greatest(F.col("_q_n_words"), F.lit(1))
    starts = F.filter(
        F.transform(
            hits,
            lambda x, i: F.when(
                (i == 0) | (F.get(hits, F.greatest(i - 1, F.lit(0))) != x),
                F.struct(x.alias("x"), i.alias("i")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    df = df.withColumn("_q_runs", starts)
    runs = F.col("_q_runs")
    shares = F.col("_q_common_shares")
    present = F.transform(
        runs,
        lambda r, k: F.struct(
            F.get(shares, (r["x"] - 1).cast("int")).alias("p"),
            ((F.coalesce(F.get(runs, k + 1)["i"], F.size(hits)) - r["i"]) / n).alias("q"),
        ),
    )
    df = df.withColumn("_q_present", present)
    met = F.aggregate("_q_present", F.lit(0.0), lambda a, x: a + x["p"])
    all_p = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    known = F.aggregate(
        "_q_present", F.lit(0.0), lambda a, x: a + _entropy_gap(x["p"], x["q"])
    )
    absent = (all_p - met) / 2
    other = _entropy_gap(
        F.greatest(1 - all_p, F.lit(0.0)), F.greatest(1 - F.size(hits) / n, F.lit(0.0))
    )
    total = F.greatest(known + absent + other, F.lit(0.0))
    return df.withColumn("_q_word_distance", F.sqrt(total))


def score_quality(
    docs: DataFrame, rules: QualityRules = QualityRules(), keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (text, lang and any others) with the counts, both distances and the verdict.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, kept. ``keep`` names the columns of ``docs`` to carry along, by default all. A null
    text counts as empty, and so fails for want of words. Distances are
    null (and no reason to drop) for texts under ``min_words`` or ``min_chars`` and where the
    language has no reference texts, and the word distance also where it has no common words. A null
    language is a language of its own. Very long texts are taken whole, in time n log n. A distance
    equal to its limit passes.
    Repeated rows get equal verdicts; an empty table gives none. Columns of ``docs`` that have one
    of the added names are replaced; columns starting with ``_q_`` are reserved.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in SCORES]
    return _scored(spill(_measured(docs, names, rules), "measured"), names, rules)


SCORES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCORES += ["base_failed", "char_distance", "word_distance", "kept"]


def _scored(measured: DataFrame, names: Sequence[str], rules: QualityRules) -> DataFrame:
    """``names`` and the scores of written rows of ``_measured``."""
    references = spill(language_references(measured, rules), "references")
    small = references.count() <= rules.max_languages  # of at most 1 / common_share words each
    references = references.select(
        F.col("lang").alias("_q_ref"),
        *[F.col(c).alias(f"_q_{c}") for c in ("class_shares", "place", "common_shares")],
    )
    df = measured.withColumn("_q_n_words", F.col("n_words"))
    on = F.col("_q_lang") == F.col("_q_ref")
    df = df.join(F.broadcast(references) if small else references, on, "left")
    df = df.withColumn("_q_places", F.transform("_q_cells", lambda c: F.get("_q_place", c.cast("int"))))
    df = df.withColumn("_q_hits", F.sort_array(F.filter("_q_places", lambda x: x > 0)))
    df = df.drop("_q_cells", "_q_places", "_q_place")
    df = _word_distance(df)
    chars = sum((F.col(c) for c in _class_names("_q_c")), F.lit(0))
    parts = F.array(
        *[
            _entropy_gap(F.get("_q_class_shares", F.lit(i)), F.col(c) / chars)
            for i, c in enumerate(_class_names("_q_c"))
        ]
    )
    long_enough = (F.col("n_words") >= rules.min_words) & (chars >= rules.min_chars)
    df = df.withColumn("base_failed", _base_failed(rules))
    compared = long_enough & F.col("_q_class_shares").isNotNull()
    df = df.withColumn("char_distance", F.when(compared, F.round(_distance(parts), 6)))
    compared = long_enough & F.col("_q_common_shares").isNotNull()
    df = df.withColumn("word_distance", F.when(compared, F.round("_q_word_distance", 6)))
    near = F.coalesce(F.col("char_distance") <= rules.max_char_distance, F.lit(True))
    alike = F.coalesce(F.col("word_distance") <= rules.max_word_distance, F.lit(True))
    df = df.withColumn("kept", ~F.col("base_failed") & near & alike)
    return df.select(*names, *SCORES)


def keep_good(docs: DataFrame, rules: QualityRules = CORPUS_RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang")
    measured = spill(_measured(packed, ["_row"], rules), "measured")
    # Written, because a filter on the verdict would be planned as all that the verdict rests on.
    scored = spill(_scored(measured, ["_row"], rules).select("_row", "kept"), "scored")
    discard(measured)  # it holds the texts once more
    return scored.filter("kept").select("_row.*")
