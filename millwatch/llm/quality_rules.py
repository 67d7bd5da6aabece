"""Quality rules with limits taken from the corpus, per language and source.

Built-in functions throughout. Each text gives a few measures; a mergeable quantile sketch of
each measure is kept per language and source. Small groups take the limits of their language,
whose sketches are those of its sources merged, and small languages those of all documents.
The limits are joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import SPACES, given_up, text_key, whole_text, written

#: Items a sketch keeps on its widest level: up to that many values its quantiles are exact.
SKETCH_SIZE = 4096

#: Fewer documents than this take the limits of the language, then of all documents.
LEAST_GROUP = 100

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Measure: the spread taken where a group has less, and whether low values are also rejected.
MEASURES = {
    "symbol_share": (0.05, False),
    "dup_line_share": (0.10, False),
    "repeat_share": (0.08, False),
    "upper_share": (0.08, False),
    "word_length": (0.75, True),
}

#: A limit lies this many spreads (median to the 10 % or 90 % quantile) beyond the median.
SPREADS = 5.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(windows: Column) -> Column:
    """Words in windows of three that occur twice or more, from the hashes of the windows.

    Sorted with their positions, equal windows are neighbours. The positions of those give the
    words covered: three each, fewer where the next one begins earlier.
    """

    def covered(positions: Column) -> Column:
        each = F.transform(
            positions,
            lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))),
        )
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)

    def marked(ordered: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        positions = F.sort_array(F.transform(F.filter(ordered, twice), lambda x: x["p"]))
        return _let(positions, covered)

    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _let(F.sort_array(numbered), marked)
    )


def _repeat_words(words: Column) -> Column:
    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) >= 4,
            _let(
                F.transform(
                    F.sequence(F.lit(0), F.size(w) - 3),
                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
                ),
                _repeated,
            ),
        ).otherwise(F.lit(0))

    return _let(words, windows)


def with_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_upper, prefixed.

    Columns are named ``__q_...`` so that none of the input's is hidden. Windows of words are
    compared by a 64-bit hash.
    """
    text = whole_text()
    squeezed = F.regexp_replace(text, f"[{SPACES}]+", "")
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    long = "bigint"
    return docs.withColumns({
        "__q_words": words,
        "__q_squeezed": squeezed,
        "__q_lines": lines,
    }).withColumns({
        "__q_n_words": F.size("__q_words").cast(long),
        "__q_word_chars": F.length("__q_squeezed").cast(long),
        "__q_n_symbols": F.regexp_count("__q_squeezed", F.lit(r"[#*$%&|<>]")).cast(long),
        "__q_n_upper": F.regexp_count("__q_squeezed", F.lit(r"\p{Lu}")).cast(long),
        "__q_n_lines": F.size("__q_lines").cast(long),
        "__q_n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast(long),
        "__q_n_repeat_words": _repeat_words(F.col("__q_words")).cast(long),
    }).drop("__q_words", "__q_squeezed", "__q_lines")


def with_measures(counted: DataFrame) -> DataFrame:
    """Add the measures the limits are about; NULL for a text without words."""
    words = F.col("__q_n_words")

    def share(part: str, whole: str) -> Column:
        return F.when(words > 0, F.col(f"__q_{part}") / F.col(f"__q_{whole}"))

    return counted.withColumns({
        "__q_symbol_share": share("n_symbols", "word_chars"),
        "__q_dup_line_share": share("n_dup_lines", "n_lines"),
        "__q_repeat_share": share("n_repeat_words", "n_words"),
        "__q_upper_share": share("n_upper", "word_chars"),
        "__q_word_length": share("word_chars", "n_words"),
    })


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    words = F.col("__q_n_words")
    return (words < MIN_WORDS) | (100 * F.col("__q_n_repeat_words") > MAX_REPEAT_PERCENT * words)


def limits(measured: DataFrame) -> DataFrame:
    """Per lang and source (NULL is a value of its own): the limits of each measure.

    One pass makes sketches per lang and source; those of a language and of all documents are
    merged from them. Texts that fail the base rules don't shape the limits.
    """
    good = measured.filter(~base_failed())
    sketches = good.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(f"__q_{m}", F.lit(SKETCH_SIZE)).alias(m) for m in MEASURES],
    )

    def merged(*keys: str) -> DataFrame:
        together = [F.kll_merge_agg_double(m, F.lit(SKETCH_SIZE)).alias(f"{m}_of") for m in MEASURES]
        return sketches.groupBy(*keys).agg(F.sum("n").alias("n_of"), *together)

    def bounds(sketch: Callable[[str], Column]) -> Column:
        fields = []
        for name, (least, both) in MEASURES.items():
            low, mid, high = (
                F.kll_sketch_get_quantile_double(sketch(name), F.lit(q)) for q in (0.1, 0.5, 0.9)
            )
            # the side that junk lies on may be full of it: the spread is that of the other side
            down = F.greatest(mid - low, F.lit(least))
            fields.append((mid + SPREADS * down).alias(f"{name}_most"))
            if both:
                up = F.greatest(F.least(high - mid, mid - low), F.lit(least))
                fields.append((mid - SPREADS * up).alias(f"{name}_least"))
        return F.struct(*fields)

    own = sketches.select(
        "lang", "source", "n", F.when(F.col("n") >= LEAST_GROUP, bounds(F.col)).alias("own")
    )
    of_lang = merged("lang").select(
        F.col("lang").alias("lang_of"),
        F.when(F.col("n_of") >= LEAST_GROUP, bounds(lambda m: F.col(f"{m}_of"))).alias("by_lang"),
    )
    of_all = merged().select(F.when(F.col("n_of") > 0, bounds(lambda m: F.col(f"{m}_of"))).alias("by_all"))
    return own.join(of_lang, F.col("lang").eqNullSafe(F.col("lang_of")), "left").select(
        "lang", "source", F.coalesce("own", "by_lang", of_all.scalar()).alias("limit")
    )


def judged(measured: DataFrame, limit_rows: DataFrame) -> DataFrame:
    """Add ``__q_base_failed`` and ``__q_kept``: within the limits of language and source.

    The limits are one row per language and source; Spark broadcasts them only below its own
    size limit and splits a source with many rows otherwise.
    """
    named = limit_rows.select(
        F.col("lang").alias("__q_lang"), F.col("source").alias("__q_source"), F.col("limit").alias("__q_limit")
    )
    same = F.col("lang").eqNullSafe(F.col("__q_lang")) & F.col("source").eqNullSafe(F.col("__q_source"))
    within = F.lit(True)
    for name, (_, both) in MEASURES.items():
        value = F.col(f"__q_{name}")
        within &= value <= F.col(f"__q_limit.{name}_most")
        if both:
            within &= value >= F.col(f"__q_limit.{name}_least")
    failed = base_failed()
    return measured.join(named, same, "left").withColumns({
        "__q_base_failed": failed,
        "__q_kept": ~failed & F.coalesce(within, F.lit(True)),
    })


def quality_counts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, source, the counts, base_failed and kept.

    NULL and empty texts have no words and fail the base rules. A NULL lang or source is a
    value like any other. Ties with a limit are kept. Repeated rows count as often as they
    occur. An empty table gives an empty result. Whole texts are read; other columns are not.
    """
    counted = with_counts(docs.select("doc_id", "text", "lang", "source")).drop("text")
    measured = with_measures(written(counted, "quality-counts"))
    limit_rows = written(limits(measured), "quality-limits")
    rows = judged(measured, limit_rows)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id",
        "lang",
        "source",
        *[F.col(f"__q_{c}").alias(c) for c in counts],
        F.col("__q_base_failed").alias("base_failed"),
        F.col("__q_kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Texts are measured once, and their counts written without them, so that no copy of the
    corpus is left in the shared folder: a verdict depends on text, language and source, and
    the documents are told apart by those and a key of the text.
    """
    keyed = docs.withColumn("__q_key", text_key())
    counted = written(
        with_counts(keyed.select("text", "lang", "source", "__q_key")).drop("text"), "quality-counts"
    )
    measured = with_measures(counted)
    limit_rows = written(limits(measured), "quality-limits")
    failed = judged(measured, limit_rows).filter(~F.col("__q_kept"))
    names = {"__of_key": F.col("__q_key"), "__of_lang": F.col("lang"), "__of_source": F.col("source")}
    failed = written(failed.select(*[c.alias(name) for name, c in names.items()]).distinct(), "quality-failed")
    given_up(counted)
    same = F.col("__q_key") == F.col("__of_key")
    for c in ("lang", "source"):
        same &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return keyed.join(failed, same, "left_anti").select(*docs.columns)
