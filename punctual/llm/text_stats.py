"""Statistics of whole texts as column expressions (no Python on the executors).

``stats(text)`` is one struct; the columns that need the words share one pass.
A null text has no words, no lines and no characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.llm.common import NOT_SPACE, SPACE, let

SYMBOLS = "#*$%&|<>"


def repeated_words(hashes: Column, window: int = 5) -> Column:
    """Words covered by windows of ``window`` words that occur twice or more.

    ``hashes`` are 64-bit word hashes (a lambda variable: it is used per element).
    """
    n = F.size(hashes)
    grams = F.transform(F.slice(hashes, 1, F.greatest(n - (window - 1), F.lit(0))),
                        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, window)]))

    def covered(g: Column) -> Column:
        placed = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, lambda e, j: same(e, j - 1) | same(e, j + 1)), lambda e: e["i"]))

        def add(acc: Column, at: Column) -> Column:
            return F.struct((acc["n"] + at + window - F.greatest(at, acc["to"])).alias("n"), (at + window).alias("to"))

        total = F.aggregate(let(placed, twice), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), add, lambda a: a["n"])
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(total)

    return F.when(n <= window, F.lit(0)).otherwise(let(grams, covered))


def chars_of(text: Column, kept: str) -> Column:
    """Characters of the class ``kept`` in the text."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def stats(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, f"{SPACE}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))

    def of_words(w: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            return F.struct(F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
                            repeated_words(h).cast("long").alias("n_repeat_words"))
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes).alias("h"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return F.struct(
        let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
        chars_of(text, SYMBOLS).alias("n_symbols"), chars_of(text, "A-Z").alias("n_upper"),
        chars_of(text, "0-9").alias("n_digits"), chars_of(text, ".,;:!?").alias("n_punct"))


#: name -> place in the struct
COLUMNS = {
    "n_words": "w.n_words", "word_chars": "w.word_chars", "n_distinct": "w.h.n_distinct",
    "n_repeat_words": "w.h.n_repeat_words", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines",
    "n_symbols": "n_symbols", "n_upper": "n_upper", "n_digits": "n_digits", "n_punct": "n_punct",
}


def with_stats(docs, keys: list[str], text: str = "text"):
    """``keys`` and the columns of COLUMNS, all long and never null."""
    rows = docs.select(*keys, stats(F.col(text)).alias("_stats"))
    return rows.select(*keys, *[F.col(f"_stats.{place}").alias(name) for name, place in COLUMNS.items()])
