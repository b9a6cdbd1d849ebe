"""Quality rules: counts of repetition and symbols, and divergence from the language's references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.llm.common import SPACES, WORD, stored, table, text_or_empty, words

# Character classes of a text: lower-case letters, and others, each as the pattern of what
# is *not* in it. Digits are left out: a phone number in a short text says nothing about its
# quality.
LOWER = r"\p{Ll}+"
OTHERS = {
    "upper": r"[^\p{Lu}]+",
    "stop": r"[^.,;:!?'\"()-]+",
    "symbol": r"[\p{L}\p{N}\s.,;:!?'\"()-]+",
}
CLASSES = ["lower", *OTHERS]
# The most frequent words of a language that its reference counts one by one.
COMMON = 40
# Documents that a reference, and a limit for one length of text, must rest on at least.
MIN_DOCS = 30
_REST = 0  # stands for all words that are not common
# References and limits of up to so many rows, a few per language, are broadcast.
_BROADCAST_ROWS = 10_000
# Lengths of texts, in words, from each number on; limits are set for each.
LENGTHS = (10, 20, 50, 100, 300)
# A limit lies so many quartile ranges above the upper quartile of a reference's own distances.
FENCE = 4.0


def _kept_chars(text: Column, other: str) -> Column:
    return F.length(F.regexp_replace(text, other, "")).cast("long")


# Words inside 5-word windows found twice or more. Most texts repeat no window,
# which a set of their hashes shows. Otherwise windows sorted by hash and place
# lie beside their equals; the repeated places, sorted again, each cover five
# words, or what is left up to the next. ``sort_array`` compares in compiled
# code, ``array_sort`` would interpret an expression per comparison.
_WINDOWS_IN_ORDER = """
    CASE WHEN size(array_distinct(grams)) < size(grams)
    THEN sort_array(transform(grams, (g, i) -> struct(g AS g, i AS i))) END
"""
_REPEATED_WORDS = """
    CASE WHEN in_order IS NULL THEN 0L ELSE aggregate(
        sort_array(transform(
            filter(in_order, (p, k) -> coalesce(p.g = get(in_order, k - 1).g, false)
                                    OR coalesce(p.g = get(in_order, k + 1).g, false)),
            p -> p.i)),
        named_struct('n', 0L, 'upto', 0),
        (a, i) -> named_struct('n', a.n + (i + 5 - greatest(i, a.upto)), 'upto', i + 5),
        a -> a.n)
    END
"""
_GRAMS = """
    CASE WHEN size(hashes) < 5 THEN array() ELSE transform(
        sequence(0, size(hashes) - 5),
        i -> xxhash64(get(hashes, i), get(hashes, i + 1), get(hashes, i + 2),
                      get(hashes, i + 3), get(hashes, i + 4)))
    END
"""
# Each common word of a text with its count.
_PRESENT = """
    transform(array_distinct(common),
              w -> struct(w AS word, CAST(size(common) - size(array_remove(common, w)) AS BIGINT) AS n))
"""


def common_words(docs: DataFrame) -> DataFrame:
    """``lang, word``: the ``COMMON`` most frequent words of each language with enough documents.

    A word goes by its 64-bit hash, which its text's windows need too. Words of all
    documents are counted in map tasks first; ties go by the hash.
    """
    counted = (
        docs.filter("lang IS NOT NULL")
        .select("lang", F.explode(F.split(text_or_empty(), SPACES)).alias("w")).filter("w != ''")
        .select("lang", F.xxhash64("w").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    spoken = docs.groupBy("lang").agg(F.count("*").alias("docs")).filter(F.col("docs") >= MIN_DOCS)
    return (
        counted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= COMMON)
        .join(spoken, "lang").select("lang", "word")
    )


def measured(docs: DataFrame, common: list[int], *carried: str) -> DataFrame:
    """Counts per row of ``docs``: the five of the rules, classes, common words.

    Most of a text is lower-case letters and spaces, so characters are counted in
    what is left without these.
    """
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    listed = F.filter("hashes", lambda h: h.isin(common)) if common else F.array().cast("array<long>")
    return (
        docs.select("doc_id", "lang", text_or_empty().alias("t"), *carried)
        .withColumns({"w": words(F.col("t")), "lines": lines})
        .withColumn("hashes", F.transform("w", lambda w: F.xxhash64(w)))
        .withColumns({"common": listed, "grams": F.expr(_GRAMS), "inked": F.array_join("w", "")})
        .withColumns({"in_order": F.expr(_WINDOWS_IN_ORDER), "rest": F.regexp_replace("inked", LOWER, "")})
        .select(
            "doc_id", "lang", *carried,
            F.size("w").cast("long").alias("n_words"),
            F.length("inked").cast("long").alias("word_chars"),
            _kept_chars(F.col("rest"), r"[^#*$%&|<>]+").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.expr(_REPEATED_WORDS).alias("n_repeat_words"),
            (F.length("inked") - F.length("rest")).cast("long").alias("lower"),
            *[_kept_chars(F.col("rest"), other).alias(name) for name, other in OTHERS.items()],
            F.expr(_PRESENT).alias("present"),
        )
    )


def _distance(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of ``array<struct<word, p>>`` from a map of shares.

    What the text lacks adds ln 2 times its share of the reference. Null without a reference.
    """
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.ln(2 * x / m)).otherwise(0.0)

    def add(total: Column, e: Column) -> Column:
        p, q = e["p"], F.coalesce(F.try_element_at(reference, e["word"]), F.lit(0.0))
        return F.struct(
            (total["js"] + part(p, p + q) + part(q, p + q)).alias("js"),
            (total["seen"] + q).alias("seen"),
        )

    start = F.struct(F.lit(0.0).alias("js"), F.lit(0.0).alias("seen"))
    doubled = F.aggregate(
        shares, start, add, lambda t: t["js"] + F.lit(0.6931471805599453) * (1 - t["seen"])
    )
    found = F.sqrt(F.greatest(doubled, F.lit(0.0)) / (2 * 0.6931471805599453))
    return F.when(reference.isNotNull(), found)


def _failed_base() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def char_references(counts: DataFrame) -> DataFrame:
    """``lang, chars_of``: per language the median share of each character class, over its documents.

    Medians, so that junk in under half of the documents moves nothing. Of all
    documents that pass the base rules; languages with few have no reference.
    """
    medians = counts.filter(~_failed_base()).groupBy("lang").agg(
        *[F.percentile_approx(F.col(c) / F.col("chars"), 0.5, 1000).alias(c) for c in CLASSES],
        F.count("*").alias("docs"),
    )
    total = F.greatest(sum((F.col(c) for c in CLASSES), F.lit(0.0)), F.lit(1e-9))
    entries = [x for c in CLASSES for x in (F.lit(c), F.col(c) / total)]
    return medians.filter(F.col("docs") >= MIN_DOCS).select("lang", F.create_map(*entries).alias("chars_of"))


def word_references(counts: DataFrame, common: DataFrame) -> DataFrame:
    """``lang, words_of``: per language the share of each of its common words in all, the rest under ``_REST``.

    Sums over all documents of the language that pass the base rules and keep
    to its characters.
    """
    own = counts.filter(~_failed_base() & (F.col("char_distance") <= F.col("char_limit")))
    totals = own.groupBy("lang").agg(F.sum("n_words").alias("total"), F.count("*").alias("docs"))
    by_word = (
        own.select("lang", F.inline("present")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .join(common, ["lang", "word"]).join(totals.filter(F.col("docs") >= MIN_DOCS), "lang")
    )
    shares = by_word.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("total")).alias("p")))).alias("known")
    )
    rest = F.greatest(1 - F.aggregate("known", F.lit(0.0), lambda a, e: a + e["p"]), F.lit(0.0))
    entries = F.concat(F.array(F.struct(F.lit(_REST).alias("word"), rest.alias("p"))), F.col("known"))
    return shares.select("lang", F.map_from_entries(entries).alias("words_of"))


def _length_class() -> Column:
    return sum(((F.col("n_words") >= n).cast("int") for n in LENGTHS), F.lit(0))


def _limits(counts: DataFrame, distance: str, limit: str) -> DataFrame:
    """``lang, length_class``, and the limit that a reference's own distances set.

    The upper quartile and ``FENCE`` quartile ranges: where up to a quarter of the
    documents are junk, the rest decide. Lengths with few documents have none.
    """
    own = counts.filter(~_failed_base() & F.col(distance).isNotNull())
    quartiles = own.groupBy("lang", "length_class").agg(
        F.percentile_approx(distance, [0.25, 0.75], 1000).alias("q"), F.count("*").alias("docs")
    )
    low, high = F.col("q")[0], F.col("q")[1]
    return quartiles.filter(F.col("docs") >= MIN_DOCS).select(
        "lang", "length_class", (high + FENCE * (high - low)).alias(limit)
    )


def _looked_up(rows: DataFrame, small: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with what ``small`` has for their language, if anything.

    ``small`` is stored and counted first: the few rows of ordinary tables are
    broadcast, so that a language with most documents meets in no task; of a table
    with very many languages none has most of them, and the join is Spark's choice.
    """
    small = stored(small, "language")
    if small.count() <= _BROADCAST_ROWS:
        small = F.broadcast(small)
    return rows.join(small, key, "left")


def judged(docs: DataFrame, *carried: str) -> DataFrame:
    """The counts, ``base_failed``, ``kept`` and the two distances, a row per row of ``docs``.

    A text fails the base rules with under 10 words, or with over 20 % of its
    words in repeated 5-word windows. Of the others it is rejected if its
    character classes or its common words are further from the reference of
    its language than that reference's limit for texts of its length. Each
    language that enough documents are in has references, taken from the
    documents: medians of class shares, and sums over its most frequent words.
    A limit follows from the distances of the language's own documents, so that
    it suits any language and length. A language of which most is junk would
    set its own standard.

    Where there is no reference or limit (a null, unknown or rare ``lang``, an
    empty table) the base rules decide alone. Null texts are empty and fail.
    Repeated rows are judged alike. Reads ``doc_id``, ``text`` and ``lang`` only,
    besides columns to be ``carried`` along; an empty table gives an empty result.

    Two scans with built-in functions; short passes over the counts. References
    and limits, a few rows per language, are looked up; the driver gets the
    hashes of the common words.
    """
    common = stored(common_words(docs), "common")
    listed = sorted({r["word"] for r in common.select("word").distinct().collect()})
    counts = stored(measured(docs, listed, *carried), "counts").withColumns(
        {
            "chars": F.greatest(sum((F.col(c) for c in CLASSES), F.lit(0)), F.lit(1)),
            "length_class": _length_class(),
        }
    )
    of_chars = F.array(
        *[F.struct(F.lit(c).alias("word"), (F.col(c) / F.col("chars")).alias("p")) for c in CLASSES]
    )
    by_chars = _looked_up(counts, char_references(counts), ["lang"]).withColumn(
        "char_distance", _distance(of_chars, F.col("chars_of"))
    ).drop("chars_of")
    key = ["lang", "length_class"]
    limited = _looked_up(by_chars, _limits(by_chars, "char_distance", "char_limit"), key)

    # Words that are common in another language only count as any other.
    total = F.greatest("n_words", F.lit(1))
    own_words = F.filter("present", lambda e: F.map_contains_key(F.col("words_of"), e["word"]))
    listed_shares = F.transform(
        "own", lambda e: F.struct(e["word"].alias("word"), (e["n"] / F.col("total")).alias("p"))
    )
    rest = 1 - F.aggregate("own", F.lit(0.0), lambda a, e: a + e["n"] / F.col("total"))
    of_words = F.concat(listed_shares, F.array(F.struct(F.lit(_REST).alias("word"), rest.alias("p"))))
    by_words = (
        _looked_up(limited, word_references(limited, common), ["lang"])
        .withColumns({"own": own_words, "total": total})
        .withColumn("word_distance", F.when(F.col("words_of").isNotNull(), _distance(of_words, F.col("words_of"))))
        .drop("words_of", "own", "total", "present")
    )
    by_words = stored(by_words, "distances")
    all_limits = _looked_up(by_words, _limits(by_words, "word_distance", "word_limit"), key)
    odd = F.coalesce(F.col("char_distance") > F.col("char_limit"), F.lit(False)) | F.coalesce(
        F.col("word_distance") > F.col("word_limit"), F.lit(False)
    )
    return all_limits.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _failed_base().alias("base_failed"), (~_failed_base() & ~odd).alias("kept"),
        "char_distance", "word_distance", *carried,
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    A row is found again by its id and a hash of its text, so that rows without
    an id, or under the same one, are each judged by their own text.
    """
    mark = F.xxhash64(text_or_empty())
    passed = (
        judged(docs.select("doc_id", "text", "lang", mark.alias("_mark")), "_mark").filter("kept")
        .select(F.col("doc_id").alias("_passed"), F.col("_mark").alias("_as")).distinct()
    )
    own = docs.withColumn("_mark", mark)
    return own.join(
        passed, own["doc_id"].eqNullSafe(passed["_passed"]) & (own["_mark"] == passed["_as"])
    ).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))
