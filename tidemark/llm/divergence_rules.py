"""Quality rules by distribution divergence, in DataFrame functions only.

A language's reference is made from all documents of that language: its histogram of character
classes and of its most common words. A document is kept if it passes the base rules and its own two
histograms are near its language's, by Jensen-Shannon distance. A histogram of few words strays by
chance, about as one over the square root of their number, so the limit has a part that shrinks with
length; below a minimum length there is no verdict.

Texts are read twice: once for the most common words of each language, once for all counts of a
document. The counts are written as a small table, from which the references and distances follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import saved

SPACES = r"[\x20\x09-\x0D]+"


def _without(text: Column, *strings: str) -> Column:
    for string in strings:
        text = F.replace(text, F.lit(string), F.lit(""))
    return text


def common_words(docs: DataFrame, common: int, least_words: int, share: int | None = None) -> DataFrame:
    """`lang, top` for each language of at least `least_words` words and, if given, one in `share` documents.

    `top` has the `common` most frequent words, runs of letters in lower case, with their counts in all
    documents; ties go to the lesser word.
    """
    known = docs.where(F.col("lang").isNotNull())
    tokens = known.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counts = saved(tokens.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "language_words")
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("word"))
    top = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= common)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("n_found")).where(F.col("n_found") >= least_words).select("lang")
    if share is not None:
        total = docs.agg(F.count(F.lit(1)).alias("n_all"))
        often = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
        often = often.join(F.broadcast(total)).where(F.col("n_docs") * share >= F.col("n_all"))
        langs = langs.join(often.select("lang"), "lang")
    return langs.join(top, "lang")


def document_counts(docs: DataFrame, top: DataFrame) -> DataFrame:
    """One row per row of `docs(doc_id, lang, text)`: the base counts, `classes` (characters by class) and `found`
    (occurrences of each top word of the language).

    Windows of three words are compared by hash. Where some occur twice, their hashes are sorted with
    their places, equal neighbours give the places of repeated windows, and each place in order adds
    three words less those the next place covers again.
    """
    text, n, length = F.col("text"), F.col("n_words"), F.col("length")
    windows = F.transform(
        F.slice("hashes", 1, F.greatest(n - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)),
    )
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    placed = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(x: Column, i: Column) -> Column:
        before, after = (F.get("placed", j)["g"] == x["g"] for j in (i - 1, i + 1))
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("placed", repeated), lambda x: x["i"]))
    steps = F.transform("places", lambda at, i: F.least(F.coalesce(F.get("places", i + 1) - at, F.lit(3)), F.lit(3)))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Words with a line feed on either side: taking one out shortens the text by its occurrences.
    joined = F.array_join("words", "\n\n")
    marked = F.concat(F.lit("\n"), _without(F.lower("joined"), ".", ","), F.lit("\n"))

    def occurrences(word: Column) -> Column:
        own = F.concat(F.lit("\n"), word, F.lit("\n"))
        cut = F.octet_length("marked") - F.octet_length(F.replace(F.col("marked"), own, F.lit("")))
        return (cut / F.octet_length(own)).cast("long")

    rest = F.regexp_replace(text, r"[a-zA-Z\p{L}\x20\x09-\x0D]+", "")
    counted = (
        docs.join(top, "lang", "left")
        .withColumn("words", F.array_remove(F.split(text, SPACES), ""))
        .withColumns({"n_words": F.size("words"), "length": F.length(text), "joined": joined, "rest": rest})
        .withColumns(
            {
                "hashes": F.transform("words", lambda w: F.xxhash64(w)),
                "lines": lines,
                "marked": marked,
                "word_chars": F.length("joined") - 2 * F.greatest(n - 1, F.lit(0)),
                "n_rest": F.length("rest"),
                "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
                "n_digits": F.length(F.regexp_replace("rest", "[^0-9]+", "")),
                "n_symbols": F.length(F.regexp_replace("rest", "[^#*$%&|<>]+", "")),
            }
        )
        .withColumn("grams", windows)
        .withColumn("placed", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), placed).otherwise(none))
        .withColumn("places", places)
    )
    spaces = length - F.col("word_chars")
    classes = F.array(
        length - spaces - F.col("n_rest") - F.col("n_upper"),
        F.col("n_upper"),
        F.col("n_digits"),
        spaces,
        F.col("n_symbols"),
        F.col("n_rest") - F.col("n_digits") - F.col("n_symbols"),
    )
    return counted.select(
        "doc_id",
        "lang",
        n.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long").alias("n_repeat_words"),
        length.cast("long").alias("length"),
        classes.cast("array<bigint>").alias("classes"),
        F.transform("top", lambda w: occurrences(w["word"])).alias("found"),
    )


def references(counts: DataFrame, top: DataFrame) -> DataFrame:
    """`lang, ref_words, ref_classes`: shares of all words and of all characters, a row per row of `top`."""
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(6)]
    totals = counts.where(F.col("lang").isNotNull()).groupBy("lang")
    totals = totals.agg(F.sum("n_words").alias("n_total"), F.sum("length").alias("n_chars"), *sums)
    words = F.transform("top", lambda w: w["n"] / F.col("n_total"))
    classes = F.array(*(F.col(f"c{i}") / F.col("n_chars") for i in range(6)))
    joined = totals.where("n_total > 0").join(top, "lang")
    return joined.select("lang", words.alias("ref_words"), classes.alias("ref_classes"))


def _distance(pairs: Column, rest: tuple[Column, Column] | None = None) -> Column:
    """Jensen-Shannon distance, base 2, of the distributions in an array of (p, q); `rest` adds one more pair."""

    def term(p: Column, q: Column) -> Column:
        left = F.when(p > 0, 0.5 * p * F.log2(2 * p / (p + q))).otherwise(0.0)
        return left + F.when(q > 0, 0.5 * q * F.log2(2 * q / (p + q))).otherwise(0.0)

    total = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + term(x["p"], x["q"]))
    if rest:
        total = total + term(*rest)
    return F.when(pairs.isNotNull(), F.sqrt(F.greatest(total, F.lit(0.0))))


def distances(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """Adds `char_distance` and `word_distance`; null without a reference or without text."""

    def pairs(seen: str, of: str, ref: str) -> Column:
        both = F.zip_with(seen, ref, lambda n, q: F.struct((n / F.col(of)).alias("p"), q.alias("q")))
        return F.when((F.col(of) > 0) & F.col(ref).isNotNull(), both)

    joined = counts.join(refs, "lang", "left")
    joined = joined.withColumns(
        {"_words": pairs("found", "n_words", "ref_words"), "_chars": pairs("classes", "length", "ref_classes")}
    )
    total = lambda side: F.aggregate("_words", F.lit(0.0), lambda acc, x: acc + x[side])
    rest = (F.greatest(1 - total("p"), F.lit(0.0)), F.greatest(1 - total("q"), F.lit(0.0)))
    return joined.withColumns(
        {"char_distance": _distance(F.col("_chars")), "word_distance": _distance(F.col("_words"), rest)}
    )


def quality_rules(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    common: int = 20,
    language_share: int | None = None,
    language_words: int = 1000,
    char_limit: tuple[float, float] = (0.15, 0.8),
    word_limit: tuple[float, float] = (0.13, 1.9),
    min_words: int = 50,
) -> DataFrame:
    """Base counts and the verdict for every whole text.

    One row per input row: `doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept`. A limit `(a, b)` is `a + b / sqrt(n_words)`.
    A language has a reference from `language_words` words on in all its documents; `language_share` asks
    besides for one in so many documents. A document of fewer than `min_words` words, of no language or of a language without a reference has
    no verdict of its own: the base rules decide. Null texts count as empty, and empty ones fail; null
    ids and repeated rows stay as they are; other columns are ignored. An empty table gives no rows.
    Windows of words are compared by 64-bit hashes within one document.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    top = saved(common_words(rows, common, language_words, language_share), "common_words")
    counts = saved(document_counts(rows, top), "document_counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # Written, both tables have a known size: Spark broadcasts them only if they are small.
    refs = saved(references(counts, top), "references")
    found = distances(counts.withColumn("base_failed", failed), refs)
    limit = lambda ab: F.lit(ab[0]) + F.lit(ab[1]) / F.sqrt(F.col("n_words"))
    far = (F.col("char_distance") > limit(char_limit)) | (F.col("word_distance") > limit(word_limit))
    verdict = F.when(F.col("base_failed"), False).when(F.col("n_words") < min_words, True)
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "char_distance",
        "word_distance",
        verdict.otherwise(~F.coalesce(far, F.lit(False))).alias("kept"),
    )
