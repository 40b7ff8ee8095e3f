"""Line dedup by distinct-site spread.

A line that very many sites have is boilerplate. Each line's sites go into a HyperLogLog sketch; sketches
are merged by the aggregation before and after the shuffle, so a line that a third of all documents
have costs one small row per task. A sketch's estimate decides where it is clear of the threshold; the few
lines near it get their sites counted exactly. Long lines can have a threshold of their own. Then every
occurrence of a boilerplate line but the first is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved, temporary

_LG_K = 12  # registers of a sketch, as a power of two: a relative error of 1.6 %
_MARGIN = 0.1  # estimates this near the threshold, six times the error, are not relied on


_SPACE = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def _has_words(line: Column, words: int) -> Column:
    plain = _plain(line)
    return (plain != "") & (F.size(F.split(plain, r"[\x20\x09-\x0D]+")) >= words)


def _key(line: Column, min_words: int) -> Column:
    """128-bit hash of a line without regard to case and white space around it; null for a line of fewer words."""
    return F.when(_has_words(line, min_words), F.unhex(F.md5(F.lower(_plain(line)))))


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """`key` of the lines that at least `min_sites` sites have, from `lines(key, site)`."""
    sketches = lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(_LG_K)).alias("sketch"))
    spread = saved(
        sketches.select("key", F.hll_sketch_estimate("sketch").alias("sites")).where(
            F.col("sites") >= (1 - _MARGIN) * min_sites - 1
        ),
        "line_spread",
    )
    clear = F.col("sites") > (1 + _MARGIN) * min_sites + 1
    near = spread.where(~clear).select("key")
    exact = lines.join(near, "key", "left_semi").groupBy("key", "site").count()
    exact = exact.groupBy("key").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(clear).select("key").unionByName(exact.select("key"))


def spread_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 8,
    min_words: int = 4,
    long_sites: int | None = None,
    long_words: int = 51,
) -> DataFrame:
    """`doc` (all columns of the input in one), `n_lines`, `n_removed`, `clean`, one row per input row.

    Lines are what line feeds separate; they are equal without regard to case and surrounding white space,
    and lines of fewer than `min_words` words never count. A line is boilerplate if at least `min_sites`
    sites have it; with `long_sites`, one of at least `long_words` words also if that many sites have it, or
    `min_sites` documents, be they of one site. Of its occurrences only the first stays: that of least document id, then of least place
    (rows of the same id and text count as one document; null ids come last). `clean` is the text
    without the others, its other lines as they were; null stays null, without lines. Null sites count
    as one site. An empty table gives no rows.
    """
    own = F.col(doc_id)
    whole = F.col(text).cast("string")
    # Names a row by what it holds, so that it can be found again; equal rows are treated alike.
    name = F.unhex(F.md5(F.concat_ws("\n", F.coalesce(own.cast("string"), F.lit("-")), whole)))
    placed = docs.select(
        name.alias("row"),
        F.struct(own.isNull().alias("none"), own.alias("id")).alias("id"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(_lines(whole)).alias("place", "line"),
    )
    long = (_has_words(F.col("line"), long_words) if long_sites is not None else F.lit(False)).alias("long")
    placed = placed.select("row", "id", "site", "place", _key(F.col("line"), min_words).alias("key"), long)
    with temporary() as for_now:
        placed = for_now(placed.where("key is not null"), "lines")
        boilerplate = boilerplate_lines(placed.select("key", "site"), min_sites)
        if long_sites is not None:
            passages = placed.where("long")
            spread = boilerplate_lines(passages.select("key", "site"), long_sites)
            often = boilerplate_lines(passages.select("key", F.col("row").alias("site")), min_sites)
            boilerplate = boilerplate.unionByName(spread).unionByName(often).distinct()
        boilerplate = for_now(boilerplate, "boilerplate")
        hits = saved(placed.join(boilerplate, "key").select("key", "row", "id", "place"), "boilerplate_places")

    first = hits.groupBy("key").agg(F.min(F.struct("id", "place")).alias("first"))
    rest = hits.join(first, "key").where(F.struct("id", "place") != F.col("first"))
    removed = rest.groupBy("row").agg(F.collect_set("place").alias("removed"))
    joined = docs.select(F.struct("*").alias("doc"), name.alias("row")).join(removed, "row", "left")
    joined = joined.withColumn("whole", F.col(f"doc.`{text}`").cast("string"))
    joined = joined.withColumn("lines", _lines(F.col("whole")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    kept = F.array_join(F.transform(left, lambda place: F.get("lines", place)), "\n")
    counted = F.size(F.filter("lines", lambda line: _has_words(line, min_words)))
    return joined.select(
        "doc",
        F.when(F.col("whole").isNull(), 0).otherwise(counted).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("whole")).otherwise(kept).alias("clean"),
    )
