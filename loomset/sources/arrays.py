"""A JSON file that holds one array, read by many tasks.

Spark reads such a file in one task, since a line break may stand anywhere in it. Here it is cut at
every closing brace, which Spark's text source does in parallel. Whether a brace closes an element
depends on all that stands before it, but each block of the file sums that up for both cases, in a
string or not; the sums of the blocks are few and give every block its start. Elements are then put
together within their block, and only those that cross its border meet in an exchange of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A string with its quotes; the last one of a piece may go on in the next.
_STRING = r'"[^"]*("|$)'
_BLOCK = ("_file", "_block")


def array_as_lines(spark: SparkSession, location: str, directory: str) -> str:
    """Write the elements of a JSON array as JSON Lines below ``directory``; the directory they are in.

    ``location`` is a file, or a directory of files that hold an array each. Line breaks between an
    element's values become blanks; within strings JSON has none. Nothing else of an element changes.

    Defined results: an empty array gives no line. What is no array of objects is written as it
    stands, so that a reader that refuses malformed lines refuses it.
    """
    # Stored, since a block is known by where it begins, and another scan may cut the file elsewhere.
    _pieces(spark, location).write.parquet(f"{directory}/pieces")
    pieces = spark.read.parquet(f"{directory}/pieces")
    starts = _starts(spark, pieces)
    fragments = _fragments(pieces, starts)
    whole = fragments.where("_ends and not _continues").select("_text")
    elements = whole.unionByName(_joined(fragments.where("not _ends or _continues")))
    target = f"{directory}/lines"
    _lines(elements).write.text(target)
    return target


def _pieces(spark: SparkSession, location: str) -> DataFrame:
    """Text before each closing brace, its quotes (mod 2) and its opening braces in either case."""
    text = spark.read.option("lineSep", "}").text(location)
    bare = F.regexp_replace("_piece", r"\\.", "")  # without escapes, a quote begins or ends a string
    rest = F.regexp_replace(bare, r'^[^"]*("|$)', "")  # behind the string that the piece begins in

    def opened(part: Column) -> Column:
        outside = F.regexp_replace(part, _STRING, "")
        return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))

    return text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_piece"),
    ).withColumns(
        {
            "_quotes": (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2,
            "_opened": F.array(opened(bare), opened(rest)),
            "_last": F.right(F.regexp_replace("_piece", r"\s+$", ""), F.lit(1)),
        }
    )


def _with_depth(pieces: DataFrame, in_string: Column, depth: Column) -> DataFrame:
    """Add ``_closes`` (the brace behind the piece is no text) and ``_depth`` behind it."""
    within = Window.partitionBy(*_BLOCK).orderBy("_at")
    inside = (in_string + F.sum("_quotes").over(within) - F.col("_quotes")) % 2
    return (
        pieces.withColumn("_inside", inside.cast("int"))
        .withColumn("_closes", (F.col("_inside") + F.col("_quotes")) % 2 == 0)
        .withColumn("_change", F.get("_opened", F.col("_inside")) - F.col("_closes").cast("int"))
        .withColumn("_depth", depth + F.sum("_change").over(within))
    )


def _starts(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """State at the start of each block. The driver gets a row per block, not the text."""
    cases = [
        _with_depth(pieces, F.lit(case), F.lit(0))
        .groupBy(*_BLOCK)
        .agg(
            (F.sum("_quotes") % 2).alias("quotes"),
            F.sum("_change").alias(f"change{case}"),
            F.max_by("_last", "_at").alias("last"),
        )
        for case in (0, 1)
    ]
    sums = cases[0].join(cases[1].select(*_BLOCK, "change1"), list(_BLOCK)).orderBy(*_BLOCK).collect()
    starts, ends, before = [], {}, None
    for row in sums:
        if row["_file"] != before:
            before, inside, depth = row["_file"], 0, 0
        starts.append((row["_file"], row["_block"], inside, depth))
        depth += row[f"change{inside}"]
        inside = (inside + row["quotes"]) % 2
        ends[before] = (inside, depth, row["last"])
    # Behind the last element stands "]", which the text source gives as a piece without a brace.
    broken = [file for file, (inside, depth, last) in ends.items() if inside or depth != -1 or last != "]"]
    if broken:
        raise ValueError(f"{broken[0]} holds no JSON array that ends")
    return spark.createDataFrame(starts, "_file string, _block long, _in int, _deep long")


def _fragments(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """What each block holds of each element. Blocks are ordered by where they begin."""
    within = Window.partitionBy(*_BLOCK).orderBy("_at")
    known = pieces.join(F.broadcast(starts), list(_BLOCK))  # a row per block
    placed = (
        _with_depth(known, F.col("_in"), F.col("_deep"))
        .withColumn("_end", F.col("_closes") & (F.col("_depth") == 0))
        .withColumn("_element", F.sum(F.col("_end").cast("int")).over(within) - F.col("_end").cast("int"))
    )
    put = F.array_sort(F.collect_list(F.struct("_at", "_piece")))
    return (
        placed.groupBy(*_BLOCK, "_element")
        .agg(put.alias("_put"), F.bool_or("_end").alias("_ends"))
        .withColumn("_continues", F.col("_element") == 0)
        .withColumn("_text", F.concat(F.array_join("_put._piece", "}"), F.lit("}")))
        .drop("_put")
    )


def _joined(fragments: DataFrame) -> DataFrame:
    """Elements that begin a block or cross its border: at most two fragments of a block."""
    order = Window.partitionBy("_file").orderBy("_block", "_element")
    ended = F.col("_ends").cast("int")
    text = F.array_join(F.array_sort(F.collect_list(F.struct("_block", "_element", "_text")))["_text"], "")
    return (
        fragments.withColumn("_whole", F.sum(ended).over(order) - ended)
        .groupBy("_file", "_whole")
        .agg(text.alias("_text"))
        .select("_text")
    )


def _lines(elements: DataFrame) -> DataFrame:
    """Elements without the sign before them, a comma or the array's bracket, each as one line."""
    flat = F.regexp_replace("_text", r"[\r\n]+", " ")
    bare = F.regexp_replace(flat, r"^[\s\uFEFF]*[\[,]\s*(?=\{)", "")
    # Without such a sign it is no element; a reader refuses what begins so.
    value = F.when(bare == flat, F.concat(F.lit("<"), flat)).otherwise(bare)
    # The last piece of a file has no brace behind it, but was given one like all others.
    close = r"^[\s\uFEFF]*\[?\s*\]\s*\}$"
    return elements.where(~F.col("_text").rlike(close)).select(value.alias("value"))
