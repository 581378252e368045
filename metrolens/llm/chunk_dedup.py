"""Exact deduplication by content-defined chunk recipes; DataFrame functions only.

Method: white space is deleted and the text is cut into chunks whose ends depend on the content only (a boundary
pair of characters after a shortest length, or a longest length). Chunks are deduplicated to identifiers: the
64-bit hash, verified by grouping hash and whole chunk; should two different chunks share a hash, an ordinal is
added to the identifier, so that an identifier stands for one chunk. Texts are equal exactly if their ordered lists
of identifiers are: from here only these lists move, never the documents.

Of equal texts the row with the most code points in the original text stays, then the smallest doc_id (null last);
of rows repeating that doc_id one stays. Nulls: a null text is empty; all empty texts are equal. An empty table
gives an empty result. Other columns are ignored. ``docs`` should come from files: it is scanned more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import numbered, settled, text_columns, text_rows

SPACE = r"[\x20\x09-\x0D]"
SHORTEST, LONGEST = 512, 8192


def boundary(remainder: int, *ranges: str) -> str:
    """Character class of the Latin-1 letters and digits whose code point leaves ``remainder`` by 16, and of ``ranges``."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x30, 0x100) if c % 16 == remainder and chr(c).isalnum()) + "".join(ranges) + "]"


#: A chunk ends after a pair of boundary characters (about one place in 150 of Latin text; the ranges serve Cyrillic
#: and Chinese), or at the longest length, or is the rest of the text.
CHUNK = (f"(?s).{{{SHORTEST},{LONGEST}}}?(?<={boundary(5, '\\u0430-\\u0431', '\\u4e00-\\u52ff')}"
         f"{boundary(3, '\\u0435-\\u0436', '\\u5000-\\u54ff')})|.{{1,{LONGEST}}}")


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def colliding_chunks(norm: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """Different chunks with the same hash: chunk string, ordinal long (empty, save for collisions)."""
    one = norm.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(hashed("chunk").alias("h"), "chunk")
    distinct = one.groupBy("h", "chunk").agg(F.lit(1).alias("one"))
    shared = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    shared = settled(shared)
    if shared.isEmpty():
        return norm.sparkSession.createDataFrame([], "chunk string, ordinal long")
    texts = distinct.join(F.broadcast(shared), "h", "left_semi")  # a few per 10^11 chunks (birthday bound)
    return texts.groupBy("h").agg(F.array_sort(F.collect_list("chunk")).alias("c")).select(
        F.posexplode("c").alias("ordinal", "chunk")).select("chunk", F.col("ordinal").cast("long"))


def recipes(rows: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """Per row (uid, doc_id, text): uid, doc_id, n_chars, text_sha256, recipe (ordered identifiers of its chunks)."""
    norm = rows.select("uid", "doc_id", F.length("text").cast("long").alias("n_chars"), normalised(F.col("text")).alias("norm"))
    collisions = settled(colliding_chunks(norm, hashed))
    if collisions.isEmpty():
        recipe = F.transform(chunks(F.col("norm")), lambda c: hashed(c))
    else:
        entries = collisions.agg(F.map_from_entries(F.collect_list(F.struct("chunk", "ordinal"))).alias("ordinals"))
        norm = norm.crossJoin(F.broadcast(entries))  # one row
        recipe = F.flatten(F.transform(chunks(F.col("norm")), lambda c: F.array(
            hashed(c), F.coalesce(F.col("ordinals")[c], F.lit(-1).cast("long")))))
    return norm.select("uid", "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe"))


def exact_groups(docs: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: uid, doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    return groups_of_rows(text_rows(docs).withColumn("uid", F.monotonically_increasing_id()), hashed)


def groups_of_rows(rows: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """``exact_groups`` of rows with a uid, doc_id and text. The uid is read in one scan only."""
    rows = settled(recipes(rows, hashed))
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    groups = settled(rows.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
                     .select("recipe", F.col("best.doc_id").alias("keep_id"), F.col("best.uid").alias("keep_uid"), "group_size"))
    # Both sides are shuffled for this join alone, so adaptive execution can split a recipe that holds many rows.
    return rows.join(groups, "recipe").select("uid", "doc_id", "keep_id", "group_size",
                                              (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256", "n_chars")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns as they were."""
    rows = numbered(docs, "__uid")
    groups = groups_of_rows(rows.select(F.col("__uid").alias("uid"), *text_columns()))
    stays = groups.filter("kept").select(F.col("uid").alias("__uid"))
    return rows.join(stays, "__uid", "left_semi").drop("__uid")
