"""Mixing sources to target weights by weighted fair queueing.

Method: each source's documents are shuffled (order by a hash of doc_id) and repeated in epochs; a copy's virtual
finish time is the source's tokens up to its end over the source's target. All copies are range-sorted by it and
the stream is cut at the total budget: at virtual time 1 every source has given its target. The copy that crosses
its source's target is cut there.

Targets: sources, in code point order (null last), weigh ``weights`` in turn and share the budget (100 % of all
sizes); a target stops at ``max_epochs`` times its source's size and the excess is shared by weight anew until none
is above (closed form: sources ordered by the level at which they fill up).

Running sums over all documents are two-step (per range partition, then offsets), so a hot source or a large corpus
never meets in one task. Only one row per source or partition is summed in a single task.

Size of a document: its runs of characters outside ``[\\x20\\x09-\\x0D]``; null text: 0. A null source is a source of
its own; a null doc_id is shuffled as an empty id. Sources without words have target 0. An empty table gives an
empty result. Repeated rows count each. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import broadcast_if_small, numbered, settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, MAX_EPOCHS = (5, 2, 1), 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over all rows before each in ``order``, which must be total."""
    parts = settled(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("__part").agg(F.sum(value).alias("__sum"))
               .select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset")))  # a row per partition
    before = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__offset") + F.coalesce(F.sum(value).over(before), F.lit(0)))
            .drop("__part", "__offset"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (source, size) rows: source, source_size, weight, target double, source_start (sizes of earlier sources)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())  # a row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1)
    per = per.select("source", "source_size", weight.alias("weight"), F.coalesce(
        F.sum("source_size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("source_start"))
    per = per.withColumn("fills_at", max_epochs * F.col("source_size") / F.col("weight"))
    by_level = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    upto, rest, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    # If all sources before this one are full, the others would rise to this level:
    level = (F.sum("source_size").over(whole) - max_epochs * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level).withColumn("open", F.col("level") <= F.col("fills_at"))
    first_open = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(max_epochs * F.col("source_size").cast("double"), F.col("weight") * first_open)
    return per.select("source", "source_size", "weight", "source_start", target.alias("target"))


def mixed_copies(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(rows, copies). rows: uid, doc_id, size, source_size, target. copies, one per document and epoch taken:
    uid, epoch, taken (words; less than the size where the copy is cut), finish (virtual), mix_start (words of the
    mixed stream before it)."""
    uid = F.col("__uid") if "__uid" in docs.columns else F.monotonically_increasing_id()  # read in one scan only
    sized = docs.select(uid.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))
    sized = settled(sized.withColumn("shuffle", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    targets = settled(source_targets(sized, weights, max_epochs))
    budget = targets.agg(F.sum("source_size").alias("b")).first()["b"] or 0  # one number
    order = [F.col("source").asc_nulls_last(), F.col("shuffle"), F.col("doc_id"), F.col("uid")]
    placed = running_sum(sized, order, "size", "before").alias("d").join(
        broadcast_if_small(targets, 256).alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "uid", "doc_id", "size", "source_size", "target", (F.col("before") - F.col("source_start")).alias("begin"))
    placed = settled(placed)
    epochs = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
    begin = F.col("epoch") * F.col("source_size") + F.col("begin")
    room = F.floor(F.col("target") - begin)
    copies = (epochs.withColumn("taken", F.least(F.col("size"), room).cast("long")).filter("taken > 0")
              .withColumn("finish", F.least((begin + F.col("size")) / F.col("target"), F.lit(1.0)))
              .select("uid", "doc_id", "epoch", "taken", "finish"))
    stream = running_sum(copies, [F.col("finish"), F.col("doc_id"), F.col("uid"), F.col("epoch")], "taken", "mix_start")
    stream = stream.withColumn("taken", F.least(F.col("taken"), F.lit(budget) - F.col("mix_start"))).filter("taken > 0")
    return placed, stream


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of ``docs``: uid, doc_id, size, source_size, target, taken, copies, mix_start of its first copy
    (null if none is taken)."""
    placed, stream = mixed_copies(docs, weights, max_epochs)
    taken = stream.groupBy("uid").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("copies"), F.min("mix_start").alias("mix_start"))
    return placed.join(taken, "uid", "left").select(
        "uid", "doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("copies", F.lit(0)).alias("copies"), "mix_start")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each taken copy as a row with the columns of ``docs``, a cut copy with its leading words."""
    rows = numbered(docs, "__uid")
    _, stream = mixed_copies(rows, weights, max_epochs)
    copies = stream.select(F.col("uid").alias("__uid"), F.col("taken").alias("__taken"))
    lead = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"(?s)[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
                                F.lit(1), F.col("__taken").cast("int")), "")
    cut = F.col("__taken") < words(F.col("text"))
    joined = rows.join(copies, "__uid")
    text = F.when(cut, lead).otherwise(F.col("text"))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
