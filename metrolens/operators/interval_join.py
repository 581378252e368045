"""Tickets matched to street segments by street name and house-number range.

Semantics (kept from the reference): a ticket matches a segment when the
street text equals the segment label and its house number lies inside the
right range *or* the left range (bounds inclusive). A ticket inside both
ranges of one segment counts once. Non-numeric house numbers and NULL,
non-numeric or inverted bounds never match. Counts are grouped by all
segment columns, so a segment row listed k times counts k times.

Plan (Spark-first, built-in operators only):

1. Tickets are pre-counted by (street, house number[, extra keys]). The
   partial aggregate runs map-side, so a hot street collapses to one row
   per house number per task before any shuffle.
2. Segments are reduced to their narrow match columns (label, bounds, id)
   and exploded into every house-number bin of width ``bin_width`` that
   one of their ranges touches (``array_union`` of both sides, so a bin is
   listed once). A ticket cell falls in exactly one bin, so the equi-join
   on (street, bin) meets each candidate pair exactly once; the range test
   remains as a residual filter.
3. Segments whose ranges span more than ``max_bins`` bins are exploded at a
   coarser bin level instead (widths grow by ``max_bins`` per level), and
   ticket cells are listed once per level in use, so one equi-join on
   (street, level, bin) covers every range exactly: nothing is capped or
   dropped, and a very wide segment adds at most ``max_bins`` rows.
   Cells whose extra keys are NULL (unparseable date or time) count 0 and
   their groups are dropped after the final aggregate.
4. Counts per narrow segment key are joined back (null-safe) to the full
   segment rows, which carry the wide geometry text only at the end.

The binned segment side is broadcast only behind a size check: a small job
over the segment keys bounds the number of bin rows (overlapping left and
right bins are de-duplicated afterwards), and only if that count times a row-size bound fits
``spark.sql.autoBroadcastJoinThreshold`` is it broadcast; otherwise both
sides are shuffled on (street, level, bin) with a sort-merge join. Spark's
own estimates cannot be used here because they do not see the explode.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

DEFAULT_RANGES: tuple[tuple[str, str], ...] = (("R_LOW_HN", "R_HIGH_HN"), ("L_LOW_HN", "L_HIGH_HN"))
SEGMENT_GROUP_COLS: tuple[str, ...] = ("PHYSICALID", "L_LOW_HN", "L_HIGH_HN", "R_LOW_HN", "R_HIGH_HN",
                                       "ST_LABEL", "the_geom")
DEFAULT_BIN_WIDTH = 16
DEFAULT_MAX_BINS = 1024


def whole_number(col: str) -> Column:
    """INT from a number or numeric text, decimals truncated (``100.0`` -> 100); other text (``7D``) is NULL.

    The cast goes through DECIMAL, since text to DOUBLE would read ``7D`` as 7.
    """
    return F.col(col).cast("string").try_cast("decimal(20,6)").try_cast("int")


def typed_segments(segments: DataFrame, ranges: Sequence[tuple[str, str]] = DEFAULT_RANGES) -> DataFrame:
    """P5: range bounds as INT; text that is not a number becomes NULL."""
    casts = {}
    for lo, hi in ranges:
        casts[lo] = whole_number(lo)
        casts[hi] = whole_number(hi)
    return segments.withColumns(casts)


def ticket_cells(tickets: DataFrame, street_col: str = "StreetName", number_col: str = "HouseNumber",
                 by: Sequence[str] = ()) -> DataFrame:
    """Tickets pre-counted by (street, house number, *by) -> (_street, _hn, *by, _n).

    Rows with a NULL ``by`` key are not counted (``_n`` counts only rows
    whose keys are all present); their groups carry ``_n = 0`` and are
    dropped after the aggregate. Filtering them here instead would make Catalyst
    repeat the key's derivation (e.g. a date parse) inside the scan filter.
    """
    cells = tickets.select(
        F.col(street_col).cast("string").alias("_street"),
        whole_number(number_col).alias("_hn"),
        *[F.col(c) for c in by],
    ).where(F.col("_street").isNotNull() & F.col("_hn").isNotNull())
    if by:
        keys_ok = None
        for c in by:
            keys_ok = F.col(c).isNotNull() if keys_ok is None else keys_ok & F.col(c).isNotNull()
        n = F.count(F.when(keys_ok, F.lit(1)))
    else:
        n = F.count(F.lit(1))
    out = cells.groupBy("_street", "_hn", *by).agg(n.alias("_n"))
    # a filter on the aggregate's output stays above it: cells of NULL keys
    # leave before the join without re-deriving the keys in the scan
    return out.where(F.col("_n") > 0) if by else out


def _range_hit(hn: Column, ranges: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lo, hi in ranges:
        part = (hn >= F.col(lo)) & (hn <= F.col(hi))
        cond = part if cond is None else (cond | part)
    return cond


def _level_widths(bin_width: int, fanout: int, max_value: int = 2**31) -> list[int]:
    """Bin widths per level: bin_width, bin_width*fanout, ... until one bin spans every int."""
    widths = [int(bin_width)]
    while widths[-1] * fanout < 2 * max_value:
        widths.append(widths[-1] * fanout)
    widths.append(widths[-1] * fanout)
    return widths


BIN_ROW_BYTES = 96  # of a (segment key, level, bin) row in a hashed relation, beside the text of its key


def _threshold_bytes(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 when broadcasting is off)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", raw)
    if not m:
        return -1
    return int(m.group(1)) * 1024 ** " kmgt".index(m.group(2) or " ")


def _broadcast_fits(spark, size: int) -> bool:
    limit = _threshold_bytes(spark)
    return limit >= 0 and size <= limit


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bins_sql(lo: str, hi: str, width: str) -> tuple[str, str]:
    """(bin count, bin array) of one range for a bin-width expression, as SQL; invalid ranges give (0, [])."""
    lo, hi = _q(lo), _q(hi)
    valid = f"({lo} <= {hi})"  # NULL bounds make this NULL, which CASE treats as false
    lo_b = f"floor(CAST({lo} AS BIGINT) / {width})"
    hi_b = f"floor(CAST({hi} AS BIGINT) / {width})"
    n = f"(CASE WHEN {valid} THEN {hi_b} - {lo_b} + 1 ELSE 0 END)"
    arr = f"(CASE WHEN {valid} THEN sequence({lo_b}, {hi_b}) ELSE CAST(array() AS ARRAY<BIGINT>) END)"
    return n, arr


def match_cells(cells: DataFrame, segments: DataFrame, key_cols: Sequence[str], *,
                label_col: str = "ST_LABEL", ranges: Sequence[tuple[str, str]] = DEFAULT_RANGES,
                bin_width: int = DEFAULT_BIN_WIDTH, max_bins: int = DEFAULT_MAX_BINS) -> DataFrame:
    """Every (ticket cell, segment key) pair that matches; cells keep their count ``_n``.

    Multi-level bins keep the join exact without a cap: level k has bin
    width ``bin_width * max_bins**k``. A segment is exploded at the finest
    level where its ranges touch at most ``max_bins`` bins (the coarsest
    level always qualifies), and each ticket cell is listed once per level
    with its bin at that level. A pair can only meet at the segment's
    level, and there in exactly one bin, so no pair is emitted twice.
    Segments without a valid range get no level and no bins. Cells are
    listed only for the levels some segment uses (one small job over the
    segment keys reads those few level numbers).

    ``segments`` must hold ``key_cols`` (which include the label and the
    bounds, already typed).
    """
    if max_bins < 2 * len(ranges) or bin_width < 1:
        # at the coarsest level every valid range touches at most 2 bins
        raise ValueError("max_bins must be at least 2 per range and bin_width at least 1")
    widths = _level_widths(bin_width, max_bins)
    widths_sql = "array(" + ", ".join(f"CAST({w} AS BIGINT)" for w in widths) + ")"
    counts = [_bins_sql(lo, hi, "w")[0] for lo, hi in ranges]
    level_sql = (f"nullif(array_position(transform({widths_sql}, "
                 f"w -> ({' + '.join(counts)}) BETWEEN 1 AND {max_bins}), true), 0)")
    arrays = [_bins_sql(lo, hi, "_w")[1] for lo, hi in ranges]
    bins_sql = arrays[0]
    for a in arrays[1:]:
        bins_sql = f"array_union({bins_sql}, {a})"

    seg = segments.select(*key_cols).distinct()
    seg = seg.select(*key_cols, F.expr(level_sql).cast("int").alias("_lvl"))
    # One small job over the segment keys returns, per level in use, an upper
    # bound of the bytes of its bin rows, from the keys' measured lengths (at
    # most len(widths) rows reach the driver). The levels decide how often
    # each ticket cell is listed; the bytes decide the join strategy below,
    # because no size estimate (static or AQE's, which is measured before the
    # explode) sees the exploded rows.
    n_sql = f"element_at(transform({widths_sql}, w -> {' + '.join(counts)}), _lvl)"
    bytes_sql = " + ".join([str(BIN_ROW_BYTES), *[f"coalesce(octet_length(cast({_q(c)} as string)), 0)" for c in key_cols]])
    stats = (seg.where(F.col("_lvl").isNotNull()).groupBy("_lvl")
                .agg(F.sum(F.expr(f"({n_sql}) * ({bytes_sql})")).alias("_bytes")).collect())
    used = sorted(r["_lvl"] for r in stats) or [1]
    bin_bytes = sum(int(r["_bytes"]) for r in stats)
    seg = seg.select(*key_cols, "_lvl", F.expr(f"element_at({widths_sql}, _lvl)").alias("_w"))
    seg_bins = seg.select(*key_cols, "_lvl", F.explode(F.expr(bins_sql)).alias("_bin"))
    if _broadcast_fits(segments.sparkSession, bin_bytes):
        seg_bins = F.broadcast(seg_bins)          # size checked just above
    else:
        seg_bins = seg_bins.hint("merge")         # shuffle both sides on (street, level, bin)

    cell_levels = "explode(array(" + ", ".join(
        f"named_struct('l', {lvl}, 'b', floor(CAST(_hn AS BIGINT) / {widths[lvl - 1]}))" for lvl in used) + "))"
    leveled = cells.select(*cells.columns, F.expr(cell_levels).alias("_lb")) \
                   .select(*cells.columns, F.col("_lb.l").alias("_clvl"), F.col("_lb.b").alias("_cbin"))
    joined = leveled.join(seg_bins, (F.col("_street") == F.col(label_col)) & (F.col("_clvl") == F.col("_lvl"))
                          & (F.col("_cbin") == F.col("_bin")))
    hit = " OR ".join(f"(_hn >= {_q(lo)} AND _hn <= {_q(hi)})" for lo, hi in ranges)
    return joined.where(F.expr(hit)).drop("_clvl", "_cbin", "_lvl", "_bin")


def tickets_per_segment(tickets: DataFrame, segments: DataFrame, *, by: Sequence[str] = (),
                        street_col: str = "StreetName", number_col: str = "HouseNumber",
                        label_col: str = "ST_LABEL", ranges: Sequence[tuple[str, str]] = DEFAULT_RANGES,
                        segment_cols: Sequence[str] = SEGMENT_GROUP_COLS, payload_cols: Sequence[str] = ("the_geom",),
                        bin_width: int = DEFAULT_BIN_WIDTH, max_bins: int = DEFAULT_MAX_BINS,
                        count_col: str = "count") -> DataFrame:
    """A3 (and A4/A5 with ``by``): matched ticket count per segment row [and extra keys].

    Returns ``segment_cols + by + [count_col]``; segments without a match
    are absent (inner join semantics).
    """
    # Segments are read once: distinct typed rows and how often each occurs are written to the shared
    # folder, from which the bins, their statistics and the final join are taken.
    checkpoint_root(segments.sparkSession)
    full = typed_segments(segments, ranges).groupBy(*segment_cols).agg(F.count(F.lit(1)).alias("_mult")).checkpoint(eager=True)
    key_cols = [c for c in segment_cols if c not in payload_cols]
    cells = ticket_cells(tickets, street_col, number_col, by)
    matched = match_cells(cells, full, key_cols, label_col=label_col, ranges=ranges,
                          bin_width=bin_width, max_bins=max_bins)
    counts = matched.groupBy(*key_cols, *by).agg(F.sum("_n").alias("_cnt")).where(F.col("_cnt") > 0)
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in key_cols], *by, "_cnt")

    cond = None
    for k in key_cols:
        c = full[k].eqNullSafe(counts[f"_k_{k}"])
        cond = c if cond is None else cond & c
    out = full.join(counts, cond, "inner")
    return out.select(*segment_cols, *by, (F.col("_cnt") * F.col("_mult")).alias(count_col))


def tickets_per_segment_direct(tickets: DataFrame, segments: DataFrame, *, by: Sequence[str] = (),
                               street_col: str = "StreetName", number_col: str = "HouseNumber",
                               label_col: str = "ST_LABEL", ranges: Sequence[tuple[str, str]] = DEFAULT_RANGES,
                               segment_cols: Sequence[str] = SEGMENT_GROUP_COLS,
                               count_col: str = "count") -> DataFrame:
    """The plain plan (equi-join on the street, range OR as residual); kept as the test oracle."""
    segs = typed_segments(segments, ranges)
    t = tickets.withColumn("_hn", whole_number(number_col))
    joined = t.join(segs, (F.col(label_col) == F.col(street_col)) & _range_hit(F.col("_hn"), ranges))
    return joined.groupBy(*segment_cols, *by).agg(F.count(F.lit(1)).alias(count_col))
