"""Document fingerprints by consistent weighted sampling; DataFrame functions only.

Method (Ioffe's improved sampling): a document's terms are its pairs of neighbouring words (a lone word is a term
itself), weighted by their counts w. For each of SAMPLES hash functions every term has r, c ~ Gamma(2, 1) and
b ~ U(0, 1), drawn from a hash of the term; t = floor(ln w / r + b), ln a = ln c - r * (t - b) - r. The sample is the
(term, t) of least ln a. Two documents' samples agree with probability sum(min w) / sum(max w), the generalised
Jaccard similarity; the share of equal samples estimates it (standard deviation at most 0.5 / sqrt(SAMPLES)).

Gamma(2, 1) draws are taken from a table of its quantiles at GAMMA_STEPS equal steps, b from 20 bits of the hash. The steps
that decide the least of many terms, the last one of r and the first one of c, are drawn exactly from 32 bits of a second hash each:
otherwise long texts would look less alike than they are. A
sample is kept as its ln a: equal (term, t) give equal values, others agree by chance once in some 2^30 draws.

Layout: rows are dealt to cells, contiguous ranges of doc_id, by one shuffle; the first row of a cell is also sent
to the cell before it. Words, counts, samples and the comparison with the next document all work inside a cell.

"Next" is descending doc_id; after the last row comes the first. A null text is empty; empty texts have the empty
fingerprint, which is like itself only. A null doc_id counts as the smallest. Rows repeating a doc_id follow each
other in order of text. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import settled, text_rows

SAMPLES = 32
GAMMA_STEPS = 1024
CELL_ROWS, MAX_CELLS = 256, 16_384
LEAST = -(1 << 63)
#: A salt for each hash function: odd multiples of the golden ratio's 64 bits, as signed numbers.
SALTS = [(((2 * k + 1) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)) - (1 << 63) for k in range(256)]


def gamma_quantiles(steps: int = GAMMA_STEPS) -> list[float]:
    """Quantiles of Gamma(2, 1) at (i + 0.5) / steps: solves 1 - (1 + x) exp(-x) = p by bisection."""
    out = []
    for i in range(steps):
        low, high, p = 0.0, 60.0, (i + 0.5) / steps
        for _ in range(70):
            mid = (low + high) / 2
            low, high = (mid, high) if 1 - (1 + mid) * math.exp(-mid) < p else (low, mid)
        out.append(low)
    return out


def greatest_gamma(u: Column) -> Column:
    """Gamma(2, 1) where its upper probability is u / GAMMA_STEPS: solves (1 + x) exp(-x) = u / GAMMA_STEPS by iteration, whose
    error falls tenfold a step."""
    high = math.log(GAMMA_STEPS) - F.log(u)
    x = high + F.log(1 + high)
    for _ in range(5):
        x = high + F.log(1 + x)
    return x


def least_gamma(u: Column) -> Column:
    """Gamma(2, 1) where its lower probability is u / GAMMA_STEPS: the inverse series of x * x / 2 - x ** 3 / 3 + x ** 4 / 8."""
    s = F.sqrt(u * (2 / GAMMA_STEPS))
    return s * (1 + s * (1 / 3 + s * (11 / 72)))


def sample_value(k: int) -> Column:
    """ln a of sample k in a row (term long, lnw double, the tables gamma, rate and log_gamma)."""
    h = F.xxhash64(F.col("term").bitwiseXOR(F.lit(SALTS[k])))
    finer = F.xxhash64(F.col("term").bitwiseXOR(F.lit(SALTS[k])), F.lit(1))  # only in the end steps
    bits = lambda at, n, of=h: F.shiftrightunsigned(of, at).bitwiseAND(F.lit((1 << n) - 1))
    share = lambda at: (bits(at, 32, finer) + 0.5) * (1 / (1 << 32))
    r_at, c_at = bits(0, 10).cast("int"), bits(10, 10).cast("int")
    b = bits(20, 20) * F.lit(1 / (1 << 20))
    last = r_at == GAMMA_STEPS - 1
    ratio = F.when(last, F.col("lnw") / greatest_gamma(share(0))).otherwise(F.col("lnw") * F.get("rate", r_at))
    t = F.when(F.col("lnw") == 0.0, F.lit(0.0)).otherwise(F.floor(ratio + b).cast("double"))
    log_c = F.when(c_at == 0, F.log(least_gamma(share(32)))).otherwise(F.get("log_gamma", c_at))
    return log_c + F.when(last, greatest_gamma(share(0))).otherwise(F.get("gamma", r_at)) * (b - 1.0 - t)


def cell_bounds(ids: DataFrame, rows: int) -> list[int]:
    """Lower doc_id bounds of all cells but the first: quantiles, a cell for each CELL_ROWS rows, MAX_CELLS at most."""
    cells = min(MAX_CELLS, math.ceil(rows / CELL_ROWS))
    if cells < 2:
        return []
    shares = [i / cells for i in range(1, cells)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 10 * max(1000, cells)).alias("q")).first()["q"] or []
    return sorted(set(found))


def cell_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds not above ``doc_id``: binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    seek = lambda at, step: F.when((at + step <= len(bounds)) & (F.get(table, at + step - 1) <= doc_id), at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), seek)


#: The first elements of a row's exploded terms carry its own values.
CARRIED = ["s0", "s1", "s2", "s3", "doc_id", "n_chars", "helper"]


def laid_out(docs: DataFrame) -> DataFrame:
    """Rows in cells: cell, helper (a copy of the next cell's first row), row long (unique in a cell, in order of the
    documents), doc_id, text, next_text."""
    rows = text_rows(docs).withColumn("oid", F.coalesce("doc_id", F.lit(LEAST)))
    ids = settled(rows.select("oid"))
    count = ids.count()
    bounds = cell_bounds(ids.withColumnRenamed("oid", "doc_id"), count)
    tops = ids.groupBy(cell_of(F.col("oid"), bounds).alias("cell")).agg(F.max("oid").alias("oid"))
    by_cell = Window.orderBy("cell")  # a row per cell, MAX_CELLS at most
    lowest = F.min("cell").over(Window.partitionBy())
    tops = settled(tops.select("oid", F.coalesce(F.lead("cell").over(by_cell), lowest).alias("to")))
    own = F.struct(cell_of(F.col("oid"), bounds).alias("cell"), F.lit(False).alias("helper"))
    sent = F.struct(F.col("to").alias("cell"), F.lit(True).alias("helper"))
    placed = rows.join(F.broadcast(tops), "oid", "left").select("oid", "doc_id", "text", F.explode(
        F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, sent))).alias("at")).select("at.*", "oid", "doc_id", "text")
    parts = max(1, math.ceil((len(bounds) + 1) / 4))
    inside = Window.partitionBy("cell").orderBy("helper", F.col("oid").desc(), "text")
    return placed.repartition(parts, "cell").select("cell", "helper", "doc_id", "text", F.row_number().over(inside).cast("long").alias("row"),
                                                    F.coalesce(F.lead("text").over(inside), F.lit("")).alias("next_text"))


def word_pairs(text: Column) -> Column:
    """array<struct<a string, b string>> of neighbouring words; (word, null) if there is one only; empty without words."""
    words = F.split(F.trim(F.lower(text), F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+")
    pairs = F.slice(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.size(words)).alias("b")), 1, F.greatest(F.size(words) - 1, F.lit(1)))
    return F.when(words[0] != "", pairs).otherwise(F.slice(pairs, 1, 0)).cast("array<struct<a:string,b:string>>")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text is the document's with its last half (floor) of code points replaced by the first as
    many of the next document. A fingerprint is 16 hash bits of each sample, in hexadecimal."""
    rows = laid_out(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("cell", "row", "doc_id", "n_chars", F.col("helper").cast("long").alias("helper"), "text", edited.alias("edited"))
    digest = F.sha2("edited", 256)
    carried = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10) for i in range(4)] + [F.col(c).cast("string") for c in CARRIED[4:]]
    carried = F.array(*[F.struct(c.alias("a"), F.lit(None).cast("string").alias("b")) for c in carried])
    versions = F.array(F.struct(F.lit(0).alias("v"), F.concat(carried, word_pairs(F.col("text"))).alias("terms")),
                       F.struct(F.lit(1).alias("v"), word_pairs(F.col("edited")).alias("terms")))
    each = rows.select("cell", "row", F.explode(versions).alias("x")).select(
        "cell", (F.col("row") * 2 + F.col("x.v")).alias("vrow"), F.col("x.v").alias("v"), F.posexplode_outer("x.terms").alias("pos", "term"))
    n = len(CARRIED)
    tag = F.when((F.col("v") == 0) & (F.col("pos") < n), F.col("pos")).otherwise(F.when(F.col("pos").isNull(), n + 1).otherwise(n))
    term = F.when(tag < n, F.col("term.a").cast("long")).otherwise(F.xxhash64("term.a", "term.b"))
    # Both groupings keep the cell as a key, so they need no further shuffle.
    counted = each.select("cell", (F.col("vrow") * 16 + tag).alias("vtag"), term.alias("term")).groupBy("cell", "vtag", "term").agg(
        F.count(F.lit(1)).alias("w")).select("cell", F.shiftright("vtag", 4).alias("vrow"), F.col("vtag").bitwiseAND(F.lit(15)).cast("int").alias("tag"), "term", "w")
    q = np.array(gamma_quantiles())
    tables = docs.sparkSession.createDataFrame([(n, q.tolist(), (1 / q).tolist(), np.log(q).tolist())],
                                               "tag int, gamma array<double>, rate array<double>, log_gamma array<double>")
    weighed = counted.select("cell", "vrow", "tag", "term", F.log(F.col("w").cast("double")).alias("lnw"))
    weighed = weighed.join(F.broadcast(tables), "tag", "left")  # one row, met by the terms only
    signed = weighed.groupBy("cell", "vrow").agg(
        *[F.min(sample_value(k)).alias(f"k{k}") for k in range(samples)],
        *[F.min(F.when(F.col("tag") == i, F.col("term"))).alias(c) for i, c in enumerate(CARRIED)])
    signed = signed.select("cell", "vrow", F.array(*[F.col(f"k{k}") for k in range(samples)]).alias("sig"), *CARRIED)
    inside = Window.partitionBy("cell").orderBy("vrow")
    both = signed.select("*", F.lead("sig", 1).over(inside).alias("edited_sig"), F.lead("sig", 2).over(inside).alias("next_sig"))
    own = both.filter((F.col("vrow") % 2 == 0) & (F.col("helper") == 0))

    def likeness(x: str, y: str) -> Column:
        alike = F.size(F.filter(F.zip_with(x, y, lambda a, b: a.eqNullSafe(b)), lambda e: e)) / F.lit(float(samples))
        return F.when(F.col(x)[0].isNull() | F.col(y)[0].isNull(), F.col(x)[0].eqNullSafe(F.col(y)[0]).cast("double")).otherwise(alike)

    def shown(sig: str) -> Column:
        return F.when(F.col(sig)[0].isNull(), F.lit("")).otherwise(F.array_join(F.transform(sig, lambda k: F.lower(F.lpad(
            F.hex(F.xxhash64(k).bitwiseAND(F.lit(0xFFFF))), 4, "0"))), ""))

    sha = F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 16, "0") for i in range(4)]))
    return own.select("doc_id", "n_chars", sha.alias("edited_sha256"), shown("sig").alias("fingerprint"),
                      shown("edited_sig").alias("edited_fingerprint"), likeness("sig", "edited_sig").alias("near_edited"),
                      likeness("sig", "next_sig").alias("near_next"))
