"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is the weighted set of its words, weighted by count. A count is a whole
number, so a word of weight w is the w elements (word, 1) .. (word, w), each of which
is as likely to be sampled as any other: a sample is a word and a place in its
weight. Two documents draw the same sample with the probability of their generalised
Jaccard similarity (sum of lesser weights over sum of greater ones), which is the
Jaccard similarity of their elements, however uneven the weights are.

A signature has ``bins`` samples. Where weights are whole numbers only the order of
arrivals matters, not their gamma-distributed times, so time runs in rounds: in each of
the first ``bins`` rounds every element enters the bin that its hash names, in the next
``bins`` rounds all elements enter bin 0, bin 1 and so on. A bin holds the first
element that entered it (of those of one round, the one of least hash). A text runs
the rounds that give ``DRAWS`` entries a bin; a bin that is empty then takes the
sample of another bin, probed in an order that all texts share, so that two texts
with the same empty bin agree there with the same probability as anywhere else, and a
text with an empty bin differs from one whose bin is filled, as it should: the first
element of their union is not its own. Likeness is the share of equal bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .native import words_of

_LOWEST = -(2**63)
#: Entries a bin: one in e**DRAWS bins stays empty and borrows.
DRAWS = 6
#: Bins that an empty one asks in turn; all are empty once in e**(DRAWS * PROBES).
PROBES = 8
#: A range of ids with more than this many times its share of rows is cut by text, too.
HOT = 4


def rounds_of(n: Column, bins: int) -> Column:
    """Rounds that a text of ``n`` words runs."""
    return F.when(n > 0, F.least(F.lit(2 * bins), F.ceil(F.lit(DRAWS * bins) / F.greatest(n, F.lit(1))))).otherwise(F.lit(0)).cast("long")


def draws(terms: DataFrame, keys: list[str], *, bins: int) -> DataFrame:
    """(keys, bin, v0, v1): what entered each bin of two texts first.

    ``terms`` has (keys, kind, t, w0, w1, n0, n1): a word's hash, its count in either
    text and the texts' numbers of words. The texts share most of their words, and an
    element enters the same bins wherever it stands, so its draws are made once.
    Rows of another kind than 0 are values to carry along: their bin is bins - 1 + kind.
    """
    r0, r1 = rounds_of(F.col("n0"), bins), rounds_of(F.col("n1"), bins)
    sized = terms.select(*keys, "kind", "t", "w0", "w1", r0.alias("r0"), r1.alias("r1"), F.greatest(r0, r1).alias("rounds"))
    count = F.greatest("w0", "w1") * F.col("rounds")
    spread = sized.select("*", F.explode(F.when(F.col("kind") > 0, F.array(F.lit(0).cast("long"))).when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1))).alias("d"))
    by = F.greatest("rounds", F.lit(1))
    i, r = F.floor(F.col("d") / by), F.col("d") % by
    drawn = spread.select(*keys, "kind", "t", i.alias("i"), r.alias("r"), "w0", "w1", "r0", "r1", F.xxhash64("t", i, r).alias("h"))
    # A hash's bits are used once each: bin, identity, order.
    part = lambda shift, bits: F.shiftrightunsigned("h", shift).bitwiseAND(F.lit((1 << bits) - 1))
    place = F.when(F.col("kind") > 0, F.col("kind") + (bins - 1)).when(F.col("r") < bins, part(0, 8).bitwiseAND(F.lit(bins - 1))).otherwise(F.col("r") - bins).cast("long")
    # The round of the first to enter and its identity travel in one integer, so the aggregate is a plain minimum.
    entered = F.shiftleft(F.col("r"), 54).bitwiseOR(F.shiftleft(part(26, 38), 16)).bitwiseOR(part(8, 16) % 65535 + 1)
    v = F.when(F.col("kind") > 0, F.col("t")).otherwise(entered)
    mine = lambda w, rounds: (F.col("kind") > 0) | (F.col("i") < F.col(w)) & (F.col("r") < F.col(rounds))
    packed = drawn.select(*keys, place.alias("bin"), F.when(mine("w0", "r0"), v).alias("v0"), F.when(mine("w1", "r1"), v).alias("v1"))
    return packed.groupBy(*keys, "bin").agg(F.min("v0").alias("v0"), F.min("v1").alias("v1"))


def signature(listed: Column, bins: int) -> Column:
    """Identities by bin from (bin << 16 | identity) integers; empty bins borrow, a text without words is all 0."""
    low = lambda x: x.bitwiseAND(F.lit(65535))
    held = F.map_from_arrays(F.transform(listed, lambda x: F.shiftright(x, 16)), F.transform(listed, low))
    probe = lambda b: F.coalesce(*(F.element_at(held, F.pmod(F.xxhash64(b, F.lit(k)), F.lit(bins)).cast("int")) for k in range(PROBES)), F.lit(0))
    empty = F.array_except(F.sequence(F.lit(0), F.lit(bins - 1)), F.map_keys(held))
    whole = F.sort_array(F.concat(listed, F.transform(empty, lambda b: F.shiftleft(b, 16).bitwiseOR(probe(b)))))
    return F.when(F.size(listed) == 0, F.array_repeat(F.lit(0), bins)).otherwise(F.transform(F.when(F.size(listed) == bins, F.sort_array(listed)).otherwise(whole), low))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among the filled ones; 1 where neither text has a word."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1).otherwise(2))
    same, filled = F.size(F.filter(pairs, lambda x: x == 1)), F.size(F.filter(pairs, lambda x: x > 0))
    return F.when(filled == 0, 1.0).otherwise(same / filled)


def as_text(sig: Column) -> Column:
    """Four hex digits per bin."""
    return F.lower(F.array_join(F.transform(sig, lambda x: F.substring(F.hex(x.cast("long") + 65536), 2, 4)), ""))


def _dealt(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, text, _o, _h) by ascending ranges of (_o, _h): range, guest.

    The first row of each range goes to the range before it as well, as a guest. The
    driver sees one bound for each range. Ranges are cut between ids; where one id
    (the null id, say) holds many times a range's share, they are cut between its
    texts, too.
    """
    ranges = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = ids.repartitionByRange(ranges, "_o").groupBy(F.spark_partition_id().alias("p")).agg(F.min("_o").alias("o"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in per)
    if any(r["n"] > HOT * (total // ranges + 1) for r in per):
        per = rows.select("_o", "_h").repartitionByRange(ranges, "_o", "_h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("_o", "_h")).alias("m")).collect()
        bounds = sorted({(r["m"]["_o"], r["m"]["_h"]) for r in per})
    else:
        bounds = sorted({(r["o"], _LOWEST) for r in per})
    bounds = bounds or [(_LOWEST, _LOWEST)]
    n = len(bounds)
    lo, lh = (F.split(F.lit(",".join(str(b[k]) for b in bounds)), ",").cast("array<bigint>") for k in (0, 1))
    # Rows below the first bound belong to the first range.
    reaches = lambda k: (F.get(lo, k) < F.col("_o")) | (F.get(lo, k) == F.col("_o")) & (F.get(lh, k) <= F.col("_h"))
    steps = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when((at + s < n) & reaches(at + s), at + s).otherwise(at))
    own = rows.withColumn("range", place).withColumn("guest", F.lit(0))
    heads = own.where(F.get(lo, F.col("range")) == F.col("_o")).groupBy("range").agg(F.min(F.struct("_o", "_h", "text", "doc_id")).alias("m"))
    guests = heads.select("m.doc_id", "m.text", "m._o", "m._h", F.pmod(F.col("range") - 1, F.lit(n)).alias("range"), F.lit(1).alias("guest"))
    return own.unionByName(guests).repartitionById(n, F.col("range"))


def fingerprint_documents(docs: DataFrame, *, bins: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text, its edited text, and compare with the next one's.

    The edited text has its last floor(n/2) code points replaced by the first as
    many (or all) of the next document in ascending id order; the last is followed
    by the first. Documents are dealt to ranges once and nothing moves after that: a
    document's words, draws and signature are aggregated where it lies. ``bins`` is a
    power of two, 256 at most.

    Null texts are empty (an all-zero fingerprint); null ids come first; rows with
    the same id are ordered by a hash of their text, then by the text, and repeated
    rows follow each other; a text may be of any length; an empty table gives no rows;
    other columns are ignored. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("_o")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), order)
    dealt = _dealt(rows.withColumn("_h", F.xxhash64("text")), docs.select(order))
    ordered = Window.partitionBy("range").orderBy("guest", "_o", "_h", "text")
    follow = dealt.select("range", "guest", "doc_id", "text", F.row_number().over(ordered).cast("long").alias("at"), F.lead("text").over(ordered).alias("following"))
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.when(F.col("guest") == 0, F.concat(F.substring("text", F.lit(1), chars - half), F.substring(F.coalesce("following", F.lit("")), F.lit(1), half)))
    texts = follow.select("range", "at", "guest", "doc_id", "text", edited.alias("edited"))
    split = texts.select("range", "at", words_of(F.col("text")).alias("l0"), words_of(F.col("edited")).alias("l1"), "guest", "doc_id", F.char_length("text").alias("n_chars"), F.sha2("edited", 256).alias("sha"))
    # A row's values travel as terms of kinds 1 to 7 behind its words.
    quarter = lambda k: F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10)
    values = F.array(F.col("guest").cast("string"), F.col("doc_id").cast("string"), F.col("n_chars").cast("string"), *(quarter(k) for k in range(4)))
    n0, n1 = F.size("l0"), F.size("l1")
    words = split.select("range", "at", n0.alias("n0"), n1.alias("n1"), F.posexplode(F.concat("l0", "l1", values)).alias("p", "word"))
    kind = F.greatest(F.col("p") - F.col("n0") - F.col("n1") + 1, F.lit(0))
    hashed = words.select("range", "at", "n0", "n1", "p", kind.alias("kind"), F.when(kind > 0, F.col("word").cast("long")).otherwise(F.xxhash64("word")).alias("t"))
    terms = hashed.groupBy("range", "at", "kind", "t").agg(F.count_if(F.col("p") < F.col("n0")).alias("w0"), F.count_if(F.col("p") >= F.col("n0")).alias("w1"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    entered = draws(terms, ["range", "at"], bins=bins)
    value = lambda k: F.max(F.when(F.col("bin") == bins - 1 + k, F.col("v0")))
    listed = lambda v: F.collect_list(F.when(F.col("bin") < bins, F.shiftleft(F.col("bin").cast("int"), 16).bitwiseOR(F.col(v).bitwiseAND(F.lit(65535)).cast("int"))))
    sets = entered.groupBy("range", "at").agg(listed("v0").alias("e0"), listed("v1").alias("e1"), *(value(k).alias(f"x{k}") for k in range(1, 8)))
    signed = sets.select("range", "at", *(f"x{k}" for k in range(1, 8)), signature(F.col("e0"), bins).alias("s0"), signature(F.col("e1"), bins).alias("s1"))
    # A guest has the greatest place of its range, as it was ordered behind all others.
    nearby = signed.withColumn("s2", F.lead("s0").over(Window.partitionBy("range").orderBy("at"))).where("x1 = 0")
    sha = F.lower(F.concat(*(F.lpad(F.hex(F.col(f"x{k}")), 16, "0") for k in range(4, 8))))
    return nearby.select(
        F.col("x2").alias("doc_id"),
        F.col("x3").alias("n_chars"),
        sha.alias("edited_sha256"),
        as_text(F.col("s0")).alias("fingerprint"),
        as_text(F.col("s1")).alias("edited_fingerprint"),
        likeness(F.col("s0"), F.col("s1")).alias("near_edited"),
        likeness(F.col("s0"), F.col("s2")).alias("near_next"),
    )
