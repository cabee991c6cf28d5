"""SimHash fingerprints and searches by Hamming distance, in DataFrame functions only.

Terms are pairs of following words (lower case); the weight of a term is the length of its
first word, 8 at most, as long words say more.  The 64 bits of a term's hash vote with its
weight for or against each bit of the fingerprint.  Votes are counted two bits to a sum (32
bits of a 64-bit number each), in one aggregate over the words where they lie.

``near`` finds all fingerprints within a radius r by permuted block tables: of r + 2 blocks
of bits two at least agree, so a table per pair of blocks, keyed by the bits of both, holds
every pair within r in some table.  Only the first table in which a pair meets reports it.

Defined results: null and empty texts, and texts of white space, have the fingerprint 0;
a single word is a term by itself; equal votes give a 0 bit.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.ranges import range_bucket
from loanlens.llm.store import written

BITS, MAX_WEIGHT = 64, 8
_LANES = (1 << 32) | 1  # bit k and bit k + 32
ROWS_PER_BUCKET = 2000


def words(text: Column) -> Column:
    """Array of a hash per word; its low three bits hold the weight less one."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-8)).bitwiseOR((F.least(F.length(w), F.lit(MAX_WEIGHT)) - 1).cast("long")))


def terms(own: Column) -> Column:
    """Array of a hash per pair of following words, with the weight of the first; the last word is alone."""
    return F.zip_with(own, F.slice(own, 2, F.greatest(F.size(own), F.lit(1))),
                      lambda a, b: F.xxhash64(a, b).bitwiseAND(F.lit(-8)).bitwiseOR(a.bitwiseAND(F.lit(7))))


def with_fingerprint(df: DataFrame, keys: list[str], text_col: str, out: str = "fingerprint") -> DataFrame:
    """``keys`` and ``out`` (long) per row; ``keys`` tell the rows apart.  No shuffle where rows lie by one of them."""
    hashed = df.select(*keys, words(F.col(text_col)).alias("__own"))
    exploded = hashed.select(*keys, F.explode_outer(terms(F.col("__own"))).alias("__t"))
    votes = exploded.withColumn("__h", F.xxhash64("__t")).withColumn("__w", F.col("__t").bitwiseAND(F.lit(7)) + 1)
    sums = [F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(F.lit(_LANES)) * F.col("__w")).alias(f"__s{k}") for k in range(BITS // 2)]
    agg = votes.groupBy(*keys).agg(F.sum("__w").alias("__all"), *sums)
    bits = F.lit(0).cast("long")
    for k in range(BITS // 2):
        s = F.col(f"__s{k}")
        for lane, shift in ((s.bitwiseAND(F.lit((1 << 32) - 1)), k), (F.shiftrightunsigned(s, 32), k + 32)):
            bits = bits.bitwiseOR(F.when(2 * lane > F.col("__all"), F.shiftleft(F.lit(1).cast("long"), shift)).otherwise(F.lit(0).cast("long")))
    return agg.select(*keys, bits.alias(out))


def hexadecimal(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def followed(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text in buckets of ascending doc_id (bucket, place, ghost); after the last document comes the first.

    Rows with equal doc_id follow each other by text.  Each bucket also holds the first row of the
    next one as a ghost, so a bucket needs nothing from others; the text is shuffled once.
    """
    spark, slim = docs.sparkSession, docs.select("doc_id", "text")
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), slim.count() // ROWS_PER_BUCKET)
    dealt = slim.withColumn("bucket", range_bucket(slim, "doc_id", wanted))
    # a row per bucket; MAX_BUCKETS at most
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("first"))
    order = Window.orderBy("bucket")
    firsts = written(firsts.select(F.col("bucket").alias("b"), F.col("first.doc_id").alias("first_id"),
                                   F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("before")), "firsts")
    j = dealt.join(firsts, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("ghost"))
    rows = j.select("doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, ghost))).alias("p"))
    rows = rows.select("doc_id", "text", "p.bucket", "p.ghost")
    w = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    return rows.select("bucket", F.row_number().over(w).alias("place"), "ghost", "doc_id", "text", F.lead("text").over(w).alias("next_text"))


def _edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256 and the fingerprints f of the text, e of the edited text, next of the next document."""
    text, follow = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - cut), F.substring(follow, F.lit(1), cut))
    rows = followed(docs).select("bucket", "place", "ghost", "doc_id", n.cast("long").alias("n_chars"), text.alias("text"),
                                 F.when(~F.col("ghost"), edited).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    pair = F.when(F.col("ghost"), F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")))).otherwise(
        F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))))
    keys = ["bucket", "place", "ghost", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select(*keys, F.explode(pair).alias("p")).select(*keys, "p.which", "p.t")
    prints = with_fingerprint(both, [*keys, "which"], "t")
    of = prints.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("f"),
                                   F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("e"))
    of = of.withColumn("next", F.lead("f").over(Window.partitionBy("bucket").orderBy("place"))).where(~F.col("ghost"))
    return of.select("doc_id", "n_chars", "edited_sha256", "f", "e", "next")


def _reported(of: DataFrame) -> list[Column]:
    return [F.col("doc_id"), F.col("n_chars"), F.col("edited_sha256"), hexadecimal(F.col("f")).alias("fingerprint"),
            hexadecimal(F.col("e")).alias("edited_fingerprint"),
            likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("next")).alias("near_next")]


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (its last quarter replaced by the head of the next document's text).

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    of = _edited(docs)
    return of.select(*_reported(of))


def edited_likeness_and_neighbours(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """``edited_likeness`` and n_near: how many distinct fingerprints of the table lie within ``radius`` of the row's own.

    The block tables are asked for every doc_id that ``every`` divides, against all rows; the others have null.
    """
    of = written(_edited(docs), "fingerprints")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    found = near(of.where(asked).select(F.col("f").alias("fingerprint")), of.select(F.col("f").alias("fingerprint")), radius)
    counts = found.groupBy("query").agg(F.count(F.lit(1)).alias("n_near"))
    own = of.where(asked)
    own = own.join(counts, own["f"] == counts["query"]).select(*_reported(of), "n_near")
    return own.unionByName(of.where(~asked).select(*_reported(of), F.lit(None).cast("long").alias("n_near")))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of each block."""
    n = radius + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def near(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """(query, fingerprint, distance) of all distinct fingerprints within ``radius`` of the distinct queries.

    Both frames have a ``fingerprint`` (long; nulls are left out).  Copies are one fingerprint each.
    """
    if not 0 <= radius <= 14:
        raise ValueError("the radius is 0 to 14")
    blocks = _blocks(radius)
    tables = list(combinations(range(len(blocks)), 2))

    def block(c: Column, i: int) -> Column:
        shift, width = blocks[i]
        return F.shiftrightunsigned(c, shift).bitwiseAND(F.lit((1 << width) - 1))

    def permuted(df: DataFrame, name: str) -> DataFrame:
        c = F.col("fingerprint")
        keys = F.array(*[F.struct(F.lit(t).alias("table"), block(c, a).alias("x"), block(c, b).alias("y")) for t, (a, b) in enumerate(tables)])
        return df.select("fingerprint").where("fingerprint is not null").distinct().select(c.alias(name), F.explode(keys).alias("k")) \
            .select(name, "k.table", "k.x", "k.y")

    q, f = permuted(queries, "query"), permuted(prints, "found")
    first = F.lit(len(tables))
    for t, (a, b) in reversed(list(enumerate(tables))):
        same = (block(F.col("query"), a) == block(F.col("found"), a)) & (block(F.col("query"), b) == block(F.col("found"), b))
        first = F.when(same, t).otherwise(first)
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    meet = (q["table"] == f["table"]) & (q["x"] == f["x"]) & (q["y"] == f["y"])
    return (q.join(f, meet & (distance <= radius) & (q["table"] == first))
            .select("query", F.col("found").alias("fingerprint"), distance.alias("distance")))
