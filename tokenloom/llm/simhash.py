"""SimHash fingerprints in DataFrame functions, and their neighbours by permuted block tables.

Terms are runs of ``WIDTH`` words (a shorter text is one term), weighted by length. A term's hash votes
with its weight on each of 64 bits. Votes are counted two bits at a time: a shifted hash masked to bits
0 and 32 is a pair of counters in one number, so 32 sums hold all 64 counts, each up to 2^32.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import renamed, settle

WIDTH = 3
MAX_WEIGHT = 8
LANES = 0x0000000100000001
BLOCKS = 5
RADIUS = 3
RANGES = 4096


def terms(text: Column, width: int = WIDTH) -> Column:
    """The text's terms: runs of ``width`` words, lowered; words are letters and digits."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    # The array is bound by a lambda so that it is computed once.
    return F.flatten(F.transform(F.array(words), lambda w: F.when(F.size(w) > width, F.transform(
        F.sequence(F.lit(1), F.size(w) - width + 1), lambda i: F.array_join(F.slice(w, i, width), " "))
    ).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array())))


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fingerprint`` (a number of 64 bits) for each set of keys with equal texts; without words, 0.

    Repeated keys vote as often, which changes no majority.
    """
    exploded = texts.select(*keys, F.explode_outer(terms(F.col(text))).alias("term"))
    weighed = exploded.select(*keys, F.xxhash64("term").alias("h"), F.when(F.col("term").isNull(), 0).otherwise(
        F.least(F.lit(MAX_WEIGHT), F.expr("1 + length(term) div 8"))).cast("bigint").alias("w"))
    votes = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{i}") for i in range(32)]
    counted = weighed.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)
    bits = []
    for i in range(32):
        lanes = F.col(f"v{i}")
        for bit, count in ((i, lanes.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(lanes, 32))):
            bits.append(F.when(2 * count > F.col("w"), F.shiftleft(F.lit(1).cast("bigint"), bit)).otherwise(F.lit(0).cast("bigint")))
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return counted.select(*keys, bits[0].alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def neighbours(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(query_id, id, distance)``: all of ``prints`` within ``radius`` bits of a query's fingerprint, itself apart.

    Both have ``id`` and ``fingerprint``. The bits are cut into blocks; with at most ``radius`` differing bits,
    ``blocks - radius`` blocks agree, so one table for each such choice finds every pair; a pair counts in its first.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    signed = [m - (1 << 64) if m >> 63 else m for m in (
        sum(choice) for choice in combinations(masks, blocks - radius))]

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)]
        return df.select(F.col("id").alias(name), F.col("fingerprint").alias(f"{name}_print"), F.explode(F.array(keys)).alias("k")).select("*", "k.*").drop("k")

    found = tables(queries, "query_id").join(tables(prints, "id"), ["table", "key"])
    differing = F.col("query_id_print").bitwiseXOR(F.col("id_print"))
    first = F.lit(len(signed))
    for t, m in reversed(list(enumerate(signed))):
        first = F.when(differing.bitwiseAND(F.lit(m)) == 0, t).otherwise(first)
    return found.where((F.bit_count(differing) <= radius) & (F.col("query_id") != F.col("id")) & (F.col("table") == first)) \
        .select("query_id", "id", F.bit_count(differing).alias("distance"))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, next_id, next_text, repeat)``: the following row by id, then text; after the last, the first.

    ``repeat`` numbers the rows of one id and text.
    Rows are dealt to at most 65,536 ranges of ids; the first row of each range also goes to the
    range before it, so no window holds more than a range and the texts are shuffled once.
    """
    rows = renamed(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    width = max(1, (high - low + 1) // max(1, min(65_536, n // RANGES))) if low is not None else 1
    ranged = rows.withColumn("range", F.coalesce(F.expr(f"(id - ({low or 0})) div {width}"), F.lit(-1)))
    ranges = [r.range for r in ranged.select("range").distinct().orderBy("range").collect()]
    before = docs.sparkSession.createDataFrame(
        list(zip(ranges, ranges[-1:] + ranges[:-1], range(len(ranges)), strict=True)), "range bigint, earlier bigint, place bigint")
    heads = ranged.groupBy("range").agg(F.min(F.struct("id", F.xxhash64("text").alias("h"))).alias("first"))
    # One row is the first of its range; equal rows are told apart by their number.
    order = F.struct("id", F.xxhash64("text"))
    marked = ranged.withColumn("tie", F.xxhash64("text")).join(F.broadcast(heads), "range") \
        .withColumn("is_first", F.coalesce(F.col("id") == F.col("first.id"), F.col("first.id").isNull()) & (F.col("tie") == F.col("first.h")))
    doubled = marked.join(F.broadcast(before), "range").withColumn("copy", F.explode(
        F.when(F.col("is_first"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    placed = doubled.withColumn("range", F.when(F.col("copy"), F.col("earlier")).otherwise(F.col("range")))
    window = "OVER (PARTITION BY range ORDER BY copy, id NULLS FIRST, tie)"
    return placed.withColumn("next_id", F.expr(f"lead(id) {window}")).withColumn("next_text", F.expr(f"lead(text) {window}")) \
        .withColumn("repeat", F.expr("row_number() OVER (PARTITION BY range, copy, id, tie ORDER BY tie)")) \
        .where("NOT copy").select("id", "text", "next_id", "next_text", "repeat")


def rows_near(prints: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``prints`` with ``near_rows``: how many other rows have a fingerprint within ``radius`` bits; null unless ``asked``.

    Rows of one fingerprint are one entry of the block tables, with their number.
    """
    counted = settle(prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows")), "prints")
    entries = counted.select(F.struct("fingerprint", "rows").alias("id"), "fingerprint")
    asks = F.coalesce(asked, F.lit(False))
    queries = entries.join(prints.where(asks).select("fingerprint").distinct(), "fingerprint", "left_semi")
    others = neighbours(queries, entries, radius).groupBy(F.col("query_id.fingerprint").alias("fingerprint")).agg(F.sum("id.rows").alias("others"))
    near = queries.join(others, "fingerprint", "left").select(
        "fingerprint", (F.col("id.rows") - 1 + F.coalesce("others", F.lit(0))).alias("near_rows"))
    return prints.where(asks).join(near, "fingerprint").unionByName(
        prints.where(~asks).withColumn("near_rows", F.lit(None).cast("bigint")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: fingerprints of the text, of an edited text, and their likeness.

    The edited text has its last quarter of code points replaced by the first as many of the next document, in
    ascending id; after the last comes the first. Null texts count as empty; texts without words have
    fingerprint 0. Rows without an id come first. Rows that repeat id and text follow one another.
    """
    k = F.expr("length(text) div 4")
    rows = with_next(docs, id_col, text_col).select(
        "id", "text", "next_id", "repeat", F.xxhash64("next_text").alias("next_hash"), F.length("text").cast("bigint").alias("n_chars"),
        F.concat(F.expr("substring(text, 1, length(text) - length(text) div 4)"), F.substring("next_text", F.lit(1), k)).alias("edited"))
    keys = ["id", "repeat", "next_id", "n_chars", "edited_sha256", "text_hash", "next_hash"]
    both = rows.select(
        "id", "repeat", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("text").alias("text_hash"), "next_hash",
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
                          F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("b")).select(*keys, "b.*")
    votes = fingerprints(both, [*keys, "kind"], "body")
    own = settle(votes.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint")), "fingerprints")
    by_text = own.groupBy("text_hash").agg(F.max("fingerprint").alias("next_fingerprint")).withColumnRenamed("text_hash", "next_hash")
    return own.join(by_text, "next_hash", "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_fingerprint")), 16, "0").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
