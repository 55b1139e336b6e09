"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once; the top bits of the hash pick one of BINS bins, each of which keeps
its smallest hash. An empty bin takes over the bin that its own probing order meets first (optimal
densification: the order depends on the bin alone, so two documents agree on it wherever they agree
on what is filled). The fingerprint packs the low BITS bits of each bin as hexadecimal digits. Equal
bits by chance, one in 2^BITS, are taken out of the likeness.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, text_or_empty

WORDS = 5
BIN_BITS, BITS = 8, 8
BINS = 1 << BIN_BITS
DIGITS = BITS // 4
REST_BITS = 64 - BIN_BITS
EMPTY = (1 << REST_BITS) - 1        # what an empty bin holds until it is filled
FIRST_PROBES = 16
WHITE_SPACE = "[ \\t\\n\\u000b\\f\\r]+"
#: Rows that follow each other by key form blocks of about so many, or more where that makes over
#: MOST_BLOCKS of them; bounds of blocks are searched by steps of FANOUT.
ROWS_PER_BLOCK, MOST_BLOCKS, FANOUT = 512, 1 << 16, 64


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words, in order."""
    words = F.filter(F.split(F.lower(text), WHITE_SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: str) -> Column:
    """Hashes of WORDS words in a row; of all words if there are fewer."""
    w = F.col(words)
    many = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (WORDS - 1), F.lit(0))),
                       lambda first, i: F.xxhash64(first, *[w[i + n] for n in range(1, WORDS)]))
    few = F.array(F.xxhash64(w, F.size(w)))
    return F.when(F.size(w) >= WORDS, many).when(F.size(w) > 0, few).otherwise(F.array().cast("array<long>"))


def sorted_with_marks(hashes: str) -> Column:
    """The hashes and one mark per bin, the largest value that it can have, in order."""
    marks = F.array(*[F.lit(((b - BINS // 2) << REST_BITS) | EMPTY) for b in range(BINS)])
    return F.sort_array(F.concat(F.col(hashes), marks))


def bins(ordered: str) -> Column:
    """The smallest hash of every bin, without the bin's bits; null where it is empty."""
    o = F.col(ordered)
    smallest = F.filter(o, lambda h, i: (i == 0) | (F.shiftright(h, REST_BITS)
                                                    != F.shiftright(o[F.greatest(i - 1, F.lit(0))],
                                                                    REST_BITS)))
    rest = lambda h: h.bitwiseAND(F.lit(EMPTY))     # noqa: E731
    return F.transform(smallest, lambda h: F.when(rest(h) != F.lit(EMPTY), rest(h)))


def densified(sparse: str) -> Column:
    """Every empty bin filled; all null if there is nothing to fill it with. Probe t of bin i is
    a(i) + t * b(i) modulo BINS, b odd, which visits every bin."""
    s = F.col(sparse)

    def probe(i: Column, first: int, last: int) -> Column:
        start, stride = F.xxhash64(i, F.lit(1)), F.xxhash64(i, F.lit(2)).bitwiseOR(F.lit(1))
        mask = F.lit(BINS - 1)
        start, stride = start.bitwiseAND(mask), stride.bitwiseAND(mask)
        return F.aggregate(F.sequence(F.lit(first), F.lit(last)), F.lit(None).cast("long"),
                           lambda got, t: F.coalesce(got, s[(start + t * stride).bitwiseAND(mask)
                                                            .cast("int")]))
    return F.when(F.exists(s, lambda x: x.isNull()) & F.exists(s, lambda x: x.isNotNull()),
                  F.transform(s, lambda x, i: F.coalesce(x, probe(i, 1, FIRST_PROBES),
                                                         probe(i, FIRST_PROBES + 1, BINS)))
                  ).otherwise(s)


def low_bits(full: str) -> Column:
    return F.transform(F.col(full), lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("short"))


def packed(bits: Column) -> Column:
    """Hexadecimal digits, DIGITS per bin; an empty string for a text without words."""
    digits = F.transform(bits, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0"))
    return F.when(F.exists(bits, lambda x: x.isNotNull()), F.array_join(digits, "")).otherwise("")


def likeness(a: str, b: str) -> Column:
    """Estimated similarity of two shingle sets, 0 to 1. Two texts without words are alike; one
    without words is unlike any other."""
    equal = F.aggregate(F.zip_with(F.col(a), F.col(b), 
                                   lambda x, y: F.when(x == y, 1).otherwise(0)),
                        F.lit(0), lambda n, e: n + e)
    chance = 1.0 / (1 << BITS)
    share = (equal / F.lit(float(BINS)) - chance) / (1 - chance)
    none_a, none_b = F.col(a)[0].isNull(), F.col(b)[0].isNull()
    return (F.when(none_a & none_b, 1.0).when(none_a | none_b, 0.0)
            .otherwise(F.greatest(share, F.lit(0.0))))


def with_bins(df: DataFrame, text: str, to: str) -> DataFrame:
    """The low bits of the filled bins of a text in column `to`. Each step is a column of its own,
    since a lambda works its outer expressions out anew for every element."""
    steps = (("w", lambda: word_hashes(F.col(text))), ("h", lambda: shingle_hashes("_w")),
             ("o", lambda: sorted_with_marks("_h")), ("s", lambda: bins("_o")),
             ("d", lambda: densified("_s")))
    for name, step in steps:
        df = df.withColumn(f"_{name}", step())
    return df.withColumn(to, low_bits("_d")).drop(*[f"_{name}" for name, _ in steps])


def fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """All rows and columns with the packed fingerprint of the whole text in `to`, which replaces a
    column of that name. A null text has no words, as an empty one: its fingerprint is "". Equal
    texts have equal fingerprints. No shuffle."""
    return (with_bins(docs.withColumn("_text", text_or_empty(text)), "_text", "_bits")
            .withColumn(to, packed(F.col("_bits"))).drop("_text", "_bits"))


def _place_among(bounds: list, value: Column) -> Column:
    """How many of the ascending bounds are not above the value."""
    def not_above(few: Column) -> Column:
        return F.size(F.filter(few, lambda bound: bound <= value))
    if len(bounds) <= FANOUT:
        return not_above(F.array(*map(F.lit, bounds)))
    step = -(-len(bounds) // FANOUT)
    parts = [bounds[at:at + step] for at in range(0, len(bounds), step)]
    part = F.greatest(not_above(F.array(*[F.lit(p[0]) for p in parts])) - 1, F.lit(0))
    inner = F.array(*[F.array(*map(F.lit, p)) for p in parts])
    return part * step + not_above(inner[part])


def blocks_of(docs: DataFrame, key: str) -> Column:
    """The block of a row: ranges of keys with about as many rows each. Null keys: -1."""
    blocks = min(-(-docs.count() // ROWS_PER_BLOCK), MOST_BLOCKS)
    shares = [n / blocks for n in range(1, blocks)]
    if not shares:
        return F.when(F.col(key).isNotNull(), 0).otherwise(-1)
    found = docs.agg(F.percentile_approx(key, shares, 10 * blocks)).first()[0]
    bounds = sorted(set(found or []))
    place = _place_among(bounds, F.col(key)) if bounds else F.lit(0)
    return F.when(F.col(key).isNotNull(), place).otherwise(-1)


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text"):
    """Rows (doc_id, text, block, tie, extra) and the window in which each row's next follows it:
    by descending key, after the last the first. Null keys come last; rows that repeat a key go by
    a hash of their texts.

    Texts are shuffled once, by block. A block ends with an extra row, a copy of the head of the
    block that follows it.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = (rows.withColumn("block", blocks_of(rows, "doc_id"))
            .withColumn("tie", F.xxhash64("text")).withColumn("extra", F.lit(False)))
    tops = staged(rows.groupBy("block").agg(F.max("doc_id").alias("top")))
    places = Window.orderBy(F.col("block").desc())                  # one row per block
    whole = places.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = staged(tops.select(F.col("block").alias("_block"), "top", F.coalesce(
        F.lag("block").over(places), F.last("block").over(whole)).alias("before")))
    heads = (rows.join(F.broadcast(before),                         # MOST_BLOCKS rows and one
                       (F.col("block") == F.col("_block")) & F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy("before").agg(F.min(F.struct("tie", "text")).alias("head"))
             .select(F.lit(None).cast("long").alias("doc_id"), F.col("head.text").alias("text"),
                     F.col("before").alias("block"), F.col("head.tie").alias("tie"),
                     F.lit(True).alias("extra")))
    order = Window.partitionBy("block").orderBy("extra", F.col("doc_id").desc_nulls_last(), "tie")
    return rows.unionByName(heads), order


def edit_check(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text, in which the last half has given
    way to the start of the next document, and beside that document's own.

    Null texts are empty; a single row is its own next. Repeated rows stay. Empty input: no rows.
    """
    rows, order = in_order(docs, key, text)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (rows.withColumn("next_text", F.lead("text").over(order))
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(
                F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                F.substring(F.col("next_text"), F.lit(1), half))).drop("next_text")
            .withColumn("edited_sha256", F.sha2("edited", 256)))
    both = with_bins(with_bins(rows, "text", "own").drop("text"), "edited", "changed").drop("edited")
    following = both.withColumn("following", F.lead("own").over(order)).filter("not extra")
    return following.select(
        F.col("doc_id").alias(key), "n_chars", "edited_sha256",
        packed(F.col("own")).alias("fingerprint"), packed(F.col("changed")).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"))
