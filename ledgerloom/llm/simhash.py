"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a word of the
perfect (23, 12) Golay code. Of r <= 4 differing bits the two segments with fewest have two each at
most. Two words that differ in two bits or fewer have a codeword within distance four of both: the
one that the word half-way between them decodes to. A word has one or six codewords so near, so a
pair of segments gives up to 36 keys of 24 bits, and linked fingerprints share one for some pair of
segments. Those that share a key are compared in full.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, staged, text_or_empty
from ledgerloom.llm.components import connected

WORDS = 4
SEED = 42
RADIUS = 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))        # shift, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
GENERATOR = 0xC75                                # the Golay code's generator polynomial
CODE_BITS, CHECK_BITS, NEAR = 23, 11, 6
#: Members of a key that one task compares at once. Larger groups are cut into blocks of this size,
#: and every two blocks meet in a task of their own.
BLOCK = 4096
SWEEP = 32


# ---- fingerprints

def fingerprint_of(text: str | None) -> int:
    """A bit is set if more than half of the shingles' hashes have it. Shingles: four words joined
    by a space, repeats included; all words if there are fewer; no words: zero."""
    import xxhash

    words = (text or "").encode().lower().split()    # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda end, n: end + n + 1))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(starts, ends[WORDS - 1:])]
                      if len(words) >= WORDS else [digest(line, SEED)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):
        counts += bits[at:at + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(bits)).tobytes(), "big")


def simhash(text: Column) -> Column:
    """The fingerprint as a signed long."""
    @F.arrow_udf("long")
    def simhash_of(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint_of(t) for t in texts.to_pylist()], dtype=np.uint64)
        return pa.array(prints.view(np.int64), pa.int64())
    return simhash_of(text)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# ---- keys

def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return rest


@lru_cache(maxsize=1)
def _near_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: up to six patterns of four or fewer errors that lead to a codeword, and how
    many there are."""
    found = [[] for _ in range(1 << CHECK_BITS)]
    for errors in range(5):
        patterns = np.array([sum(1 << place for place in places) for places
                             in itertools.combinations(range(CODE_BITS), errors)])
        for syndrome, pattern in zip(_syndromes(patterns).tolist(), patterns.tolist()):
            found[syndrome].append(pattern)
    table = np.zeros((1 << CHECK_BITS, NEAR), np.int64)
    for syndrome, patterns in enumerate(found):
        table[syndrome, :len(patterns)] = patterns
    return table, np.array([len(patterns) for patterns in found])


def codewords(prints: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords near a segment, six columns, and which of them count."""
    shift, bits = SEGMENTS[segment]
    words = (prints >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
    table, sizes = _near_patterns()
    syndromes = _syndromes(words)
    return (words[:, None] ^ table[syndromes]) >> CHECK_BITS, np.arange(NEAR) < sizes[syndromes, None]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys."""
    near = [codewords(prints, s) for s in range(len(SEGMENTS))]
    rows, keys = [], []
    for number, (one, two) in enumerate(PAIRS):
        valid = near[one][1][:, :, None] & near[two][1][:, None, :]
        both = near[one][0][:, :, None] << 12 | near[two][0][:, None, :] | number << 24
        rows.append(np.nonzero(valid)[0])
        keys.append(both[valid])
    return np.concatenate(rows), np.concatenate(keys)


def first_common_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The key at which a pair counts; others that it shares are passed over."""
    common = []
    for s in range(len(SEGMENTS)):
        (a, a_valid), (b, b_valid) = codewords(left, s), codewords(right, s)
        same = (a[:, :, None] == b[:, None, :]) & a_valid[:, :, None] & b_valid[:, None, :]
        common.append(np.where(same, a[:, :, None], 1 << 12).min(axis=(1, 2)))
    out = np.full(len(left), -1)
    for number, (one, two) in reversed(list(enumerate(PAIRS))):
        shared = (common[one] < 1 << 12) & (common[two] < 1 << 12)
        out = np.where(shared, number << 24 | common[one] << 12 | common[two], out)
    return out


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 4096):
            part = prints[at:at + 4096]
            rows, keys = keys_of(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), pa.array(part[rows].view(np.int64))],
                ["key", "fp"])


# ---- links

def _close(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= radius


def close_pairs(group: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs within the radius whose rows, in order of group, share a group."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    left, right = [], []
    at = np.flatnonzero(np.repeat(sizes <= SWEEP, sizes))
    for step in range(1, SWEEP):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        hit = at[_close(prints[at], prints[at + step], radius)]
        left.append(hit)
        right.append(hit + step)
    for start, size in zip(starts[sizes > SWEEP].tolist(), sizes[sizes > SWEEP].tolist()):
        own = prints[start:start + size]
        for row in range(0, size, 256):
            a, b = np.nonzero(_close(own[row:row + 256, None], own[None, row:], radius))
            ahead = a < b
            left.append(a[ahead] + (start + row))
            right.append(b[ahead] + (start + row))
    return np.concatenate(left), np.concatenate(right)


def spanning(left: list[int], right: list[int]) -> Iterator[tuple[int, int]]:
    """The pairs that join two sets: as few as connect what all pairs connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x
    for a, b in zip(left, right):
        one, two = root(a), root(b)
        if one != two:
            parent[one] = two
            yield a, b


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
        if held is None:
            return
        key, cell, fp = (held.column(i).to_numpy() for i in range(3))
        group = key.astype(np.int64) << 32 | cell
        done = len(group) if batch is None else int(np.searchsorted(group, group[-1]))
        held = held.slice(done)
        if not done:
            continue
        prints = fp[:done].view(np.uint64)
        left, right = close_pairs(group[:done], prints, radius)
        counts = first_common_key(prints[left], prints[right]) == key[:done][left]
        a, b = prints[left[counts]].view(np.int64), prints[right[counts]].view(np.int64)
        pairs = list(spanning(a.tolist(), b.tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): enough pairs of fingerprints with `radius` or fewer differing bits to connect all
    that such pairs connect. `prints`: one column fp, without repeats; radius: up to 5, for which
    two segments have at most two errors each."""
    if radius > 5:
        raise ValueError("the keys find every pair of up to 5 differing bits")
    keyed = prints.select("fp").mapInArrow(_key_batches, "key int, fp long")
    shared = (keyed.withColumn("n", F.count("*").over(Window.partitionBy("key")))
              .filter("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda other: F.least("own", other) * F.col("blocks")
                        + F.greatest("own", other))
    dealt = (shared.withColumn("blocks", blocks).withColumn("own", own)
             .select("key", F.explode(cells).alias("cell"), "fp")
             .repartition("key", "cell").sortWithinPartitions("key", "cell"))
    return dealt.mapInArrow(lambda batches: _link_batches(batches, radius), "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """One row per input row: the key, `fp` (the fingerprint as a signed long) and `component_id`,
    the smallest key in the group that links of `radius` or fewer differing bits connect.

    A null text has no words: fingerprint zero, linked like any other. Repeated rows stay. A null
    key takes part in its group but is never its id; a group of null keys only has a null id.
    Only fingerprints are compared: each distinct one once, however many documents have it.
    """
    ship_package(docs.sparkSession)
    prints = staged(docs.select(F.col(key), simhash(text_or_empty(text)).alias("fp")))
    distinct = staged(prints.groupBy("fp").agg(F.min(key).alias("first")))
    roots = connected(links(distinct, radius))
    # Roots have no row of their own among the nodes.
    members = roots.union(roots.select("root", "root").distinct()).toDF("fp", "root")
    linked = distinct.join(members, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    labels = staged(distinct.join(staged(linked.join(least, "root").select("fp", "least")),
                                  "fp", "left")
                    .select("fp", F.coalesce("least", "first").alias("component_id")))
    return prints.join(labels, "fp").select(key, "fp", "component_id")
