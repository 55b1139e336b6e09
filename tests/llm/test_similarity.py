"""SimHash near-duplicates, components, the kNN join and one-permutation MinHash."""
import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import catalog, components, copies, knn, oph, simhash

FOLDER = "/root/testdata/sf0.001"


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# ---- SimHash

def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "One TWO three", "É ÀB \x0b x\x1cy \xa0 z", "a b c d " * 400]
    texts += [" ".join(rng.choices("ab cde F é".split(), k=rng.randrange(700))) for _ in range(40)]
    for text in texts:
        assert simhash.fingerprint_of(text) == slow_fingerprint(text)


def test_spark_hashes_shingles_alike(spark):
    row = spark.sql("SELECT xxhash64('one two three four') AS h").first()
    assert row.h % 2 ** 64 == xxhash.xxh64_intdigest(b"one two three four", 42)


def test_golay_patterns():
    table, sizes = simhash._near_patterns()
    assert sorted(set(sizes.tolist())) == [1, 6] and (sizes == 6).sum() == 1771
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    near = words[:, None] ^ table[simhash._syndromes(words)]
    assert not simhash._syndromes(near[:, 0]).any()


def test_keys_find_every_close_pair():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
                      for _ in a], dtype=np.uint64)
    key = simhash.first_common_key(a, a ^ flips)
    assert (key >= 0).all()
    for x, y, k in zip(a[:50], (a ^ flips)[:50], key[:50]):
        for fp in (x, y):
            assert k in simhash.keys_of(np.array([fp]))[1]


def near_family(size, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, 6, dtype=np.uint64)
    out = base[rng.integers(0, 6, size)]
    for _ in range(5):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64))
    return np.unique(np.r_[base, out, rng.integers(0, 1 << 64, size, dtype=np.uint64)])


@pytest.mark.parametrize("block", [simhash.BLOCK, 20])
def test_links_connect_what_is_close(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)        # 20: keys are dealt over several tasks
    prints = near_family(400, 7)
    signed = prints.view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = [(r.u, r.v) for r in simhash.links(frame).collect()]
    close = np.bitwise_count(prints[:, None] ^ prints[None]) <= simhash.RADIUS
    true = {(signed[i], signed[j]) for i, j in zip(*np.nonzero(np.triu(close, 1)))}
    assert {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in true}
    assert roots_of(signed, found) == roots_of(signed, true)


def test_near_duplicates_of_the_documents(spark):
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    prints = {i: slow_fingerprint(t) for i, t in docs}
    links = [(i, j) for i in prints for j in prints
             if i < j and (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = roots_of(prints, links)
    rows = catalog.op3_simhash(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.fingerprint, r.component_id) == (format(prints[r.doc_id], "016x"), roots[r.doc_id])


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(9, None, 0), (4, "", 0), (5, "  ", 0), (7, "a b c d e", 0), (7, "a b c d e", 0),
         (None, "A B c d e", 0), (None, "alone", 0), (8, "w " * 20_000, 0)],
        "doc_id long, text string, fp int")
    got = sorted(simhash.near_duplicates(docs).select("doc_id", "component_id").collect(), key=str)
    want = [(4, 4), (5, 4), (7, 7), (7, 7), (8, 8), (9, 4), (None, 7), (None, None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1)], [(None, 1), (2, 3)], [(k, k + 1) for k in range(60)],
                                   [(0, k) for k in range(1, 50)] + [(k, 100 + k) for k in range(50)],
                                   [(1, 2), (2, 1), (1, 2), (5, 4), (4, 9)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in components.connected(frame).collect()}
    real = [p for p in links if None not in p]
    want = roots_of({n for p in real for n in p}, real)
    assert got == {n: r for n, r in want.items() if n != r}


# ---- kNN

def slow_top_k(rows, k, every):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            whole.setdefault(i, []).append(tuple(int(np.floor(1024 * np.float64(x))) for x in v))
    out = []
    for q in sorted(i for i in whole if i % every == 0):
        scored = [(-sum(a * b for a, b in zip(whole[q][0], v)), i)
                  for i in whole if i != q for v in whole[i]]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("size", [dict(), dict(pivots=5, query_block=3, data_block=7)])
def test_top_k(spark, size):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (4, 6))
    rows = [(int(i), (centres[i % 4] + rng.normal(0, 0.1, 6)).astype(np.float32).tolist())
            for i in range(160)]
    rows += [(160 + i, rows[3][1]) for i in range(30)]              # ties
    rows += [(300, None), (None, rows[0][1]), (301, [None] * 6), (302, [float("nan")] * 6),
             (303, [float("inf")] + [0.0] * 5), (310, []), (320, [1.0]), (50, rows[50][1])]
    rows += [rows[41]] * 3 + [rows[77]] * 9                         # rows that stand in results again
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = knn.top_k(frame.withColumn("rank", F.lit("clash")), k=5, every=10, **size).collect()
    assert sorted(map(tuple, got)) == slow_top_k(rows, 5, 10)


def test_repeated_rows_by_operator_and_sql(spark):
    rows = [(0, [1.0, 0.0])] * 2 + [(1, [0.5, 0.0])] * 2 + [(2, [0.9, 0.0]), (100, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    duck = duckdb.connect()
    duck.register("given", frame.toArrow())
    duck.execute("CREATE VIEW embeddings AS SELECT * FROM given")
    got = sorted(map(tuple, knn.top_k(frame).collect()))
    assert got == sorted(duck.execute(catalog.OP4_SQL).fetchall())
    assert [(r[1], r[2]) for r in got if r[0] == 0] == [(1, 2), (2, 1), (3, 1), (4, 100)]


def test_top_k_with_few_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert knn.top_k(spark.createDataFrame([], kind)).count() == 0
    assert knn.top_k(spark.createDataFrame([(1, [1.0])], kind)).count() == 0
    few = knn.top_k(spark.createDataFrame([(0, [1.0]), (1, [-1.0]), (200, [3.0])], kind)).collect()
    assert sorted(map(tuple, few)) == [(0, 1, 200, 3 * 1024 ** 2), (0, 2, 1, -(1024 ** 2)),
                                       (200, 1, 0, 3 * 1024 ** 2), (200, 2, 1, -3 * 1024 ** 2)]


def test_top_k_of_wide_numbers(spark):
    """Beyond 2^53 products are added as integers."""
    rows = [(100 * i, [float(2 ** 20 + i), float(3 ** 9 * i)]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, knn.top_k(frame, k=3).collect())) == slow_top_k(rows, 3, 100)


def test_groups_of_queries_need_less_than_all():
    space = knn.Space(np.array([[0.0], [100.0]]), np.zeros(2), 10_000.0, 1)
    p = knn.plan(space, {0: (3, 1.0), 1: (5, 1.0)}, {0: [0.0, 1.0], 1: [0.0, 1.0]}, 2, 4)
    assert [len(g) for g in p.groups] == [1, 2]
    assert p.low[0, 1] > 10 and p.high[0, 0] < 10       # cell 0 has no use for data near pivot 1


# ---- MinHash

def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_edited_documents(spark):
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' "
                          "ORDER BY doc_id DESC").fetchall()
    rows = {r.doc_id: r for r in catalog.op5_one_permutation(spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    errors = []
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r.near_edited), (following, r.near_next)):
            a, b = shingle_set(text), shingle_set(other)
            errors.append(near - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_blocks_meet(spark, monkeypatch):
    """The next document is the right one however rows fall into blocks."""
    monkeypatch.setattr(oph, "ROWS_PER_BLOCK", 3)
    monkeypatch.setattr(oph, "FANOUT", 4)
    texts = {i: f"text of {i} " + "x" * (i % 7) for i in range(0, 200, 2)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in oph.edit_check(frame).collect()}
    order = sorted(texts, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[j][:half]
        assert got[i] == hashlib.sha256(edited.encode()).hexdigest()


def test_minhash_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "same words here", 0), (3, "same words here", 0),
         (None, "other", 0), (5, "Same  WORDS\nhere", 0), (6, "é " * 30_000, 0)],
        "doc_id long, text string, block int")
    rows = oph.edit_check(docs).collect()
    assert len(rows) == 7
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] == "" and prints[3] == prints[5] != prints[6]
    assert all(len(p) in (0, oph.BINS * oph.DIGITS) for p in prints.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.doc_id: r.near_next for r in rows}[2] == 1.0      # both without words
    assert oph.edit_check(docs.limit(0)).count() == 0
    (single,) = oph.edit_check(docs.filter("doc_id = 5")).collect()
    assert single.near_next == 1.0
    assert oph.fingerprint(docs, to="block").filter("doc_id = 5").first().block == prints[5]


def test_likeness_of_known_sets(spark):
    """Estimates spread around the true similarity as BINS draws would, with few shingles too."""
    rng, rows = random.Random(8), []
    for n in (1, 3, 10, 60, 300):
        for k in range(20):
            words = [str(rng.random()) for _ in range(n + 4)]
            rows.append((n, " ".join(words), " ".join(words[:len(words) * k // 20] + ["z"] * 5)))
    frame = spark.createDataFrame(rows, "n int, a string, b string")
    both = oph.with_bins(oph.with_bins(frame, "a", "x"), "b", "y")
    off = [r.near - len(shingle_set(r.a) & shingle_set(r.b)) / len(shingle_set(r.a) | shingle_set(r.b))
           for r in both.select("a", "b", oph.likeness("x", "y").alias("near")).collect()]
    assert abs(np.mean(off)) < 0.02 and np.max(np.abs(off)) < 0.25


# ---- near-duplicates by shingle sets

def kept_rows(docs):
    """Brute force: the first of each group, by key (null last)."""
    sets = [shingle_set(t) for _, t in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a)
             if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    groups = {}
    for n, root in roots_of(range(len(docs)), links).items():
        groups.setdefault(root, []).append(docs[n][0])
    return sorted((min(g, key=lambda k: (k is None, k or 0)) for g in groups.values()), key=str)


def planted(seed, n_base=12, copies_of=12):
    """Texts with edited copies at 0.6 to 0.97, and a line that a third of them share."""
    rng = random.Random(seed)
    word, docs = lambda: f"w{rng.randrange(900)}", []
    line = " ".join(f"line{k}" for k in range(30))
    for b in range(n_base):
        base = [word() for _ in range(rng.choice([8, 60, 200, 400]))]
        docs.append(" ".join(base) + (" " + line if b % 3 == 0 else ""))
        for _ in range(copies_of):
            words = docs[-1 if rng.random() < 0.3 else -1 - rng.randrange(len(docs))].split()
            for _ in range(rng.randrange(1, max(2, len(words) // 30))):
                words[rng.randrange(len(words))] = word()
            docs.append(" ".join(words))
    return docs


@pytest.mark.parametrize("block", [copies.BLOCK, 4])
def test_copies_at_all_likenesses(spark, monkeypatch, block):
    monkeypatch.setattr(copies, "BLOCK", block)
    docs = list(enumerate(planted(3)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = [r.doc_id for r in copies.deduplicate(frame).collect()]
    assert sorted(got, key=str) == kept_rows(docs)
    groups = simhash.near_duplicates(frame).select("component_id").distinct().count()
    assert len(got) < len(docs) / 2 and groups > 1.3 * len(got)


def test_fingerprints_that_differ_in_the_first_bit():
    """Two sets that are 4 bits apart, the sign among them, are a pair; 25 bits apart they aren't."""
    def pairs(fp):
        rows = {"key": [1, 1], "cell": [0, 0], "own": [0, 0], "node": [b"a", b"b"], "root": [b"a", b"b"],
                "size": [50, 50], "place": [0, 0], "fp": pa.array([0, fp], pa.int64())}
        return sum(b.num_rows for b in copies._pair_batches(iter(pa.table(rows).to_batches())))
    assert pairs(7 - 2 ** 63) == pairs(15) == pairs(-1 << 40) == 1
    assert pairs((1 << 24) - 1 - 2 ** 63) == pairs(-1 << 39) == 0


@pytest.mark.parametrize("together", [0, copies.TOGETHER])
def test_alike_sets_are_linked_whatever_their_fingerprints(spark, monkeypatch, together):
    """Four of five shingles are alike; these fingerprints differ in 25 bits."""
    monkeypatch.setattr(copies, "TOGETHER", together)
    docs = []
    for seed in (3984, 6857, 14082):
        words = [f"{seed}x{k}" for k in range(9)]
        docs += [(seed, " ".join(words)), (seed + 1, " ".join(words[:8]))]
        a, b = (copies.fingerprint(copies.shingles(t)) for _, t in docs[-2:])
        assert ((a ^ b) & (2 ** 64 - 1)).bit_count() > copies.FAR
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in copies.deduplicate(frame).collect()) == [3984, 6857, 14082]


@pytest.mark.parametrize("share", [0.97, 0.9, 0.85, 0.8])
def test_one_planted_copy(spark, share):
    """At the bound itself too: 45 of 50 shingles in either, 0.8181, and 40 of 45 and 45, 0.8."""
    n, changed = {0.97: (400, 6), 0.9: (400, 21), 0.85: (400, 32), 0.8: (45, 5)}[share]
    words = [f"a{k}" for k in range(n + 4)]
    other = words[:n + 4 - changed] + [f"b{k}" for k in range(changed)]
    a, b = shingle_set(" ".join(words)), shingle_set(" ".join(other))
    assert share <= len(a & b) / len(a | b) < share + 0.01
    less = words[:n + 3 - changed - n // 80] + [f"b{k}" for k in range(changed + 1 + n // 80)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "all by itself here and now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in copies.deduplicate(frame).collect()) == [1, 3]
    if share == 0.8:
        rows[1] = (2, " ".join(less))
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert copies.deduplicate(frame).count() == 3


def test_stage_keeps_one_of_the_alike(spark):
    docs = duckdb.execute("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, frame, FOLDER).collect()]
    assert sorted(got, key=str) == kept_rows(docs)


def test_rows_without_or_with_repeated_ids(spark):
    """Rows are compared, not ids: a copy without an id goes, an unlike row of the same id stays."""
    docs = [(7, "a b c d e"), (None, "A B c d e"), (None, "alone"), (None, "alone"),
            (5, "one two three four five six"), (5, "quite another text of the same id"), (9, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = copies.deduplicate(frame).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [docs[0], docs[2], docs[4], docs[5], docs[6]], key=str)


@pytest.mark.parametrize("together", [0, 3, copies.TOGETHER])
def test_groups_of_any_size_lose_no_link(spark, monkeypatch, together):
    """Sets that hang together are compared in one task or, when there are too many, as pairs."""
    monkeypatch.setattr(copies, "TOGETHER", together)
    docs = list(enumerate(planted(5, 8, 10)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id for r in copies.deduplicate(frame).collect()), key=str) == kept_rows(docs)


def test_a_key_sends_on_rows_as_many_as_its_sets():
    n = 300
    node = [b"%03d" % k for k in range(n)]
    rows = {"key": [1] * n, "cell": [0] * n, "own": [0] * n, "node": node, "root": node, "size": [50] * n,
            "place": [0] * n, "fp": pa.array([k % 8 for k in range(n)], pa.int64())}
    batches = pa.table(rows).to_batches()
    assert sum(b.num_rows for b in copies._pair_batches(iter(batches))) == n * (n - 1) // 2
    chain = [r for b in copies._chain_batches(iter(batches)) for r in b.to_pylist()]
    assert len(chain) == n - 1 and {r["nu"] for r in chain} == {50}
    assert len(set(roots_of(node, [(r["u"], r["v"]) for r in chain]).values())) == 1


def test_bucket_counts_rule_out_no_alike_pair(spark):
    """The bound holds for any two sets; of unlike ones it leaves few."""
    rng = np.random.default_rng(3)
    pairs, alike = [], []
    for k in range(300):
        n = int(rng.integers(1, 600))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.r_[a[:int(n * k / 300)], rng.integers(0, 1 << 63, n - int(n * k / 300)).astype(np.uint64)]
        pairs.append((copies.bucket_counts(a), copies.bucket_counts(b)))
        both = len(np.intersect1d(a, b))
        alike.append(5 * both >= 4 * (2 * n - both))
    assert copies.bucket_counts(np.full(256, 7, np.uint64)) is None
    pairs.append((None, pairs[0][0]))
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a binary, b binary")
    may = [r.may for r in frame.withColumn("may", copies._may_be_alike(F.col("a"), F.col("b"))).orderBy("k").collect()]
    assert may[-1] and all(m for m, yes in zip(may, alike) if yes)
    assert sum(alike) > 20 and sum(may) < 2 * sum(alike) + 20


def test_what_a_worker_holds_is_bounded(monkeypatch):
    """Of a group, so many shingles are looked up at once; rows of shared keys leave in parts."""
    rng, most, both = random.Random(4), [], copies._both
    monkeypatch.setattr(copies, "AT_ONCE", 500)
    monkeypatch.setattr(copies, "_both", lambda held, few, size: most.append(sum(size)) or both(held, few, size))
    texts = [" ".join(str(rng.random()) for _ in range(84)) for _ in range(40)]
    texts += [t + " more" for t in texts[:9]]
    names = [b"%02d" % k for k in range(len(texts))]
    group = pa.table({"group": [b"a"] * len(texts), "node": names, "root": names, "_text": texts})
    got = {(r["u"], r["v"]) for r in copies._linked_together(group).to_pylist()}
    assert got == {(names[k], names[40 + k]) for k in range(9)}
    assert max(most) <= 500 + 81 and sum(most) > 40 * 500

    run, none = copies._Run(), np.zeros(0, np.uint64)
    for k, text in enumerate(texts):
        run.add(names[k], copies.shingles(text), none, none.astype(int))
    rows = list(run.rows(0))
    whole = pa.table({"index": [rows[0][2]], "records": [rows[0][3]], "sets": [rows[0][4]]})
    answers = [(r[1], copies.runs.squeeze([tuple(copies.runs.unpack_index(r[2]))])) for r in rows[1:]]
    answers = pa.table({"section": [a for a, _ in answers], "answer": [b for _, b in answers]})
    at_once = copies._shared(whole, answers)
    monkeypatch.setattr(copies, "ROWS_AT_ONCE", 7)
    parts = copies._shared(whole, answers)
    assert parts.equals(at_once) and len(parts) > 9
    assert max(b.num_rows for b in parts.to_batches()) == 7


def test_sets_that_hang_together_are_compared_in_full():
    """45 of 50 shingles in either is alike, 40 of 50 isn't; what is linked already is left."""
    texts = [" ".join([f"a{k}" for k in range(54 - c)] + [f"{c}b{k}" for k in range(c)]) for c in (0, 5, 20)]
    names = [b"a", b"b", b"c"]

    def pairs(roots):
        table = pa.table({"group": [b"a"] * 3, "node": names, "root": roots, "_text": texts})
        return [(r["u"], r["v"]) for r in copies._linked_together(table).to_pylist()]
    assert pairs(names) == [(b"a", b"b")] and pairs([b"a", b"a", b"c"]) == []
