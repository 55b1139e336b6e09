"""Language ID, mixing, URL filters, chat trees and the pipeline."""
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import catalog, chat, copies, langid, mixing, urlfilter
from ledgerloom.llm.bpe import load

FOLDER = "/root/testdata/sf0.001"
CODER = load(catalog.RANKS, catalog.PATTERN)


def view(name):
    return f"'{FOLDER}/{name}.parquet'"


# ---- language ID

def test_gradients(monkeypatch):
    """Backpropagation through time against differences."""
    monkeypatch.setattr(langid, "CONTEXT", 1)
    rng = np.random.default_rng(0)
    net = langid.Network.new(["a", "b", "c"], hidden=3, seed=1)
    for part in net.parts():        # double precision, for the differences
        part += rng.normal(0, 0.2, part.shape).astype(np.float32)
    codes = rng.integers(0, 5, (7, 4)).astype(np.intp)
    codes[5:, 2] = langid.PAD
    wanted = np.array([0, 1, 2, 1])

    def loss():
        p = net.labels(codes)
        own = np.take_along_axis(p, wanted[None, None, :].repeat(7, axis=1), axis=0)[0]
        counts = langid.labelled(codes)
        return -(np.log(own) * counts).sum() / counts.sum()
    for part, slope in zip(net.parts(), net.gradients(codes, wanted)):
        for place in list(np.ndindex(part.shape))[:40]:
            old, step = part[place], np.float32(1e-2)
            part[place] = old + step
            up = loss()
            part[place] = old - step
            down = loss()
            part[place] = old
            assert abs((up - down) / 0.02 - slope[place]) < 3e-3


def test_both_ways_of_running_agree():
    net = langid.Network.new(["a", "b"], seed=2)
    codes = np.random.default_rng(1).integers(0, 257, (langid.WINDOW, 5))
    steps = range(langid.WINDOW)
    assert np.allclose(net.ahead.run(codes, steps), net.ahead.run_kept(codes, steps)[0], atol=1e-5)


def test_windows_hold_all_bytes():
    texts = [b"", b"x" * langid.WINDOW, b"abc" * 1000]
    codes, owner = langid.windows(texts)
    for k, text in enumerate(texts):
        own = codes[:, owner == k].T[langid.labelled(codes[:, owner == k]).T]
        assert bytes(own.astype(np.uint8)) == text


def test_languages_of_the_documents(spark):
    rows = catalog.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    want = dict(duckdb.execute("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'")
                .fetchall())
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(want) and len(held) > 250
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    german = known.filter("lang = 'de'").orderBy("doc_id").first().text
    odd = spark.createDataFrame(
        [(-1, None, "en"), (-2, "", None), (-3, "123 ²½ !?", "de"), (None, "the and of that", None),
         (-5, "x", None), (-5, "x", None), (-6, german * 300, None)], known.schema)
    rows = langid.identify(spark, known.unionByName(odd).withColumn("score", F.lit("clash")))
    found = {(r.doc_id, r.text if r.doc_id != -6 else "long"): r for r in rows.filter("doc_id < 0 OR doc_id IS NULL").collect()}
    for key in ((-1, None), (-2, ""), (-3, "123 ²½ !?")):
        assert (found[key].lang_pred, found[key].score) == ("und", 0.0)
    assert found[(-6, "long")].lang_pred == "de"
    assert not found[(None, "the and of that")].held_out
    kept = langid.accept(spark, known.unionByName(odd))
    assert kept.columns == known.columns
    assert {r.doc_id for r in kept.filter("doc_id < 0").collect()} <= {-5, -6}


def test_nothing_to_learn_from(spark):
    kind = "doc_id long, text string, lang string"
    one = langid.identify(spark, spark.createDataFrame([(1, "text", None), (2, "12", None)], kind))
    assert {r.lang_pred for r in one.collect()} == {"und"}
    kept = langid.accept(spark, spark.createDataFrame([(1, "text", None), (2, "12", None)], kind))
    assert [r.doc_id for r in kept.collect()] == [1]
    assert langid.identify(spark, spark.createDataFrame([], kind)).count() == 0


# ---- mixing

def test_mixing_matches_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM {view('documents')}")
    cursor = db.execute(catalog.ORACLES["op9_poisson_mix"])
    names = [c[0] for c in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    rows = catalog.op9_poisson_mix(spark, FOLDER).select(*names)
    assert sorted(str(tuple(r)) for r in rows.collect()) == want


def test_poisson_counts(spark):
    draws = spark.range(20_000).withColumn("u", mixing.uniform(F.lit("s"), F.col("id").cast("string")))
    for mean in (0.3, 2.0, 9.5, 900.0):
        steps = draws.limit(1).select(mixing.poisson_steps(F.lit(mean)).alias("s")).first().s
        counts = np.searchsorted(np.array(steps), [r.u for r in draws.select("u").collect()], "right")
        assert abs(counts.mean() - mean) < 5 * np.sqrt(mean / 20_000)
        assert abs(counts.var() / mean - 1) < 0.06


def test_volumes_follow_the_weights(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"),
        F.when(F.col("id") < 4500, "big").when(F.col("id") < 5900, "mid").otherwise("none").alias("source"))
    weights = spark.createDataFrame([("big", 1.0), ("mid", 1.0), ("mid", 1.0), ("far", 5.0)],
                                    "source string, weight double")
    got = {r.source: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    assert set(got) == {"big", "mid"} and abs(got["mid"] / got["big"] - 2) < 0.2
    assert abs(sum(got.values()) - 6000) < 400


@pytest.mark.parametrize("limit", [mixing.BROADCAST_SOURCES, 0])
def test_mixing_of_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    docs = spark.createDataFrame(
        [(k, None if k % 3 else "text", None if k % 2 else "s", 1) for k in range(60)]
        + [(7, "again", "s", 1)] * 3 + [(None, "no id", "s", 1)] * 2, "doc_id long, text string, source string, copy int")
    first = sorted(map(str, mixing.mix(docs, epochs=3.0).collect()))
    assert first == sorted(map(str, mixing.mix(docs, epochs=3.0).collect()))
    assert any("source=None" in r for r in first)
    empty = mixing.mix(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "source", "rate", "copy",
                                                    "shuffle_key"]


def test_parts_are_shuffled(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                                    F.lit("s").alias("source"))
    parts = (mixing.mix(docs).withColumn("part", F.spark_partition_id()).collect())
    by = {}
    for r in parts:
        by.setdefault(r.part, []).append(r)
    for rows in by.values():
        assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)


# ---- URL filter

def slow_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in catalog.RULES if (host == r.host or host.endswith("." + r.host))
            and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best


ODD_URLS = [None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.ORG/es/1", "a://b://c/d",
            "http://example.org?x=/es/", "http://org/", "http://notorg/", "http://x.com/fr/#y",
            "http://É.COM/de/a?b", "http://a.org", "http://a\nb.org/x\ny", "http://example.org/en/1",
            "http://u@example.org:80/es/", "http://x.org/" + "y" * 50_000]


def test_urls(spark):
    given = duckdb.execute(f"SELECT page_id, url FROM {view('pages')}").fetchall()
    rows = {r.page_id: r for r in catalog.op6_url_filter(spark, FOLDER).collect()}
    odd = spark.createDataFrame(list(enumerate(ODD_URLS)) + [(0, None)],
                                "page_id int, url string").withColumn("rule", F.lit("clash"))
    odd_rows = urlfilter.judge(odd, catalog.RULES).collect()
    assert len(odd_rows) == len(ODD_URLS) + 1
    for url, r in [(u, rows[i]) for i, u in given] + [(ODD_URLS[r.page_id], r) for r in odd_rows]:
        host, path, best = slow_url(url)
        assert (r.host, r.path, r.rule) == (host, path, best and best.name)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")


def test_learned_verdicts(spark):
    labelled = spark.createDataFrame(
        [(f"http://site{k}.net/{'ads' if k % 2 else 'news'}/{k}", "block" if k % 2 else "allow")
         for k in range(60)], "url string, verdict string")
    pages = spark.createDataFrame([(k, f"https://other{k}.net/{'ads' if k % 2 else 'news'}/x{k}")
                                   for k in range(40)], "page_id int, url string")
    rows = urlfilter.judge(pages, (), labelled).collect()
    assert np.mean([(r.verdict == "block") == bool(r.page_id % 2) for r in rows]) > 0.95
    (one,) = {r.verdict for r in urlfilter.judge(pages, (), labelled.filter("verdict = 'block'")).collect()}
    assert one == "block"
    assert {r.verdict for r in urlfilter.judge(pages, (), labelled.limit(0)).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), catalog.RULES).count() == 0


def test_url_filter_runs_in_the_jvm(spark):
    for name in ("op5_one_permutation", "op6_url_filter", "op9_poisson_mix"):
        plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow|ArrowEval", plan)


# ---- chat

CHAT = "conv_id long, turn long, role string, text string"
CONTROLS = ["<|turn|>", "<|body|>", "<\\|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>",
            "<</SYS>>", "<\\\\/s>", "[\\INST]", "<", "[", "\\", "<|", "|>", "x"]


def test_escapes_are_reversible():
    rng = np.random.default_rng(6)
    for _ in range(3000):
        text = "".join(rng.choice(CONTROLS, rng.integers(0, 7)))
        written = chat.escape(text)
        assert chat.unescape(written) == text
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", written)
        assert chat.SHAPE.fullmatch("".join(chat.template(text, text))).groups() == (written, written)


def slow_digests(rows):
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                                              r[2] or "", r[3] or "")):
        talks.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest(),
                     sum(len("".join(chat.template(*t))) for t in turns))
    return out


def digests_of(rows):
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_conversations(spark):
    rows = duckdb.execute(f"SELECT conv_id, turn, role, text FROM {view('conversations')}").fetchall()
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert digests_of(catalog.op8_chat_tree(spark, FOLDER).collect()) == slow_digests(rows)


def branching(n=40):
    rng = np.random.default_rng(9)
    rows = []
    for conv in range(n):
        for turn in range(rng.integers(1, 7)):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant",
                         f"é say {rng.integers(0, 2)} <|end|>"))
    return rows + [(None, 0, None, None), (None, 0, "assistant", None), (100, 5, "user", "x" * 40_000),
                   (100, 2, "assistant", "</s>")]


def test_tree(spark):
    rows = branching()
    frame = spark.createDataFrame(rows, CHAT).repartition(5).withColumn("node", F.lit("clash"))
    tree, index = chat.prefix_tree(frame, catalog.RANKS, catalog.PATTERN)
    tree = tree.cache()
    back = chat.read_back(tree, index, catalog.RANKS, catalog.PATTERN)
    assert digests_of(back.collect()) == slow_digests(rows)

    nodes = {bytes(r.node): r for r in tree.collect()}
    paths = {tuple(bytes(n) for n in r.nodes) for r in index.collect()}
    assert set(nodes) == {n for p in paths for n in p}              # all, and each once
    ordered = sorted(nodes.values(), key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *[r.end for r in ordered][:-1]]    # one stream
    open_nodes = []
    for r in ordered:                                               # depth-first
        open_nodes = open_nodes[:r.depth] + [r]
        assert len(open_nodes) == r.depth + 1
        assert [r.parent and bytes(r.parent)] == ([bytes(open_nodes[-2].node)] if r.depth else [None])
        above = open_nodes[:-1]
        assert r.position == sum(a.end - a.start for a in above)
        covered = {x for i in r.ancestors for x in range(i.start, i.end)}
        assert covered == {x for a in above for x in range(a.start, a.end)}
        assert r.end - r.start == len(r.token_ids) // 4
    assert len({bytes(r.node) for r in ordered}) < len(rows)        # something was shared


def test_order_over_many_parts(spark):
    """The stream is one, whichever parts the paths fall into."""
    tree, _ = chat.prefix_tree(spark.createDataFrame(branching(200), CHAT), catalog.RANKS, catalog.PATTERN)
    rows = sorted(tree.select("start", "end", "position", "depth").collect())
    assert [r.start for r in rows] == [0, *[r.end for r in rows][:-1]]


def test_no_conversations(spark):
    tree, index = chat.prefix_tree(spark.createDataFrame([], CHAT), catalog.RANKS, catalog.PATTERN)
    assert tree.count() == index.count() == 0
    assert chat.read_back(tree, index, catalog.RANKS, catalog.PATTERN).count() == 0


# ---- pipeline

def kept_rows(docs):
    """Brute force: ids of the first document of each group of five-word sets alike by 0.8 or more."""
    sets = []
    for _, text in docs:
        words = (text or "").lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    first = {}
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    for n, (i, _) in enumerate(docs):
        first[root(n)] = min(i, first.get(root(n), i))
    return sorted(first.values())


def test_pipeline(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    for r in rows:
        ids = np.frombuffer(r.token_ids, "<u4")
        assert CODER.decode(r.token_ids).decode() == docs[r.doc_id].text
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(r.token_ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].text.encode()).hexdigest()
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    accepted = corpus_pipeline.language_id(spark, frame, FOLDER).collect()
    single = kept_rows([(r.doc_id, r.text) for r in accepted])
    mixed = mixing.mix(frame.filter(F.col("doc_id").isin(single))).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in mixed)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 4
    accepted = corpus_pipeline.language_id(spark, docs, FOLDER)
    assert accepted.columns == docs.columns and accepted.count() >= docs.count() - 2
    single = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    assert single.columns == docs.columns
    want = kept_rows([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in single.collect()) == want
    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert mixed.columns == docs.columns
    want = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert sorted(map(tuple, want)) == sorted(map(tuple, mixed.groupBy("doc_id").count().collect()))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


CLASHES = ["_found", "_rate", "_steps", "_draw", "_count", "_source", "_salt", "_features", "_chance",
           "_raw", "_blocked", "_grams", "_row", "_file", "_at", "_key", "_hash", "node", "run",
           "section", "a.dot", "row", "url", "place", "lead", "_text", "c0", "fp", "size"]


@pytest.mark.parametrize("operator", [
    lambda s, d: langid.identify(s, d), lambda s, d: langid.accept(s, d, least=0.0),
    lambda s, d: mixing.mix(d), lambda s, d: urlfilter.judge(d, catalog.RULES, url="link"),
    lambda s, d: copies.deduplicate(d)], ids=["identify", "accept", "mix", "judge", "copies"])
def test_columns_of_any_name_stay(spark, operator):
    """Names that the operators use inside, and one with a dot, go through with their values."""
    rows = [(k, f"word{k} and some more words of text number {k}", "en" if k % 2 else "fr", "s",
             f"http://h{k}.org/p", *[f"{c}-{k}" for c in CLASHES]) for k in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "link", *CLASHES])
    found = operator(spark, docs)
    assert found.columns[:len(docs.columns)] == docs.columns
    got = {r["doc_id"]: r for r in found.collect()}
    assert got and all(r[c] == f"{c}-{k}" for k, r in got.items() for c in CLASHES)


def test_no_language_is_lost(spark):
    """One row many times over is one row of the sample; its language is learned all the same."""
    english = [(k, f"the cat and the dog number {k} are here with all their friends", "en")
               for k in range(900)]
    german = [(5000, "der hund und die katze sind mit allen ihren freunden hier", "de")] * 2000
    docs = spark.createDataFrame(english + german, "doc_id long, text string, lang string")
    docs = docs.withColumn("doc_id", F.col("doc_id") * 3)
    lessons = langid.sample(docs, "doc_id", "text", "lang")
    assert {lang for _, lang in lessons} == {"en", "de"}
    assert sum(lang == "de" for _, lang in lessons) == 1
    network = langid.train(lessons)
    assert network.languages[network.pooled([german[0][1].encode()])[0].argmax()] == "de"


def test_labels_on_held_out_rows_only(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 3 == 1]
    docs = spark.createDataFrame([(k, f"some text {k}", "en") for k in ids] + [(ids[0], "123", None)],
                                 "doc_id long, text string, lang string")
    assert langid.accept(spark, docs).count() == len(ids)


def test_windows_cover_every_byte_once():
    texts = [b"a" * 200, b"", b"xyz", bytes(range(130))]
    codes, owner = langid.windows(texts)
    own = langid.labelled(codes)
    for k, text in enumerate(texts):
        mine = np.flatnonzero(owner == k)
        assert bytes(codes[:, w][p] for w in mine for p in np.flatnonzero(own[:, w])) == text
    # A byte in the middle has its neighbours of the windows beside it as context.
    assert codes[:langid.CONTEXT, 1].tolist() == [97] * langid.CONTEXT


def test_url_verdicts_of_held_out_pages(spark):
    """Pages that rules decide, in two halves, each judged by a model of the other. sf0.1, since 39
    lessons of sf0.01 are too few to say anything (recall of "block" 0.4 and 0.6 by half there)."""
    pages = catalog.table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    ruled = urlfilter.judge(pages, catalog.RULES).filter("rule IS NOT NULL")
    seen = []
    for k in (0, 1):
        half = F.pmod(F.xxhash64("host", "path"), F.lit(2)) == k
        lessons = ruled.filter(half).select("url", "verdict")
        asked = ruled.filter(~half).select("url", F.col("verdict").alias("true"))
        seen += [(r["true"], r["verdict"]) for r in urlfilter.judge(asked, (), lessons).collect()]
    blocked = [found for true, found in seen if true == "block"]
    assert sum(true == found for true, found in seen) / len(seen) > 0.9         # measured: 0.940
    assert blocked.count("block") / len(blocked) > 0.8                          # measured: 0.840


def test_one_frequent_url_is_one_lesson(spark):
    rows = [("h.org", "/same", "allow")] * 6000 + [("bad.com", f"/x{k}", "block") for k in range(3)]
    model = urlfilter.learn(spark.createDataFrame(rows, "host string, path string, verdict string"))
    assert not isinstance(model, str)


def test_rows_of_one_id_are_dealt_over_partitions(spark):
    """They have one shuffle key; rows so few would share a partition by coalescing alone."""
    docs = spark.createDataFrame([(1, f"text {k}", "s") for k in range(400)],
                                 "doc_id long, text string, source string")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        mixed = mixing.mix(docs, epochs=9.0).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(setting, before)
    assert mixed and len(mixed) % 400 == 0
    assert len({r.p for r in mixed}) > 1 and len({r.shuffle_key for r in mixed}) == len(mixed) // 400
