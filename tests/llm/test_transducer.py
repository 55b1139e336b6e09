"""The streaming BPE transducer, held against the tokenizers library."""
import hashlib
import os
import random

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import catalog, transducer

FOLDER = "/root/testdata/sf0.001"
CODER = transducer.load(catalog.WORD_TOKENIZER)
LIBRARY = Tokenizer.from_file(catalog.WORD_TOKENIZER)
SIGNS = [*"aabcdeghilnorsst", *"AZ09'!_<|>. \n\t\x0b\x1c\x85\xa0", "é", "É", "́", "̧",
         "ß", "İ", "Σ", "가", "ᄀ", "ᅡ", "ᆨ", "漢", "の", "が", "٣", "½", "😀",
         "‍", "'s", "'re", "'LL", "ก", "า", "<|endoftext|>", "<|startoftext|>", "tion", "the"]
TEXTS = st.lists(st.sampled_from(SIGNS) | st.characters(codec="utf-8"), max_size=80).map("".join)


def ids_of(parts):
    return np.frombuffer(b"".join(CODER.encode(parts)), "<u4").tolist()


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(TEXTS, st.integers(1, 20), st.sampled_from([1, 2, 3, 40]), st.sampled_from([1, 6, 256]))
def test_parts_encode_as_the_whole_text(text, step, part, word):
    before = transducer.PART, transducer.WORD
    transducer.PART, transducer.WORD = part, word
    try:
        assert ids_of([text[i:i + step] for i in range(0, len(text), step)]) == library_ids(text)
        assert ids_of([text]) == library_ids(text)
    finally:
        transducer.PART, transducer.WORD = before
    ids = np.array(library_ids(text), np.int64)
    assert CODER.decode_ids(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 300_000, "the" * 50_000 + "'s!!" + "漢字" * 30_000, "!?" * 90_000,
                                  "internationalization" * 9_000, "x" + "́" * 5_000 + "y",
                                  " " * 200_000 + "b" + "\xa0" * 200_000, "12" * 70_000])
def test_long_runs(monkeypatch, text):
    assert ids_of([text]) == library_ids(text)
    monkeypatch.setattr(transducer, "PART", 1000)
    run, most = transducer.Run(CODER), 0
    for at in range(0, len(text), 1000):
        list(run.feed(text[at:at + 1000], False))
        most = max(most, len(run.named) + len(run.tail))
    assert most <= 8 * 1000 + CODER.lookahead           # 8 bytes a character, names included
    assert np.frombuffer(CODER.encode_text(text), "<u4").tolist() == library_ids(text)


def test_ids_come_out_before_the_text_ends(monkeypatch):
    monkeypatch.setattr(transducer, "PART", 500)
    seen = []

    def parts():
        for n in range(40):
            yield "antidisestablishmentarian" * 20
            seen.append(sum(map(len, out)) // 4)
    out = []
    for packed in CODER.encode(parts()):
        out.append(packed)
    assert seen[0] == 0 < seen[10] < seen[20] < seen[39] < sum(map(len, out)) // 4


def slow_reach(merges, texts):
    """How far before its end the tokens of a prefix differ from the whole text's, at most."""
    rank = {pair: n for n, pair in enumerate(merges)}

    def tokens(text):
        parts = list(text)
        while pairs := [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in rank]:
            _, k = min(pairs)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return {sum(map(len, parts[:k])) for k in range(len(parts))}
    most = 0
    for text in texts:
        whole = tokens(text)
        for end in range(1, len(text)):
            gone = {p for p in whole ^ tokens(text[:end]) if p < end}
            most = max([most, *(end - p for p in gone)])
    return most


def test_lookahead_bounds_every_change():
    rng, seen = random.Random(2), 0
    for _ in range(60):
        merges, known = [], list("ab")
        while len(merges) < 12:
            pair = rng.choice(known), rng.choice(known)
            if "".join(pair) not in known and len("".join(pair)) < 9:
                merges.append(pair)
                known.append("".join(pair))
        bound = transducer.lookahead(merges)
        found = slow_reach(merges, ["".join(rng.choices("ab", k=40)) for _ in range(12)])
        assert found <= bound
        seen += found
    assert seen > 60                                    # bounds of changes that do occur
    assert transducer.lookahead([]) == 0 and 30 < CODER.lookahead < 400


def test_lookahead_needs_a_list_in_order():
    with pytest.raises(ValueError):
        transducer.lookahead([("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError):
        transducer.lookahead([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])


def test_bytes_become_text_when_characters_are_whole():
    machine = CODER.decode([np.array([])])
    assert "".join(machine) == ""
    coder = object.__new__(transducer.Coder)
    coder.names = {0: "é".encode()[:1], 1: "é".encode()[1:], 2: b"x"}
    steps = list(coder.decode([np.array([k]) for k in (2, 0, 1, 9, 0, 2)], b""))
    assert steps == ["x", "", "é", "", "\ufffdx", ""]


def test_streamed_documents(spark):
    documents = duckdb.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    rows = {r.doc_id: r for r in catalog.op12_bpe_stream(spark, FOLDER).collect()}
    assert len(rows) == len(documents)
    for i, text in documents:
        ids = library_ids(text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_streaming_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (3, "same text", "z"), (3, "same text", "z"), (None, "no id", None),
         (4, "word " * 30_000, "long")], "doc_id long, text string, token_ids string")
    rows = transducer.encode_documents(docs, catalog.WORD_TOKENIZER).collect()
    assert sorted(len(r.token_ids) for r in rows) == [0, 0, 2, 2, 2, 30_000]
    assert all(r.token_ids == library_ids(r.text or "") for r in rows)
    assert [r.decoded for r in rows if r.doc_id in (1, 2)] == ["", ""]
    empty = transducer.encode_documents(docs.limit(0), catalog.WORD_TOKENIZER)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "token_ids", "decoded"]
