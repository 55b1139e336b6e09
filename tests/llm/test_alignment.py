"""Cross-tokenizer alignment, held against whole-text encodings and plain counting."""
import collections
import hashlib
import os
import random

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, catalog, runs

FOLDER = "/root/testdata/sf0.001"
A = Tokenizer.from_file(catalog.BYTE_TOKENIZER)
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=catalog.PIECE_TOKENIZER)
ALIGNER = alignment.load(catalog.BYTE_TOKENIZER, catalog.PIECE_TOKENIZER)
TEXTS = st.lists(st.sampled_from([*" \n\t\r\x0b\x1c\x85\xa0abcZ9'_-.!<>|▁", "  ", "é", "漢", "<s>",
                                  "<|endoftext|>", "<0x0A>", ";\r", "tion", "the", "ﬁ"])
                 | st.characters(codec="utf-8"), max_size=60).map("".join)


def slow(text):
    """Token ids, groups and links of one text, from whole encodings."""
    a, b = A.encode(" " + (text or ""), add_special_tokens=False).ids, B.encode(text or "")
    names = {c: n for n, c in alignment.byte_names().items()}
    a_bytes = [bytes(names[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(b, map(B.id_to_piece, b))]
    plain = (" " + (text or "")).encode()
    if not text or b"".join(a_bytes) != plain or b"".join(b_bytes) != plain:
        return [], [], "", []
    a_ends, b_ends = (np.cumsum([len(t) for t in ts]).tolist() for ts in (a_bytes, b_bytes))
    groups, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        x, y = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    links = [(b[b_ends.index(e)], a[a_ends.index(e)]) for e in sorted(set(a_ends) & set(b_ends))]
    return a, b, ";".join(groups), links


def slow_rows(documents):
    found = [slow(t) for _, t in documents]
    counts = collections.Counter(p for f in found for p in f[3])
    most = collections.defaultdict(int)
    for (b, _), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((i, len(a), len(b), groups.count("|"), len(links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "",
                    sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links))
                   for (i, _), (a, b, groups, links) in zip(documents, found)), key=str)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_units_align_as_the_whole_text(text):
    a, b, groups, links = slow(text)
    ((n_a, n_b, n_groups, digest, packed),) = ALIGNER.align([text])
    assert (n_a, n_b, n_groups) == (len(a), len(b), groups.count("|") if groups else 0)
    assert digest == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert np.frombuffer(packed, "<u4").tolist() == [x * alignment.A_IDS + y for x, y in links]


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_merge_counts_every_pair(monkeypatch, block):
    monkeypatch.setattr(runs, "BLOCK", block)
    rng, total, indexes = random.Random(4), collections.Counter(), []
    for _ in range(9):
        own = collections.Counter(rng.choices([b * alignment.A_IDS + a for b in range(5)
                                               for a in range(9)], k=rng.randrange(1, 60)))
        total += own
        pairs = sorted(own)
        indexes.append(runs.pack_index(runs.in_blocks(
            np.array(pairs), np.array([own[p] for p in pairs]))))
    blocks = list(alignment.with_best(runs.merged(indexes)))
    pairs, counts, best = (np.concatenate(c).tolist() for c in zip(*blocks))
    assert dict(zip(pairs, counts)) == total and pairs == sorted(total)
    for pair, flag in zip(pairs, best):
        top = max(n for p, n in total.items() if p // alignment.A_IDS == pair // alignment.A_IDS)
        assert flag == (total[pair] == top)
    assert list(runs.merged([])) == []


def test_alignment_of_the_documents(spark):
    documents = duckdb.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    rows = catalog.op11_token_alignment(spark, FOLDER)
    assert rows.columns == ["doc_id", *alignment.DIGEST, "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(tuple, rows.collect()), key=str) == slow_rows(documents)


@pytest.mark.parametrize("size", [{}, {"RUN_RECORDS": 40, "ANSWERED": 2}])
def test_alignment_of_odd_rows(spark, monkeypatch, size):
    """Small sizes: many runs, three levels of merging, several shares of each section. A word that
    a third of all tokens are is one record of a run's index."""
    for name, value in size.items():
        monkeypatch.setattr(alignment, name, value)
        monkeypatch.setattr(runs, "FAN_IN", 2)
        monkeypatch.setattr(runs, "BLOCK", 3)
    hot = [(k, "the the the " + w) for k, w in enumerate(["", "x\ny", "The  end", "thé"] * 12)]
    documents = [*hot, (7, "the the the x"), (None, "no id"), (None, "no id"), (100, None), (101, ""),
                 (102, " "), (103, "literal ▁ sign"), (104, "\x00\t<s></s><|endoftext|>"),
                 (105, "long " * 5_000), (106, "x" * 20_000)]
    frame = spark.createDataFrame([(*d, "clash") for d in documents], "doc_id long, text string, n_a string")
    got = sorted(map(tuple, alignment.align(frame.repartition(3), catalog.BYTE_TOKENIZER,
                                            catalog.PIECE_TOKENIZER).collect()), key=str)
    assert got == slow_rows(documents)
    assert alignment.align(frame.limit(0), catalog.BYTE_TOKENIZER, catalog.PIECE_TOKENIZER).count() == 0
