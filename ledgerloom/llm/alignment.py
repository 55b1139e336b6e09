"""Alignment of two tokenizers over a corpus: how often each pair of token ids ends together.

Tokens of A (byte-level BPE) and B (pieces with byte fallback) cover the same bytes. Where both end,
the tokens that end there are linked. Counting the pairs is external: a task writes pair-document
records into runs, sorted with B's ids first and cut by radix of B's id, compressed with zstd. Each
run has an index, its pairs with their numbers. The indexes of a section are merged by a heap, so
many at a time until one is left, which counts every pair; in that order all pairs of a B id
stand together, so the merge gives the highest count as it passes. The counts then go back to the
runs, section by section, and each run sums what its pairs contribute to its documents.

A pair is one record in a run's index, however many documents have it, so a frequent id is no more
work than a rare one; runs and sections, not ids, are dealt over tasks.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import runs
from ledgerloom.llm.common import ship_package, staged, text_or_empty

SECTIONS = 256                  # radix: B's id modulo this
RUN_RECORDS = 1 << 20           # pair-document records of a run, but for one document's own
ANSWERED = 16                   # indexes of a section that share one copy of its counts
#: Characters of a unit up to which its tokens are kept, and how many units are.
UNIT, KEPT = 64, 400_000
A_IDS = 1 << 16                 # A's ids are less

DIGEST = ("n_a", "n_b", "n_groups", "n_links")


# ---- tokens of both

class Aligner:
    """Both tokenizers, and the tokens of text units kept between texts. A unit starts at white
    space that follows something else and that no piece of B holds: there, tokens of both end."""

    def __init__(self, a_file: str, b_file: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_file)
        byte_of = {c: b for b, c in byte_names().items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in byte_of for c in token):
                self.a_bytes[i] = bytes(byte_of[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.a_bytes) > A_IDS or len(pieces) > 1 << 15:
            raise ValueError("ids of A need 16 bits, ids of B 15")
        own = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        cut = [c for c in " \n\t" if not any(c in p for p in own)]
        if any("▁" in p.lstrip("▁") for p in own):
            cut.remove(" ")
        #: A unit starts before one of these; nothing is cut if there are none.
        self.starts = re.compile(rf"(?<=\S)(?=[{''.join(cut)}])" if cut else r"(?!)")
        self.units: dict[str, tuple | None] = {}

    def _learn(self, units: list[str]) -> None:
        """Of each unit: groups as text, packed links (B's id first), and numbers of tokens and
        groups; None if the bytes of either tokenizer differ from the unit's."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # B adds a space: it stands for the unit's first one, or is left out again.
        spaced = [u[0] == " " for u in units]
        b = self.b.encode([u[1:] if s else u for u, s in zip(units, spaced)], num_threads=1)
        for unit, one, two, s in zip(units, a, b, spaced):
            if unit == " ":                             # to nothing B adds no space
                two = [self.b.piece_to_id("▁")]
            self.units[unit] = self._aligned(unit, one, two if s else two[1:])

    def _aligned(self, unit: str, a: list[int], b: list[int]) -> tuple | None:
        a_bytes, b_bytes, plain = self.a_bytes, self.b_bytes, unit.encode()
        if (b"".join([a_bytes[i] for i in a]) != plain
                or b"".join([b_bytes[i] for i in b]) != plain):
            return None
        groups, links, ours, theirs, k, at, end = [], [], [], [], 0, 0, 0
        for i in a:
            at += len(a_bytes[i])
            ours.append(str(i))
            while end < at and k < len(b):
                end += len(b_bytes[b[k]])
                theirs.append(str(b[k]))
                k += 1
            if at == end:
                groups.append(",".join(ours) + "|" + ",".join(theirs))
                links.append(b[k - 1] * A_IDS + i)
                ours, theirs = [], []
        return ";".join(groups), np.array(links, "<u4").tobytes(), len(a), len(b), len(groups)

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, digest of the groups, links) of each text."""
        if len(self.units) > KEPT:
            self.units.clear()
        split = [self.starts.split(" " + t) if t else [] for t in texts]
        known = self.units
        new = {u for units in split for u in units if u not in known}
        if new:
            self._learn(list(new))
        out = []
        for units in split:
            found = [known[u] for u in units]
            if not found or None in found:
                out.append((0, 0, 0, "", b""))
            else:
                out.append((sum([f[2] for f in found]), sum([f[3] for f in found]),
                            sum([f[4] for f in found]),
                            hashlib.sha256(";".join([f[0] for f in found]).encode()).hexdigest(),
                            b"".join([f[1] for f in found])))
        for unit in [u for u in new if len(u) > UNIT]:
            del known[unit]
        return out


def byte_names() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others by the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def load(a_file: str, b_file: str) -> Aligner:
    """One per Python worker; the files must be readable on every executor."""
    return Aligner(a_file, b_file)


# ---- runs

RUN = "run long, section int, index binary, records binary, docs binary"


class _Run:
    """Documents of one run, and their pair-document records."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.docs, self.links, self.sizes, self.n = schema, [], [], [], 0

    def add(self, keys: pa.Array, found: list[tuple]) -> None:
        sizes = [len(f[4]) // 4 for f in found]
        self.docs.append(pa.RecordBatch.from_arrays(
            [keys, *(pa.array([f[k] for f in found], pa.int64()) for k in range(3)),
             pa.array(sizes, pa.int64()), pa.array([f[3] for f in found], pa.string())],
            schema=self.schema))
        self.links += [np.frombuffer(f[4], "<u4") for f in found]
        self.sizes += sizes
        self.n += sum(sizes)

    def rows(self, number: int) -> pa.RecordBatch:
        """One row for the documents and their records, and one for each section of the index."""
        link = np.concatenate([*self.links, np.zeros(0, "<u4")]).astype(np.int64)
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # Radix first, then B's id, A's id, document.
        record = (link // A_IDS % SECTIONS << 31 | link) << 24 | doc
        record, times = np.unique(record, return_counts=True)
        pair = record >> 24
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        sums = np.add.reduceat(times, starts) if len(starts) else times
        pairs = pair[starts]
        lengths = runs.squeeze([(np.diff(starts, append=len(pair)).astype(np.int32),)])
        records = runs.squeeze([((record & (1 << 24) - 1).astype(np.int32), times.astype(np.int32))])
        rows = [(number, None, lengths, records, runs.packed_table(self.docs, self.schema))]
        ends = np.searchsorted(pairs >> 31, np.arange(SECTIONS + 1))
        rows += [(number, s, runs.pack_index(runs.in_blocks(pairs[a:b] & (1 << 31) - 1, sums[a:b])),
                  None, None) for s, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          ["run", "section", "index", "records", "docs"])


def _runs(batches: Iterator[pa.RecordBatch], a_file: str, b_file: str) -> Iterator[pa.RecordBatch]:
    aligner, number, run = load(a_file, b_file), TaskContext.get().partitionId() << 32, None
    for batch in batches:
        keys, texts = batch.columns
        schema = pa.schema([pa.field("key", keys.type), *(pa.field(n, pa.int64()) for n in DIGEST),
                            pa.field("groups_sha256", pa.string())])
        for at in range(0, len(batch), 256):
            run = run or _Run(schema)
            run.add(keys[at:at + 256], aligner.align(texts[at:at + 256].to_pylist()))
            if run.n >= RUN_RECORDS or len(run.sizes) >= RUN_RECORDS:
                yield run.rows(number)
                number, run = number + 1, None
    if run:
        yield run.rows(number)


# ---- counts

def with_best(blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Adds whether a pair's count is its B id's highest. The pairs of the last B id of a block wait
    for the next, as it may have more of them."""
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def judged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        starts = np.flatnonzero(np.diff(pairs // A_IDS, prepend=-1))
        most = np.repeat(np.maximum.reduceat(counts, starts), np.diff(starts, append=len(pairs)))
        return pairs, counts, counts == most
    for block in blocks:
        pairs, counts = (np.concatenate(c) for c in zip(held, block))
        done = int(np.searchsorted(pairs, pairs[-1] // A_IDS * A_IDS))
        held = pairs[done:], counts[done:]
        if done:
            yield judged(pairs[:done], counts[:done])
    if len(held[0]):
        yield judged(*held)


def _summed(run: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a run with what its pairs contribute."""
    docs = pa.ipc.open_stream(run.column("docs")[0].as_py()).read_all()
    n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    if len(answers):
        (lengths,), (doc, times) = (runs.unsqueeze(run.column(c)[0].as_py())
                                    for c in ("index", "records"))
        counts, best = (np.repeat(c, lengths) for c in runs.answers_of(answers))
        np.add.at(n_best, doc, best * times)
        np.add.at(count_sum, doc, counts * times)
    for name, values in (("n_best", n_best), ("count_sum", count_sum)):
        docs = docs.append_column(name, pa.array(values))
    return docs.combine_chunks()


def align(docs: DataFrame, a_file: str, b_file: str, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: the key, numbers of A's and B's tokens, of groups and links,
    `groups_sha256`, n_best (links whose pair's count is the highest of its B id, ties included) and
    count_sum (the counts of all its links).

    A text is a space and the document's; specials in it are plain text. Null and empty texts, and
    those that the tokens of A or B don't spell byte by byte, have no tokens: zeros and an empty
    digest. Keys may be null or repeated: rows are told apart by their place, so each counts. Other
    columns of the input aren't looked at, whatever their names. An empty table gives no rows. Texts
    of any length: a text is held whole, with its own tokens.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    made = staged(docs.select(F.col(key).alias("key"), text_or_empty(text))
                  .mapInArrow(lambda batches: _runs(batches, a_file, b_file), RUN))
    whole = made.filter("section IS NULL").drop("section")
    indexes = made.filter("section IS NOT NULL").select("run", "section", "index")
    n = whole.select("run").count()
    counts = staged(runs.counted(indexes, n, with_best))
    answers = runs.answered(indexes, counts, n, ANSWERED)
    names = [*DIGEST, "groups_sha256", "n_best", "count_sum"]
    summed = whole.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(
        _summed, f"key {kind}, " + ", ".join(
            f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names))
    return summed.withColumnRenamed("key", key)
