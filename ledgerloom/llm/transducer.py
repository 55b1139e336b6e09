"""BPE as a streaming transducer: text goes in by parts, ids come out as soon as no later text can
change them, and memory stays constant; ids go in by parts and text comes out the same way.

Encoding is a chain of machines, each of which keeps back what the next part may still change:

* special tokens: an end of the text that may be the start of one;
* white space: the word that is not over yet;
* NFC and lower case: the characters after the last one at which a text may be cut;
* the split into letters, digits and other signs: the piece that is not over yet;
* merges: so many bytes as `lookahead` computes from the merge list.

A word that ends within a part passes through the same machines at once, and its ids are kept for
the next time it occurs. One thing is held whole: a run of combining marks after one character,
which NFC puts into order.

The lookahead. Merges apply by rank. Let two texts be alike up to some byte, and follow the leftmost
place where the merges done so far differ. It moves left only when a rule r joins x and y in one
of them, and the place that differed before lies within y or at its end. If it lies inside, it was
joined by a rule in y's own derivation; if at the end, by a rule of lower rank than r whose left part
ends y, and which came before that part grew. So the farthest that a difference can travel left is
the longest path over rules of falling rank, which `lookahead` finds in one pass over the list.
"""
from __future__ import annotations

import codecs
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, text_or_empty

PART = 1 << 16                  # characters of a text that are looked at together
WORD = 256                      # characters of a word up to which its ids are kept
KEPT = 800_000                  # words kept, after which the table is emptied
SPACE = re.compile("[\t-\r ]+")
# What lower-case ASCII text without white space is split into.
ASCII_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
LETTER, SIGN = "a", "!"


def lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Bytes after a token's end that can still change it, at most. Symbols are one character for a
    byte, the suffix apart. Every merge must join what bytes or earlier merges give, and no two may
    give the same."""
    made: dict[str, int] = {}
    inside: dict[str, int] = {}                     # by token: how far its own joins reach
    by_left: dict[str, tuple[list[int], list[int]]] = {}
    most = 0

    def width(token: str) -> int:
        return len(token.removesuffix(suffix)) if suffix else len(token)
    for rank, (x, y) in enumerate(merges):
        beyond, ending, before = 0, y, rank
        while True:                                 # what ends y, from y to its last byte
            ranks, reaches = by_left.get(ending, ((), ()))
            if earlier := bisect_left(ranks, before):
                beyond = max(beyond, reaches[earlier - 1])
            if ending not in made:
                break
            before = made[ending]
            ending = merges[before][1]
        reach = max(width(y) + beyond, inside.get(y, 0))
        if x + y in made:
            raise ValueError(f"two merges give {x + y!r}")
        made[x + y] = rank
        inside[x + y] = max(inside.get(x, 0), width(x) + reach, width(x) + inside.get(y, 0))
        ranks, reaches = by_left.setdefault(x, ([], []))
        ranks.append(rank)
        reaches.append(max(reach, reaches[-1] if reaches else 0))
        most = max(most, reach)
    for rank, pair in enumerate(merges):
        if any(made.get(part, -1) >= rank for part in pair):
            raise ValueError(f"merge {rank} uses what a later one gives")
    return most


def cut_place(text: str) -> int:
    """The last place at which NFC of both parts is the parts of NFC; 0 if there is none."""
    for at in range(len(text) - 1, 0, -1):
        c = text[at]
        if c.isascii() or ((kind := unicodedata.category(c))[0] in "LNPSZC" and kind != "Cn"
                           # Letters that compose with what precedes them.
                           and not ("ᅠ" <= c <= "ᇿ" or "ힰ" <= c <= "퟿"
                                    or "\U00016d40" <= c <= "\U00016d7f")):
            return at
    return 0


class Run:
    """The machine of one word: `feed` takes parts of it and gives the ids that are stable."""

    def __init__(self, coder: Coder):
        self.coder = coder
        self.raw = ""               # not normalised yet
        self.tail = ""              # normalised, and not split yet
        self.kind = ""              # a character of the open piece's kind
        self.named = ""             # bytes of the open piece whose tokens aren't stable yet

    def _pieces(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.coder.splitter.pre_tokenize_str(text)

    def _tokens(self, last: bool) -> Iterator[int]:
        if not self.named:
            return
        end = len(self.named) if last else len(self.named) - self.coder.lookahead - 1
        at = done = 0
        for token in self.coder.model.tokenize(self.named):
            at += len(token.value.removesuffix(self.coder.suffix))
            if at > end:
                break
            done = at
            yield token.id
        self.named = self.named[done:]

    def _kind_of(self, piece: str, char: str) -> str:
        """What the piece may go on with: letters, signs, or nothing."""
        if piece[0] == "'" and len(piece) > 1 and self._is(LETTER, char):
            return ""                                   # an ending such as 's is over
        return next((k for k in (LETTER, SIGN) if self._is(k, char)), "")

    def _is(self, kind: str, char: str) -> bool:
        return len(found := self._pieces(kind + char)) == 1 and found[0][1][1] == 2

    def feed(self, part: str, last: bool) -> Iterator[int]:
        self.raw += part
        cut = len(self.raw) if last else cut_place(self.raw)
        if cut:
            self.tail += self.coder.normalizer.normalize_str(self.raw[:cut])
            self.raw = self.raw[cut:]
        text = self.kind + self.tail
        pieces = self._pieces(text) if self.tail else []
        if self.kind and pieces:
            # The first piece goes on with the open one, whose kind stands before it.
            named, (_, end) = pieces.pop(0)
            self.named += named[1:]
            if end < len(text):
                yield from self._tokens(True)
                self.kind = ""
        if pieces:
            held = len(text) if last else next(
                (start for _, (start, _) in pieces if start >= len(text) - 2 and text[start] == "'"),
                len(text))
            whole = [p for p in pieces if p[1][0] < held]
            for named, (start, end) in whole:
                yield from self._tokens(True)
                self.named = named
            self.tail = text[held:]
            if held < len(text):
                yield from self._tokens(True)
            elif not last and whole:
                _, (start, end) = whole[-1]
                self.kind = self._kind_of(text[start:end], text[end - 1]) if end == held else ""
                if not self.kind:
                    yield from self._tokens(True)
        else:
            self.tail = ""
        if last or len(self.named) > self.coder.lookahead + PART:
            yield from self._tokens(last)


class _Words(dict):
    """Packed ids of words, by the machine the first time."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():       # only case to normalise, bytes named as they are
            ids: list[int] = []
            for piece in ASCII_PIECE.findall(word.lower()):
                ids += [t.id for t in self.coder.model.tokenize(piece)]
        else:
            ids = list(Run(self.coder).feed(word, True))
        out = self[word] = np.array(ids, "<u4").tobytes()
        return out


class Coder:
    """An encoder and a decoder for a tokenizer file with word ends, NFC and lower case. The file's
    truncation and padding count for nothing."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as lines:
            parts = json.load(lines)
        added, model = parts["added_tokens"], parts["model"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens must be found in the text as it is")
        library = Tokenizer.from_file(file)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.model, self.suffix = library.model, model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.lookahead = lookahead(merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in added}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.longest = max(map(len, self.special), default=1)
        self.names = {i: t.encode() for t, i in (model["vocab"] | self.special).items()}
        self.words = _Words(self)

    # ---- text to ids

    def encode(self, parts: Iterable[str]) -> Iterator[bytes]:
        """Packed ids, little-endian unsigned 32-bit, of the text that the parts make together."""
        held, word, run = "", "", None
        if len(self.words) > KEPT:
            self.words.clear()
        for part, last in _marked_last(parts):
            text, held = held + part, ""
            if not last and (at := text.find("<", max(0, len(text) - self.longest + 1))) >= 0:
                text, held = text[:at], text[at:]
            for segment in self.marks.split(text) if "<" in text else (text,):
                special = self.special.get(segment)
                # A special token ends a word as white space does.
                first, *ended = ("", "") if special is not None else SPACE.split(segment)
                if run is None:
                    word += first
                    if len(word) > WORD and (not ended or len(word) > PART):
                        run, first, word = Run(self), word, ""
                if run is not None:
                    yield _packed(i for at in range(0, len(first), PART)
                                  for i in run.feed(first[at:at + PART], False))
                if ended:
                    yield self._closed(word, run)
                    yield b"".join([self.words[w] if len(w) <= WORD else self._closed(w, None)
                                    for w in ended[:-1]])
                    word, run = ended[-1], None
                if special is not None:
                    yield special.to_bytes(4, "little")
        yield self._closed(word, run)

    def _closed(self, word: str, run: Run | None) -> bytes:
        if run is not None:
            return _packed(run.feed("", True))
        if len(word) <= WORD:
            return self.words[word]
        run = Run(self)
        return _packed(i for at in range(0, len(word), PART)
                       for i in run.feed(word[at:at + PART], at + PART >= len(word)))

    def encode_text(self, text: str) -> bytes:
        return b"".join(self.encode(text[at:at + PART] for at in range(0, len(text) or 1, PART)))

    # ---- ids to text

    def decode(self, ids: Iterable[np.ndarray], between: bytes = b" ") -> Iterator[str]:
        """Text of the ids' tokens as the vocabulary writes them, `between` between two. Ids beyond
        the vocabulary are passed over. Bytes that aren't whole characters yet wait for the next."""
        machine, started = codecs.getincrementaldecoder("utf-8")("replace"), False
        for some in ids:
            known = [self.names[i] for i in some.tolist() if i in self.names]
            if known:
                yield machine.decode((between if started else b"") + between.join(known))
                started = True
        yield machine.decode(b"", True)

    def decode_ids(self, ids: np.ndarray) -> str:
        return "".join(self.decode(ids[at:at + PART] for at in range(0, len(ids), PART)))


def _packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, "<u4").tobytes()


def _marked_last(parts: Iterable[str]) -> Iterator[tuple[str, bool]]:
    held = None
    for part in parts:
        if held is not None:
            yield held, False
        held = part
    yield held or "", True


@lru_cache(maxsize=2)
def load(file: str) -> Coder:
    """One coder per Python worker; the file must be readable on every executor."""
    return Coder(file)


def encode(text: Column, file: str) -> Column:
    """Token ids of a text. Null: null. Empty: no ids."""
    @F.arrow_udf("array<int>")
    def bpe_stream(texts: pa.Array) -> pa.Array:
        coder = load(file)
        packed = [None if t is None else coder.encode_text(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *(len(p or b"") // 4 for p in packed)])
        ids = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), "<i4"))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids,
                                        mask=pa.array([p is None for p in packed]))
    return bpe_stream(text)


def decode(ids: Column, file: str) -> Column:
    """What the ids' tokens spell, with a space between two. Null: null."""
    @F.arrow_udf("string")
    def bpe_text(lists: pa.Array) -> pa.Array:
        coder, values = load(file), lists.values.to_numpy(zero_copy_only=False)
        ends = lists.offsets.to_pylist()
        return pa.array([coder.decode_ids(values[a:b]) if ok else None for ok, a, b
                         in zip(lists.is_valid().to_pylist(), ends, ends[1:])], pa.string())
    return bpe_text(ids)


def encode_documents(docs: DataFrame, file: str, text: str = "text", ids: str = "token_ids",
                     decoded: str = "decoded") -> DataFrame:
    """Every row with its token ids (array<int>), as the tokenizers library gives them without
    special tokens added, and the text that they spell, as its decode gives it.

    A null text counts as empty: no ids, an empty string. Texts of any length pass in parts. Columns
    of the input named as `ids` or `decoded` are replaced; all others, and repeated rows, stay; an
    empty table gives no rows. No shuffle: a task holds one Arrow batch.
    """
    ship_package(docs.sparkSession)
    return (docs.withColumn(ids, encode(text_or_empty(text), file))
            .withColumn(decoded, decode(F.col(f"`{ids}`"), file)))


def digests(ids: str = "token_ids", decoded: str = "decoded") -> dict:
    return {"n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256),
            "decoded_sha256": F.sha2(F.col(decoded), 256)}
