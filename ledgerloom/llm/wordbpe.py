"""The tokenizers library over many texts, with the ids of words kept between texts.

For a tokenizer that drops white space and splits letters, numbers and other signs from each other
(and 's, 't, 're, 've, 'm, 'll, 'd from what precedes), a text's ids are those of its units: a run
of letters and digits, the same after an apostrophe, or a run of other signs. Units repeat, so each
is encoded once per worker. Only texts in Latin script are taken apart so, where no version of
Unicode differs about the kinds of characters; of other texts the units are the words between white
space. Texts with special tokens are encoded whole.
"""
from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from ledgerloom.llm.bpe import WHITE

UNIT = re.compile(rf"'[^\W_]+|[^\W_]+|(?:[^\w{WHITE}]|_)+")
LATIN = re.compile("[\t-\r -~\xa0-įı-ɏ‐-‧€]*")
BETWEEN = re.compile("[^\t-\r ]+")
#: Units kept, after which the table is emptied.
KEPT = 800_000


def byte_names() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others by the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class WordBpe:
    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.names = byte_names()
        self.units: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, units: list[str]) -> None:
        """Letters in Latin script are one piece each, which goes to the merges at once; the rest
        takes the whole way, as words of one call."""
        letters = [u for u in units if u.isalpha() and LATIN.fullmatch(u)]
        merge = self.tokenizer.model.tokenize
        for u in letters:
            named = u if u.isascii() else u.lower().encode().decode("latin-1").translate(self.names)
            self.units[u] = b"".join([t.id.to_bytes(4, "little") for t in merge(named)])
        rest = [u for u in units if u not in self.units]
        if rest:
            found = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            cuts = (4 * np.searchsorted(np.array(found.word_ids, dtype=np.int64),
                                        np.arange(len(rest) + 1))).tolist()
            self.units.update((u, ids[a:b]) for u, a, b in zip(rest, cuts, cuts[1:]))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text, as the tokenizer gives them without special tokens."""
        if len(self.units) > KEPT:
            self.units.clear()
        split = []
        for text in texts:
            text = text or ""
            if "<|" in text:
                split.append(None)
                continue
            # A-Z only, which the tokenizer does too.
            plain = text.isascii()
            lowered = text.lower() if plain else text.encode().lower().decode()
            split.append((UNIT if plain or LATIN.fullmatch(lowered) else BETWEEN).findall(lowered))
        unknown = set().union(*filter(None, split)).difference(self.units)
        if unknown:
            self._learn(sorted(unknown))
        known = self.units
        return [self.whole(text) if units is None else b"".join([known[u] for u in units])
                for text, units in zip(texts, split)]


@lru_cache(maxsize=2)
def load(file: str) -> WordBpe:
    """One tokenizer per Python worker; the file must be readable on every executor."""
    return WordBpe(file)
