"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads forwards and backwards and gives every byte a distribution over languages; a
document's is the mean over all its bytes. A text is read in windows that overlap: each labels WINDOW
bytes, and runs over CONTEXT more on either side, so every byte has been approached from both. It is
trained in numpy by backpropagation through time on a bounded sample of labelled rows. Arrays have
features first and windows last, so that the work of a step runs over long rows.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import (crc32_mod, free, give_back, named, quoted, ship_package, staged,
                                   text_or_empty)

WINDOW, CONTEXT = 64, 12
HIDDEN = 8
SLOPE = np.float32(0.2)         # gates are piecewise linear: 0.2 x + 0.5, between 0 and 1;
                                # a candidate is x / (1 + |x|)
PAD = 256                       # stands before and after a text
#: Bounds of the training sample: rows of a language, rows in all (but one of each language at least),
#: and pieces of each row, one from each equal part of the whole text.
PER_LANGUAGE, SAMPLE_ROWS, PIECES, SPARE = 256, 8192, 4, 4
PIECE = WINDOW + 2 * CONTEXT    # characters
UPDATES, BATCH, RATE, SEED = 160, 256, 0.02, 17
AT_ONCE = 2048                  # windows computed together
TEXTS_AT_ONCE = 500             # texts cut into windows together
UNKNOWN = "und"
ASCII_LETTER = re.compile("[A-Za-z]")


@dataclass
class Direction:
    """x: what each byte adds to the gates (rows: reset, update, candidate); u, b: the same of the
    state before."""
    x: np.ndarray
    u: np.ndarray
    b: np.ndarray

    @staticmethod
    def new(rng: np.random.Generator, hidden: int) -> Direction:
        scale = 1 / np.sqrt(hidden)
        return Direction(rng.normal(0, 0.3, (3 * hidden, PAD + 1)).astype(np.float32),
                         rng.uniform(-scale, scale, (3 * hidden, hidden)).astype(np.float32),
                         np.zeros((3 * hidden, 1), np.float32))

    def run(self, codes: np.ndarray, order: range) -> np.ndarray:
        """States (step, hidden, window), in the order of steps of `codes` (step, window). Slopes
        and offsets of the gates are worked into the weights, and buffers are used again."""
        n, width = self.u.shape[1], codes.shape[1]
        slope = np.array([SLOPE] * (2 * n) + [1] * n, np.float32)[:, None]
        shift = np.array([0.5] * (2 * n) + [0] * n, np.float32)[:, None]
        into, u, b = self.x * slope, self.u * slope, self.b * slope + shift
        states = np.empty((len(codes), n, width), np.float32)
        x, s = (np.empty((3 * n, width), np.float32) for _ in range(2))
        c, h = np.empty((n, width), np.float32), np.zeros((n, width), np.float32)
        r, z, gates = x[:n], x[n:2 * n], x[:2 * n]
        for t in order:
            np.take(into, codes[t], axis=1, out=x, mode="clip")
            np.matmul(u, h, out=s)
            s += b
            gates += s[:2 * n]
            np.clip(gates, 0, 1, out=gates)
            np.multiply(r, s[2 * n:], out=c)
            c += x[2 * n:]
            np.abs(c, out=x[:n])
            x[:n] += 1
            c /= x[:n]
            h -= c
            h *= z
            h += c
            states[t] = h
        return states

    def run_kept(self, codes: np.ndarray, order: range) -> tuple[np.ndarray, list]:
        """The same states, with what backpropagation needs of each step."""
        n = self.u.shape[1]
        states = np.empty((len(codes), n, codes.shape[1]), np.float32)
        h, kept = np.zeros(states.shape[1:], np.float32), []
        for t in order:
            x = np.take(self.x, codes[t], axis=1)
            s = self.u @ h + self.b
            gates = np.clip(0.5 + SLOPE * (x[:2 * n] + s[:2 * n]), 0, 1)
            r, z = gates[:n], gates[n:]
            c = x[2 * n:] + r * s[2 * n:]
            c /= 1 + np.abs(c)
            kept.append((h, z, r, s[2 * n:], c))
            h = c + z * (h - c)
            states[t] = h
        return states, kept

    def back(self, codes: np.ndarray, order: range, kept: list, d_states: np.ndarray) -> list:
        """Gradients of x, u and b."""
        n = self.u.shape[1]
        gx, gu, gb = (np.zeros_like(a) for a in (self.x, self.u, self.b))
        dh = np.zeros(d_states.shape[1:], np.float32)
        for t, (h, z, r, s, c) in zip(reversed(order), reversed(kept)):
            dh = dh + d_states[t]
            dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
            dz = dh * (h - c) * SLOPE * ((z > 0) & (z < 1))
            dr = dc * s * SLOPE * ((r > 0) & (r < 1))
            ds = np.concatenate([dr, dz, dc * r])
            dx = np.concatenate([dr, dz, dc])
            by_code = np.zeros((PAD + 1, 3 * n), np.float32)
            np.add.at(by_code, codes[t], dx.T)
            gx += by_code.T
            gu += ds @ h.T
            gb += ds.sum(axis=1, keepdims=True)
            dh = dh * z + self.u.T @ ds
        return [gx, gu, gb]


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    behind: Direction
    v: np.ndarray               # (language, both states)
    c: np.ndarray

    @staticmethod
    def new(languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        return Network(languages, Direction.new(rng, hidden), Direction.new(rng, hidden),
                       rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32),
                       np.zeros((len(languages), 1), np.float32))

    def parts(self) -> list[np.ndarray]:
        return [*(a for d in (self.ahead, self.behind) for a in (d.x, d.u, d.b)), self.v, self.c]

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at every position: (language, step, window)."""
        steps = range(len(codes))
        n = self.v.shape[1] // 2
        out = (np.tensordot(self.v[:, :n], self.ahead.run(codes, steps), (1, 1))
               + np.tensordot(self.v[:, n:], self.behind.run(codes, steps[::-1]), (1, 1))
               + self.c[:, :, None])
        np.exp(out - out.max(axis=0), out=out)
        return out / out.sum(axis=0)

    def gradients(self, codes: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over the positions that a window labels; wanted: a language
        number per window."""
        steps = range(len(codes))
        n = self.v.shape[1] // 2
        states, kept = self.ahead.run_kept(codes, steps)
        states_back, kept_back = self.behind.run_kept(codes, steps[::-1])
        both = np.concatenate([states, states_back], axis=1)
        out = np.einsum("lh,thb->ltb", self.v, both) + self.c[:, :, None]
        np.exp(out - out.max(axis=0), out=out)
        out /= out.sum(axis=0)
        out -= (np.arange(len(self.languages))[:, None] == wanted)[:, None, :]
        own = labelled(codes)
        out *= own / np.float32(max(1, own.sum()))
        d_both = np.einsum("lh,ltb->thb", self.v, out)
        return [*self.ahead.back(codes, steps, kept, d_both[:, :n]),
                *self.behind.back(codes, steps[::-1], kept_back, d_both[:, n:]),
                np.einsum("ltb,thb->lh", out, both), out.sum(axis=(1, 2))[:, None]]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(text, language): the mean of the labels over all bytes of each text."""
        sums = np.zeros((len(texts), len(self.languages)))
        codes, owner = windows(texts)
        for at in range(0, codes.shape[1], AT_ONCE):
            part = codes[:, at:at + AT_ONCE].astype(np.intp)
            own = (self.labels(part) * labelled(part)).sum(axis=1, dtype=np.float64)
            np.add.at(sums, owner[at:at + AT_ONCE], own.T)
        return sums / np.array([[max(1, len(t))] for t in texts])


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (step, window) of all bytes with their context, and the text of each window."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
    # Every text fills whole windows, and stands between two contexts of padding.
    starts = (np.cumsum(counts) - counts) * WINDOW + CONTEXT * (2 * np.arange(len(texts)) + 1)
    codes = np.full(counts.sum() * WINDOW + 2 * CONTEXT * len(texts), PAD, np.int16)
    for text, start in zip(texts, starts.tolist()):
        codes[start:start + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[owner] + WINDOW * nth - CONTEXT if len(owner) else np.zeros(0, np.int64)
    return codes[np.arange(WINDOW + 2 * CONTEXT)[:, None] + first], owner


def labelled(codes: np.ndarray) -> np.ndarray:
    """Which positions a window labels: those inside it that aren't padding."""
    own = codes != PAD
    own[:CONTEXT] = own[len(codes) - CONTEXT:] = False
    return own


def train(rows: list[tuple[str, str]], updates: int = UPDATES, seed: int = SEED) -> Network:
    """A network from (text, language) rows, by Adam; every language has the same share of each
    batch. The same rows in the same order give the same network."""
    languages = sorted({language for _, language in rows})
    network, rng = Network.new(languages, seed=seed), np.random.default_rng(seed)
    codes, owner = windows([text.encode() for text, _ in rows])
    number = np.array([languages.index(language) for _, language in rows], dtype=np.int64)[owner]
    members = [m for k in range(len(languages)) if len(m := np.flatnonzero(number == k))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parts()]
    for step in range(1, updates * (len(members) > 1) + 1):
        picked = np.concatenate([rng.choice(m, -(-BATCH // len(members))) for m in members])
        rate = RATE * min(1.0, 2 * (1 - step / (updates + 1)))
        for p, g, (m, v) in zip(network.parts(), network.gradients(codes[:, picked], number[picked]),
                                moments):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return network


def sample(rows: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, str]]:
    """(text, language) of at most PER_LANGUAGE rows of each language and SAMPLE_ROWS in all, but one
    of each at least: the first by a hash of key and text. Rows that repeat key and text are one row.
    Of each, PIECES pieces from all over its text, or the whole text if it is not longer.

    The hash first thins each language to about SPARE times as many rows, by how many different ones
    it has, so that no task ranks a large language."""
    text, key, lang = (F.col(quoted(c)) for c in (text, key, lang))
    usable = rows.filter(lang.isNotNull() & (F.length(text) > 0)).select(
        lang.cast("string").alias("lang"), F.xxhash64(key.cast("string"), text).alias("order"),
        text.alias("text"))
    different = staged(usable.select("lang", "order").distinct())
    sizes = staged(different.groupBy("lang").agg(F.count("*").alias("n")))
    each = max(1, min(PER_LANGUAGE, SAMPLE_ROWS // max(1, sizes.count())))
    thinned = different.join(sizes, "lang").filter(
        F.pmod(F.xxhash64("order"), F.lit(1 << 20)) < F.lit(float(SPARE * each)) / F.col("n") * (1 << 20))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = staged(thinned.withColumn("place", place).filter(F.col("place") <= each)
                    .select("lang", "order"))
    part = F.greatest(F.length("text") / PIECES, F.lit(float(PIECE)))
    slack = F.greatest(part - PIECE, F.lit(0.0)).cast("long") + 1
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.substring(
        F.col("text"), ((k * part).cast("long") + F.pmod(F.xxhash64("order", k), slack) + 1).cast("int"),
        F.lit(PIECE)))
    whole = F.length("text") <= PIECES * PIECE
    read = (usable.join(chosen, ["lang", "order"])
            .select("lang", "order", F.when(whole, F.array("text")).otherwise(pieces).alias("pieces"))
            .dropDuplicates(["lang", "order"]).orderBy("order", "lang"))
    return [(piece, r["lang"]) for r in read.collect() for piece in r["pieces"] if piece]


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network from the rows that are not held out and have text and a language."""
    ship_package(docs.sparkSession)
    return train(sample(docs.filter(~held_out(key)), key, text, lang))


def held_out(key: str) -> Column:
    """Whether crc32 of the key as text is 1 modulo 3; a null key is not held out."""
    return F.coalesce(crc32_mod(key, 3) == 1, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
             lang: str = "lang", network: Network | None = None) -> DataFrame:
    """All rows and columns, with `held_out` (crc32 of the key as text is 1 modulo 3),
    `lang_pred` and `score`, the mean probability of that language over the text's bytes.

    The network (by default one that `learn` makes of docs) learns from rows that are not held out
    and have a language; key and language are no input of a prediction, so equal texts have equal
    results. Texts of any length are read whole. A text that is null or has no letter gets "und" and
    score 0, as does every text if there is nothing to learn from; an empty table gives no rows. A
    null key is not held out. Ties go to the language that sorts first. Columns of the input with the
    names of new ones are replaced, all others stay.
    """
    network = network or learn(docs, key, text, lang)
    shared = spark.sparkContext.broadcast(network)      # a few thousand numbers
    (found,) = free(docs, "_found")

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def language_of(texts: pa.Array) -> pa.Array:
        own = shared.value
        given = texts.to_pylist()
        read = [k for k, t in enumerate(given) if own.languages and has_letter(t)]
        names, scores = [UNKNOWN] * len(given), np.zeros(len(given))
        for at in range(0, len(read), TEXTS_AT_ONCE):
            few = read[at:at + TEXTS_AT_ONCE]
            pooled = own.pooled([given[k].encode() for k in few])
            scores[few] = pooled.max(axis=1)
            for k, best in zip(few, pooled.argmax(axis=1).tolist()):
                names[k] = own.languages[best]
        give_back()
        return pa.StructArray.from_arrays([pa.array(names), pa.array(np.clip(scores, 0, 1))],
                                          ["lang_pred", "score"])
    return (docs.withColumn(found, language_of(text_or_empty(text)))
            .withColumn("held_out", held_out(key))
            .withColumn("lang_pred", F.col(f"{found}.lang_pred"))
            .withColumn("score", F.col(f"{found}.score")).drop(found))


def accept(spark: SparkSession, docs: DataFrame, least: float = 0.3, key: str = "doc_id",
           text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text is in one of the learned languages: not "und", and scored `least` or
    more. Columns stay as they are, whatever their names. If nothing was learned (no row that is not
    held out has text and a language), nothing can be judged; then the texts that have a letter stay."""
    network = learn(docs, key, text, lang)
    if not network.languages:
        return docs.filter(text_or_empty(text).rlike(r"\p{L}"))
    # The input is one column beside the text, so that its names cannot clash with the new ones.
    packed = docs.select(F.struct(*named(docs)).alias("row"), text_or_empty(text).alias("text"),
                         F.lit(None).cast("long").alias("doc_id"))
    found = identify(spark, packed, network=network)
    return (found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
            .select("row.*"))
