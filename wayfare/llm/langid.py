"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. For each bit a binary classifier weighs hashed letter
n-grams by the log-odds between the languages that have the bit and those that don't; decoding adds
up, per language, the bits' logistic losses against its codeword, each weighted by how well the bit
separates the languages learned, and takes the nearest codeword. A text whose two nearest codewords are
close is flagged ``ambiguous``.

Learning is one aggregation over all labelled rows: the mean n-gram frequencies per language. What
reaches the driver is one vector of ``DIMS`` numbers per language.

Defined cases: a null text or one without letters is ``und`` with score 0; rows without text or label
teach nothing; with no labelled rows every text is ``und``; every row gives a row, also rows with a null
or repeated ``doc_id``; columns other than ``doc_id``, ``text`` and the label are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import texts, tidied

DIMS = 1 << 14
LONGEST = 4
SEGMENT = 1 << 10
# A codeword margin (difference of the two best probabilities) below this is ambiguous.
MARGIN = 0.2
SMOOTHING = 2e-6
# Of the letter categories; the standard library's own classes take some numbers for letters.
LETTER = regex.compile(r"\p{L}")
# Bytes of lower-case letters as they are, and everything else one blank.
_CLASS = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def profile(text: str) -> np.ndarray | None:
    """Relative frequencies of the hashed n-grams of a whole text; None without a letter."""
    if not text or not LETTER.search(text):
        return None
    raw = _CLASS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    raw = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))].astype(np.uint32)
    code, out = raw, np.zeros(DIMS)
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | raw[n - 1:]
        slot = (code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - DIMS.bit_length() + 1)
        out += np.bincount(slot, minlength=DIMS)
    return out / out.sum()


def codewords(languages: int) -> np.ndarray:
    """One row of bits per language: all splits for up to six, else distant pseudo-random words."""
    if languages <= 6:
        bits = max(1, 2 ** (languages - 1) - 1)
        splits = np.arange(1, bits + 1)
        return np.array([[1 if not lang or not split >> (lang - 1) & 1 else -1 for split in splits]
                         for lang in range(languages)])
    best, distance, draw = None, -1, np.random.default_rng(8)
    for _ in range(200):
        words = draw.choice([-1, 1], (languages, 15 * int(np.ceil(np.log2(languages)))))
        apart = (words[:, None] != words[None]).sum(2) + np.eye(languages, dtype=int) * words.shape[1]
        usable = np.abs(words.sum(0)).max() < languages
        if usable and apart.min() > distance:
            best, distance = words, apart.min()
    if best is None:
        raise ValueError("no codewords with two-sided bits were found")
    return best


class Model:
    """Codewords and bit classifiers over the languages learned, in alphabetical order."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.languages = sorted(profiles)
        if not self.languages:
            return
        means = np.array([profiles[lang] for lang in self.languages])
        self.words = codewords(len(self.languages))
        if len(self.languages) == 1:
            self.weights, self.middle = np.zeros((1, DIMS)), np.zeros(1)
            self.slope = self.trust = np.ones(1)
            return
        has = self.words.T > 0
        one = np.array([means[bit].mean(0) for bit in has]) + SMOOTHING
        other = np.array([means[~bit].mean(0) for bit in has]) + SMOOTHING
        self.weights = np.log(one / other)
        outputs = means @ self.weights.T
        low = np.array([outputs[bit, b].min() for b, bit in enumerate(has)])
        high = np.array([outputs[~bit, b].max() for b, bit in enumerate(has)])
        self.middle = (low + high) / 2
        gap = np.maximum(low - high, 1e-9)
        self.slope = 6 / gap
        self.trust = gap / gap.sum() * len(gap)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = profile(text or "")
        if found is None or not self.languages:
            return "und", 0.0, True
        bits = (self.weights @ found - self.middle) * self.slope
        loss = (self.trust * np.logaddexp(0, -self.words * bits)).sum(1)
        odds = np.exp(loss.min() - loss)
        odds /= odds.sum()
        best = int(odds.argmax())
        second = np.delete(odds, best).max(initial=0.0)
        return self.languages[best], float(odds[best]), bool(odds[best] - second < MARGIN)


def learn(docs: DataFrame, label: str = "lang") -> Model:
    """A model from all rows of ``docs`` that have a text with letters and a label."""
    rows = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col("text"), F.col(label).cast("string").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        counts: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = profile(text.as_py())
                if found is not None:
                    sums[lang] = sums.get(lang, 0) + found
                    counts[lang] = counts.get(lang, 0) + 1
        out = [(lang, at, total[at:at + SEGMENT].tolist(), counts[lang])
               for lang, total in sums.items() for at in range(0, DIMS, SEGMENT)]
        if out:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("label", "at", "sums", "n"), row, strict=True)) for row in out], kinds)

    schema = "label string, at int, sums array<double>, n long"
    kinds = pa.schema([("label", pa.string()), ("at", pa.int32()), ("sums", pa.list_(pa.float64())), ("n", pa.int64())])
    def add(key: tuple, table: pa.Table) -> pa.Table:
        sums = np.array(table.column("sums").combine_chunks().flatten()).reshape(table.num_rows, -1).sum(0)
        return pa.table({"label": [key[0].as_py()], "at": [key[1].as_py()], "sums": [sums.tolist()],
                         "n": [sum(table.column("n").to_pylist())]}, schema=kinds)

    # One row per task, language and segment goes in; DIMS numbers per language come out.
    model = rows.mapInArrow(tidied(run), schema).groupBy("label", "at").applyInArrow(add, schema).collect()
    profiles: dict[str, np.ndarray] = {}
    for row in model:
        profiles.setdefault(row["label"], np.zeros(DIMS))[row["at"]:row["at"] + SEGMENT] = np.array(row["sums"]) / row["n"]
    return Model(profiles)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            rows = [own.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a language, unchanged; those without one, ``und``, go.

    An ambiguous text still has a language, so it stays: the flag is for callers of ``predict``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            keep = [own.predict(text.as_py())[0] != "und" for text in batch.column(batch.schema.get_field_index("text"))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
