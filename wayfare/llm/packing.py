"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces of binary length: as many of ``limit`` as fit, then one piece
per set bit of the rest, from the longest down. A piece is a sequence of its own, so no sequence
crosses documents and none needs padding; sequences of equal length are numbered in a row and so
form the buckets that batches are drawn from.

Numbering needs no shuffle: each task numbers its own pieces per length as it writes them, and only
the tasks' counts per length are summed up.

Defined cases: a null or empty text is the closing id alone; every row is a document, also rows with a
null or repeated ``doc_id``; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from wayfare.llm.common import binary, kept, pieces_of, small_batches, stored, texts

LIMIT = 4096
CLOSING = 2
# Bytes of text tokenized at a time, each text at the least weight, and words that a worker remembers before it parts with older ones.
AT_ONCE, AT_LEAST, REMEMBERED = 2 << 20, 4096, 300_000
# Parts of words that it remembers before it begins anew.
PARTS = 300_000


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, by way of their words.

    The tokenizer's patterns never cross white space, so a text's ids are those of its words in turn;
    words recur and are remembered. New words in plain Latin letters, digits and ASCII signs
    are cut by the tokenizer's own pattern, and their parts, which many words share but for case and signs, are remembered
    too. New parts go to the tokenizer's merges alone, many in one call, with a line feed after each that tells them
    apart again. Any other word, and any word if the file is of another kind, takes the tokenizer's whole way.
    """

    # Lower-cased by one rule everywhere, and not touched by Unicode composition.
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    ALL_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ\\n]+")
    CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\\n]+")
    # White space to Python only; the tokenizer takes these for signs.
    CONTROLS = "\x1c\x1d\x1e\x1f\x85"
    BLANK = re.compile(r"[^ \t\n\r]+")
    # The pattern and normal form of the file that the short way reproduces.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    FORMS = ["NFC", "Replace", "Lowercase"]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole, self.known, self.before = Tokenizer.from_file(path), {}, {}
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.special = tuple(token["content"] for token in parts["added_tokens"])
        # Texts that are not cut at white space as Python sees it.
        self.odd = "|".join([f"[{self.CONTROLS}]", *map(re.escape, self.special)])
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.short = (parts["model"].get("end_of_word_suffix") == "</w>"
                      and [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])] == self.FORMS
                      and splits[0].get("pattern", {}).get("Regex") == self.PATTERN and splits[-1].get("type") == "ByteLevel")
        if self.short:
            merges = json.dumps({**parts, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []})
            self.merges = Tokenizer.from_str(merges)
            # Byte-level alphabet: a byte that is no printable character stands as one above 255.
            printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
            hidden = [b for b in range(256) if b not in printable]
            self.letters = {b: 256 + n for n, b in enumerate(hidden) if b != 32}
            self.end = chr(self.letters[10])
            vocabulary = self.merges.get_vocab()
            self.feed = vocabulary[self.end + "</w>"]
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
            self.parts = {self.end: np.array([self.feed], "<u4").tobytes()}

    def words(self, text: str) -> list[str]:
        if any(token in text for token in self.special):
            return [text]  # these strings have ids of their own, white space inside or not
        if any(control in text for control in self.CONTROLS):
            return self.BLANK.findall(text)
        return text.split()

    def hinted(self, words: set[str]) -> bool:
        """Whether any word can hold a special string, by one look at all of them."""
        joined = "\n".join(words)
        return any(token in joined for token in self.special)

    def __call__(self, many: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(many, self.odd)
        # Arrow splits at the white space that Python does, and numbers the words, so that each is looked up once.
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", many))
        numbered = split.flatten().dictionary_encode()
        rest = {i: self.words(many[i].as_py()) for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()}
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.remember({*words}.union(*rest.values()))
        own = [self.known[word] for word in words]
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        number = numbered.indices.to_numpy()
        length = size[number]
        ends = np.cumsum(length)
        first = (np.cumsum(size) - size)[number] - (ends - length)  # of a word's ids, less their place in the batch
        at = np.repeat(first, length) + np.arange(length.sum())
        raw = np.frombuffer(b"".join(own), "<u4")[at].tobytes()
        upto = [0, *(4 * np.append(0, ends)[np.cumsum(pc.list_value_length(split).to_numpy())]).tolist()]
        out = [raw[i:j] for i, j in pairwise(upto)]
        for i, parts in rest.items():
            out[i] = b"".join(map(self.known.__getitem__, parts))
        return out

    def remember(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            # Words met since the last time stay within reach, so that common ones are not learned again.
            self.known, self.before = {}, self.known
            new = words
        if self.before:
            again = self.before.keys() & new
            self.known.update((word, self.before[word]) for word in again)
            new = new - again
        self.learn_all(new)

    def learn_all(self, new: set[str]) -> None:
        # A word with a special string is one of many blanks and signs, or a whole text: it takes the long way.
        special = {word for word in new if any(token in word for token in self.special)} if self.hinted(new) else ()
        other = list(special)
        for ascii_only, keep in ((True, filter), (False, filterfalse)):  # the latter's bytes must be translated
            words = list(keep(str.isascii, new.difference(special)))
            if not (self.short and self.ALL_PLAIN.fullmatch("\n".join(words))):
                plain = self.PLAIN.fullmatch if self.short else lambda word: False
                other.extend(filterfalse(plain, words))
                words = list(filter(plain, words))
            self.learn(words, ascii_only)
        for word in other:
            self.known[word] = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, plain: list[str], ascii_only: bool) -> None:
        for first in range(0, len(plain), 8192):
            some = plain[first:first + 8192]
            # Each word ends in a line feed, which no word has and which gets an id of its own.
            line = self.CUT.sub(r"\g<0> ", "\n".join(some).lower() + "\n")
            if not ascii_only:
                line = line.encode().decode("latin-1").translate(self.letters)
            parts = line.replace(self.end if not ascii_only else "\n", f"{self.end} ").split()
            own = set(parts)
            new = own.difference(self.parts)
            if len(self.parts) + len(new) > PARTS:
                self.parts, new = {self.end: np.array([self.feed], "<u4").tobytes()}, own - {self.end}
            if new:
                # A part's last token, and no other, is one that ends a word.
                ids = np.array(self.merges.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
                self.parts.update(zip(new, self.cut(ids, self.last[ids], 1), strict=True))
            ids = np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), "<u4")
            self.known.update(zip(some, self.cut(ids, ids == self.feed, 0), strict=True))

    @staticmethod
    def cut(ids: np.ndarray, ends: np.ndarray, kept: int) -> list[bytes]:
        """The ids in runs, each up to where ``ends`` is true, with ``kept`` or without that id."""
        raw, at = ids.tobytes(), np.flatnonzero(ends)
        return [raw[i:j] for i, j in zip([0, *(4 * at[:-1] + 4).tolist()], (4 * (at + kept)).tolist(), strict=True)]


def word_ids(path: str) -> WordIds:
    """One per worker process, so that what it remembers serves later tasks too."""
    return kept(path, lambda: WordIds(path))


def cuts(n: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the pieces of ``n`` ids; ``limit`` is a power of two."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << b for b in range(limit.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, limit: int = LIMIT, closing: int = CLOSING) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Sequences are numbered
    from 0 without gaps, those of the greatest length first.
    """
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = word_ids(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for part in pieces_of([batch], lambda b: pc.binary_length(b.column(1)).to_numpy() + AT_LEAST, AT_ONCE):
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1)), strict=True):
                    ids += end
                    start, total = 0, len(ids) // 4
                    for length in cuts(total, limit):
                        rows.append((doc, start, length, ids[4 * start:4 * (start + length)], total, seen[length]))
                        seen[length] += 1
                        start += length
                if rows:
                    doc, start, length, ids, total, number = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x, pa.int64()) for x in (doc, start, length)), binary(ids),
                         pa.array(total, pa.int64()), pa.array([task] * len(rows), pa.int32()),
                         pa.array(number, pa.int64())],
                        ["doc_id", "start", "length", "ids", "doc_tokens", "__task", "__number"])

    with small_batches(docs.sparkSession):
        pieces = stored(texts(docs).mapInArrow(
            run, "doc_id long, start long, length long, ids binary, doc_tokens long, __task int, __number long"), "pieces")
    counts = pieces.groupBy("length", "__task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    longer = (counts.groupBy("length").agg(F.sum("n").alias("n"))
              .withColumn("__longer", F.coalesce(F.sum("n").over(
                  Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("length", "__longer"))
    # A row per task and length: 13 lengths at the usual limit, so its size is bounded by the tasks.
    bases = counts.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(
        F.broadcast(longer), "length").select("length", "__task", (F.col("__before") + F.col("__longer")).alias("__base"))
    return pieces.join(F.broadcast(bases), ["length", "__task"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.col("__base") + F.col("__number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
