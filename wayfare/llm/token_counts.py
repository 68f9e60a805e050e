"""Token counts under a unigram vocabulary: count-only Viterbi over Aho-Corasick matches.

The automaton lists, for every end position, all vocabulary pieces that end there; the dynamic
programme keeps per position only the best score and its number of pieces, in a ring as long as
the longest piece. The tie rule is the tokenizer's: starts are tried from left to right and a later one
wins only with a strictly higher score, so of equal paths the one whose last piece is longest stays.
A character that no piece of its own covers may stand alone at the unknown score (10 below the
lowest), and then counts one token per UTF-8 byte, as with byte fallback.

Spaces become U+2581 and one is put before the text. No piece has U+2581 after another
character, so the best path over a text is that over each run ``U+2581* other+`` in turn; runs
recur, and their results are remembered. A vocabulary without that property is taken whole.

Defined cases: a null or empty text has no tokens and score 0; every row gives a row, also rows
with a null or repeated ``doc_id``; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from wayfare.llm.common import texts

SPACE = "▁"
RUN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Runs up to this many characters are remembered, so many of them at a time.
SHORT, REMEMBERED = 48, 400_000
# Texts up to this length need no ring.
FLAT = 1000
LOWEST = float("-inf")


class Vocabulary(dict):
    """Runs of text to (pieces, score); as a dictionary it remembers what it has worked out."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - 10.0
        self.ring = max(len(piece) for piece, _ in pieces) + 1
        self.by_runs = not any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)

    def viterbi(self, text: str) -> tuple[int, float]:
        """Number of tokens and score of the best path over ``text``."""
        if len(text) <= FLAT and self.single.issuperset(text):
            return self.covered(text)
        ring, n = self.ring, len(text)
        best, count = [0.0] * ring, [0] * ring
        matches = self.automaton.iter(text)
        last, match = next(matches, (n, None))
        for end in range(1, n + 1):
            top, tokens = None, 0
            while last == end - 1:  # longest first: starts from left to right
                start = (end - match[0]) % ring
                value = best[start] + match[1]
                if top is None or value > top:
                    top, tokens = value, count[start] + 1
                last, match = next(matches, (n, None))
            char = text[end - 1]
            if char not in self.single:
                start = (end - 1) % ring
                value = best[start] + self.unknown
                if top is None or value > top:
                    top, tokens = value, count[start] + len(char.encode())
            best[end % ring], count[end % ring] = top, tokens
        return count[n % ring], best[n % ring]

    def covered(self, text: str) -> tuple[int, float]:
        """The same for a short text whose every character is a piece: no unknowns, no ring."""
        best, count = [0.0] + [LOWEST] * len(text), [0] * (len(text) + 1)
        for last, (length, score) in self.automaton.iter(text):
            start = last + 1 - length
            value = best[start] + score
            if value > best[last + 1]:
                best[last + 1] = value
                count[last + 1] = count[start] + 1
        return count[-1], best[-1]

    def __missing__(self, run: str) -> tuple[int, float]:
        result = self.viterbi(run)
        if len(run) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = result
        return result

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_runs:
            return self.viterbi(text)
        results = [self[run] for run in RUN.findall(text)]
        return sum(r[0] for r in results), sum(r[1] for r in results)


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file, without its control, unknown and byte symbols."""
    file = sentencepiece.SentencePieceProcessor(model_file=model)
    return Vocabulary([(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())
                       if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i) or file.is_unused(i))])


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens long, score double`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            counts = [words.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c[0] for c in counts], pa.int64()),
                 pa.array([c[1] for c in counts], pa.float64())], ["doc_id", "n_tokens", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, score double")
