"""Tokenizing operators against the libraries over whole texts."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from cases import long_text
from tokenizers import Tokenizer, models

from wayfare.llm import byte_bpe, packing, token_counts
from wayfare.llm.queries import BYTE_BPE, PIECES, WORD_BPE


@pytest.fixture(scope="module")
def every(odd, docs):
    return odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))


def test_packing(every):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = sorted((r.doc_id or -1, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]))
                  for r in every.collect())
    pieces = [r for r in packing.pack(every, WORD_BPE).collect()]
    assert sorted(r.sequence_id for r in packing.pack(every, WORD_BPE).collect()) == list(
        range(packing.pack(every, WORD_BPE).count()))
    lengths = [r.length for r in sorted(pieces, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True) and all(n & (n - 1) == 0 and n <= 4096 for n in lengths)
    by_start = defaultdict(list)
    for r in pieces:
        assert len(r.ids) == 4 * r.length and r.offset == 0
        by_start[r.doc_id or -1, r.doc_tokens].append(r)
    total = sum(len(ids) for _, ids in want)
    assert sum(r.length for r in pieces) == total
    for doc, ids in want:
        mine = by_start[doc, len(ids)]
        at = {r.start: struct.unpack(f"<{r.length}I", r.ids) for r in mine if
              struct.unpack(f"<{r.length}I", r.ids) == ids[r.start:r.start + r.length]}
        assert sum(len(v) for v in at.values()) == len(ids)


def test_packing_special_strings_follow_the_library(spark):
    text = "a <|endoftext|> b<|startoftext|>c"
    row, = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), WORD_BPE, limit=64).where("start = 0").collect()
    ids = [*Tokenizer.from_file(WORD_BPE).encode(text, add_special_tokens=False).ids, 2]
    assert list(struct.unpack(f"<{row.length}I", row.ids)) == ids[:row.length]


def test_packing_any_text(spark):
    """Special strings with and without blanks, in any case, between odd blanks, marks and signs."""
    draw = random.Random(8)
    signs = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "  ", "\t", "\n", "\x1c", "\x85", "\xa0", "\u3000", "\0",
             "a", "B", "zé", "Ä", "ß", "\u0301", "1", "23", "'s", "'LL", "!", "##", "日本", "🙂", "don't", "½", "İ", "ſ"]
    rows = [(i, "".join(draw.choices(signs, k=draw.randint(0, 9)))) for i in range(3000)]
    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = defaultdict(dict)
    for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORD_BPE).collect():
        got[r.doc_id][r.start] = struct.unpack(f"<{r.length}I", r.ids)
    for i, text in rows:
        ids = [x for start in sorted(got[i]) for x in got[i][start]]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


class Counted:
    """A tokenizer that notes what it is asked to encode."""

    def __init__(self, inner):
        self.inner, self.asked = inner, []

    def encode_batch_fast(self, lines, **options):
        self.asked += " ".join(lines).split()
        return self.inner.encode_batch_fast(lines, **options)


def test_packing_merges_each_part_once():
    encode, tokenizer = packing.WordIds(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    encode.merges = Counted(encode.merges)
    texts = ["Hello hello, HELLO. (hello)", "\n hello\thello!\xa0Hello's ", "", "  "]
    got = encode(pa.array(texts))
    assert encode.merges.asked.count("hello") == 1 and len(encode.merges.asked) == len(set(encode.merges.asked))
    assert [list(struct.unpack(f"<{len(raw) // 4}I", raw)) for raw in got] == [
        tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_packing_when_words_and_parts_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    monkeypatch.setattr(packing, "PARTS", 15)
    draw, tokenizer, encode = random.Random(3), Tokenizer.from_file(WORD_BPE), packing.WordIds(WORD_BPE)
    words = ["".join(draw.choices("abcÉß1.,'%", k=draw.randint(1, 6))) for _ in range(300)] + ["日本", "<|endoftext|>", "x\x1cy", "z\u2028w"]
    for _ in range(40):
        texts = [" ".join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(draw.randint(0, 6))]
        got = encode(pa.array(texts, pa.string()))
        assert [list(struct.unpack(f"<{len(raw) // 4}I", raw)) for raw in got] == [
            tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_arrow_splits_where_python_does():
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    got = pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in signs])).to_pylist()
    assert [c for c, parts in zip(signs, got, strict=True) if parts != f"a{c}b".split()] == []


@pytest.mark.parametrize("n", [1, 2, 4095, 4096, 4097, 13000])
def test_cuts(n):
    got = packing.cuts(n)
    assert sum(got) == n and got == sorted(got, reverse=True) and len(set(got[n // 4096:])) == len(got[n // 4096:])


def test_byte_bpe(every):
    encoder = byte_bpe.encoding(BYTE_BPE)
    got = byte_bpe.decode(byte_bpe.encode(every, BYTE_BPE), BYTE_BPE).collect()
    want = sorted((str(r.doc_id), encoder.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in every.collect())
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in got) == want


@pytest.mark.parametrize("text", [long_text(400), "a  b\n\n c's 12 " * 60, "ab  cd \n" * 90, "x" * 900])
def test_parts_lose_no_merge(text):
    encoder = byte_bpe.encoding(BYTE_BPE)
    parts = list(byte_bpe.parts(text, 50))
    assert "".join(parts) == text
    assert [i for p in parts for i in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)


def test_token_counts_against_a_unigram_model(every):
    file = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = [("<unk>", -2e9)] + [(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())
                                 if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i))]
    # The library takes the unknown score from the lowest one, so the unknown piece must not be it.
    pieces[0] = ("<unk>", 0.0)
    pieces += [(f"<0x{b:02X}>", -1e9) for b in range(256)]
    unigram = Tokenizer(models.Unigram(pieces, 0, True))

    def count(text):
        return len(unigram.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0

    got = {(str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(every, PIECES).collect()}
    want = {(str(r.doc_id), count(r.text)) for r in every.collect() if "<0x" not in (r.text or "")}
    assert want <= got and len(got) <= len(want) + 1


def test_tie_goes_to_the_longest_last_piece():
    ties = token_counts.Vocabulary([("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -5.0), ("ab", -6.0)])
    assert ties.viterbi("aaa") == (1, -3.0)
    assert ties.viterbi("aab") == (2, -7.0)
    assert ties.viterbi("é") == (2, -16.0)


def test_empty_tables(none):
    assert packing.pack(none, WORD_BPE).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none, BYTE_BPE), BYTE_BPE).count() == 0
    assert token_counts.token_counts(none, PIECES).count() == 0


def test_digests_of_the_queries(spark):
    from wayfare.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    encoder = byte_bpe.encoding(BYTE_BPE)
    for r in QUERIES["op5_byte_bpe"](spark, folder).collect():
        ids = encoder.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for r in QUERIES["op2_pow2_packing"](spark, folder).collect():
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start:r.start + r.length]))
