"""Infill and byte pairs: exact round trips and comparison with the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborlight.llm import bytepairs, infill, queries

# --- infill ----------------------------------------------------------------


def brute_infill(doc_id, text, rearranged=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rearranged:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINE_TEXTS = [
    "a\nb\nc", "a\n", "\n\n\n", "x<P>y\nz", "<<\n<P\n>", "<S\n>S>\n<M", "\r\na\r\nb", "é ü\n\x85z\n",
    "\n".join(f"line {i}" for i in range(3000)), "<P>", "P>\nS>\nM>\n" * 9,
]


@pytest.mark.parametrize("shares", [(100, 50), (100, 0), (100, 100), (40, 30), (0, 50)])
def test_infill_odd(spark, odd_texts, shares):
    texts = [(i, t) for i, t in odd_texts.items()] + [(100 + i, t) for i, t in enumerate(LINE_TEXTS)]
    texts += [(None, "a\nb\nc\n"), (None, None), (3, "twice\nthe id\n"), (3, "twice\nthe id\n")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, form string, n long")
    spec = infill.Infill(rearranged_percent=shares[0], spm_percent=shares[1])
    got = infill.infill(docs, spec).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    want = sorted(((i, *brute_infill(i, t, *shares), t or "") for i, t in texts), key=repr)
    assert found == want


def test_infill_random_lines(spark):
    rng = random.Random(11)
    texts = [
        (i, "".join(rng.choice(["\n", "a", "<", "P", ">", "<P", "S>", " ", "é"]) for _ in range(rng.randrange(60))))
        for i in range(2000)
    ]
    got = infill.infill(spark.createDataFrame(texts, "doc_id long, text string"))
    got = got.withColumn("back", infill.restored(F.col("output"), F.col("form")))
    for r in got.collect():
        assert tuple(r)[1:6] == brute_infill(r.doc_id, texts[r.doc_id][1]) and r.back == texts[r.doc_id][1]


def test_infill_query(spark, sf_dir, texts, no_docs):
    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    for r in queries.op12_infill(spark, sf_dir).collect():
        n, form, prefix, middle, output = brute_infill(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(texts[r.doc_id]))
    assert infill.infill(no_docs).count() == 0


# --- byte pairs ------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.byte_tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bytepairs.Encoder(queries.byte_tokenizer_path())


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


PIECES = ["a", "b", "th", "e", " ", "\n", "\t", "'s", "'LL", "1", "é", "漢", "՘", "\U00010940", "😀", "　",
          "\x85", "\x1c", "<|endoftext|>", "<|end", "aaaa", "!!", "­", "​", "İ", "ß"]


def test_encoder_on_random_texts(encoder, library):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(1, 200))) for _ in range(1500)]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert ids(packed) == library.encode(text, add_special_tokens=False).ids, text


def test_encoder_on_long_words(encoder, library):
    rng = random.Random(8)
    texts = ["a" * 5000, "ab" * 4000, "aab" * 3000, " " * 4000, "é" * 3000, "日本語" * 900, "0" * 999, "!?" * 2000,
             "".join(rng.choices("abcdefghijklmnop", k=30_000)), "".join(rng.choices("thean", k=9000)),
             "".join(map(chr, range(0x4E00, 0x5600)))]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert ids(packed) == library.encode(text, add_special_tokens=False).ids, text[:20]


def test_both_orders_of_rounds_agree(library):
    rng = random.Random(9)
    words = ["".join(rng.choices("aeinorstlh", k=rng.randrange(1, 90))).encode() for _ in range(400)]
    merges = bytepairs.Merges(queries.byte_tokenizer_path())
    short = merges.merged(words)
    longest, bytepairs.LONG_WORD = bytepairs.LONG_WORD, 0
    try:
        assert merges.merged(words) == short
    finally:
        bytepairs.LONG_WORD = longest


def test_settled_characters_split_alike(encoder, library):
    """Every settled character, in every neighbourhood, is split as the library does."""
    import regex

    chars = regex.findall(f"[{bytepairs.SETTLED}]", "".join(map(chr, range(0x10000))))
    assert len(chars) > 30_000
    for at in range(0, len(chars), 500):
        text = "".join(f"a{c}1{c}! {c}{c} b" for c in chars[at : at + 500])
        split = library.pre_tokenizer.pre_tokenize_str(text)
        assert encoder.words(text) == [text[a:b] for _, (a, b) in split], hex(ord(chars[at]))


def test_forgetting_words_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bytepairs, "_KNOWN_BYTES", 500)
    small = bytepairs.Encoder(queries.byte_tokenizer_path())
    for text in ("the quick brown fox", "jumps over the lazy dog <|endoftext|>", "the quick brown fox"):
        assert ids(small.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_byte_pairs_odd(spark, odd_texts, odd_docs, no_docs, library):
    path = queries.byte_tokenizer_path()
    coded = bytepairs.decode(bytepairs.encode(odd_docs, path), path)
    for r in coded.collect():
        text = odd_texts[r.doc_id] or ""
        assert r.ids == library.encode(text, add_special_tokens=False).ids and r.decoded == text
    assert bytepairs.decode(bytepairs.encode(no_docs, path), path).count() == 0


def test_decode_any_ids(spark, library):
    """Ids in any order, null, and bytes that are no UTF-8."""
    rng = random.Random(10)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(40))] for _ in range(300)] + [[], [50256], [187, 187]]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "doc_id long, ids array<int>")
    for r in bytepairs.decode(frame, queries.byte_tokenizer_path()).collect():
        want = library.decode(lists[r.doc_id], skip_special_tokens=False) if r.doc_id >= 0 else ""
        assert r.decoded == want


def test_byte_pairs_query(spark, sf_dir, texts, library):
    got = {r.doc_id: r for r in queries.op13_byte_pairs(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        want = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(want, skip_special_tokens=False)
        assert got[doc_id].n_tokens == len(want)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
