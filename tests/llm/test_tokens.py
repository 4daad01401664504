"""Token counts and the BPE codec against the tokenizers library."""
import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kestrel.llm import bpe_codec, token_counts

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
SPECIAL = ["<|endoftext|> hi <|startoftext|>x<|endoftext|>", "<|end", "ΣΑΣ ΟΔΟΣ", "İ ﬁ Å ſ", "  \n\n\t x \r\n", "it's we'LL 'S don't 12345",
           "日本語 한국어 हिन्दी 🙂👩‍👩‍👧", "\x1c\x1d \x85   ​﻿", "aaaa aaa aa a aaaaa", "­ x\x00\x01", "a" * 5000]


def spec(path):
    with open(path, encoding="utf-8") as fh:
        return fh.read()


@pytest.fixture(scope="module")
def lib():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


@pytest.fixture(scope="module")
def own():
    return {WORD: token_counts.Counter(spec(WORD)), BYTE: bpe_codec.Codec(spec(BYTE))}


def check(lib, own, texts):
    want = [len(e.ids) for e in lib[WORD].encode_batch(texts, add_special_tokens=False)]
    assert own[WORD].counts(texts) == want
    flat, n, shown = own[BYTE].encode(texts)
    found = lib[BYTE].encode_batch(texts, add_special_tokens=False)
    assert shown == [",".join(map(str, e.ids)).encode() for e in found]
    assert n.tolist() == [len(e.ids) for e in found]
    start = 0
    for e, k in zip(found, n.tolist(), strict=True):
        assert own[BYTE].decode(flat[start:start + k]).decode("utf-8", "replace") == \
            lib[BYTE].decode(e.ids, skip_special_tokens=False)
        start += k


def test_special_texts(lib, own):
    check(lib, own, SPECIAL)


def test_random_texts(lib, own):
    rng = random.Random(2)
    check(lib, own, ["".join(rng.choice("aeithn s'.,\n é🙂Σ1ab<|>") for _ in range(rng.randint(1, 200))) for _ in range(400)]
          + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(300)])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    if not hasattr(test_any_text, "both"):
        test_any_text.both = ({p: Tokenizer.from_file(p) for p in (WORD, BYTE)},
                              {WORD: token_counts.Counter(spec(WORD)), BYTE: bpe_codec.Codec(spec(BYTE))})
    check(*test_any_text.both, [text])


def test_forgetting_changes_nothing(own):
    codec = bpe_codec.Codec(spec(BYTE), most_kept=5)
    texts = ["one two three four five six seven", "eight nine", "one two"]
    again = [codec.encode([t])[2][0] for t in texts for _ in range(2)]
    assert again[::2] == again[1::2] == own[BYTE].encode(texts)[2]


def test_count_query(spark, odd_docs, no_docs, lib):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in token_counts.count_tokens(odd_docs, WORD).collect())
    want = []
    for r in odd_docs.collect():
        n = len(lib[WORD].encode(r["text"] or "", add_special_tokens=False).ids)
        want.append((r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()), n, n > 2048))
    assert got == sorted(want)
    assert token_counts.count_tokens(no_docs, WORD).count() == 0


def test_codec_queries(spark, odd_docs, no_docs, lib):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["exact"])
                 for r in bpe_codec.round_trip(odd_docs, BYTE).collect())
    want = []
    for r in odd_docs.collect():
        ids = lib[BYTE].encode(r["text"] or "", add_special_tokens=False).ids
        want.append((len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode()), True))
    assert got == sorted(want)
    back = bpe_codec.decode(bpe_codec.encode(odd_docs, BYTE), BYTE)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in odd_docs.collect())
    assert bpe_codec.round_trip(no_docs, BYTE).count() == 0
