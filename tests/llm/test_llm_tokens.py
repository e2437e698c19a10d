from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import ODD_ROWS, empty_docs, odd_docs, sha
from slotflow.llm import bpe, tokens

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_pre_tokens_add_up():
    library = tokens.model(PIECES)
    random.seed(1)
    for _ in range(3000):
        text = "".join(random.choice("ab  ▁\n\tthe é中1") for _ in range(random.randint(0, 30)))
        counts = tokens.piece_counts(library, tokens.pre_tokens(text))
        assert sum(counts) == len(library.encode(text)), repr(text)


@pytest.mark.parametrize("block_chars", [1, 100, 1 << 22])
def test_counts(text_spark, block_chars):
    found = tokens.token_counts(odd_docs(text_spark), PIECES, buckets=5, block_chars=block_chars).collect()
    library = tokens.model(PIECES)
    wanted = [(k, len((t or "").encode()), len(library.encode(t or ""))) for k, t in ODD_ROWS]
    assert Counter(map(tuple, found)) == Counter(wanted)


def test_no_rows(text_spark):
    assert tokens.token_counts(empty_docs(text_spark), PIECES).collect() == []
    assert bpe.bpe_digests(empty_docs(text_spark), WORDS).collect() == []


def whole(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("run", [16, 8192])
def test_digests(text_spark, run):
    tokenizer = Tokenizer.from_file(WORDS)
    random.seed(2)
    rows = list(ODD_ROWS)
    for alphabet in ("aaab", "thein", "é́ñçß中文字кирилİ0123!?'mlsd▁​́", "electro", "'sdm!", "<|endoftext|>"):
        rows += [(100, "".join(random.choice(alphabet) for _ in range(n))) for n in (17, 100, 700)]
    rows += [(200, "<|endoftext|>" * 40), (201, "ab<|startoftext|>" * 30 + "x" * 99), (202, "the" * 500 + " and " + "rest" * 9)]
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = bpe.bpe_digests(docs, WORDS, run=run).collect()
    assert Counter(map(tuple, found)) == Counter((k, *whole(tokenizer, t)) for k, t in rows)


def test_joined_halves_are_the_whole():
    codec, tokenizer = bpe.Codec(WORDS), Tokenizer.from_file(WORDS)
    random.seed(3)
    for _ in range(2000):
        text = "".join(random.choice("theinaros") for _ in range(random.randint(2, 80)))
        cut = bpe.halves(text, random.randint(1, 20))
        parts = [codec.encode_part(1, p) for p in cut[:-1]] + [codec.encode_part(2, cut[-1])]
        assert codec.concatenate(parts) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_rows_with_other_key_types(text_spark):
    docs = text_spark.createDataFrame([("a", "some words"), (None, "x")], "name string, body string")
    found = {r["name"]: r["n_tokens"] for r in bpe.bpe_digests(docs, WORDS, key="name", text="body").collect()}
    assert found.keys() == {"a", None} and found["a"] == 2
    assert tokens.token_counts(docs, PIECES, key="name", text="body").count() == 2


@pytest.mark.parametrize("most_words", [1, 3000, 10**6])
def test_buckets_in_parts_count_alike(text_spark, monkeypatch, most_words):
    """Every word is sampled, so that small tables have buckets of many parts."""
    monkeypatch.setattr(tokens, "SAMPLE", 1)
    path = public_tokenizers.path("piece_bpe_32k.model")
    loaded = tokens.model(path)
    random.seed(2)
    texts = [" ".join(random.choice("abcdeé\U0001F600") * random.randint(1, 3) + str(random.randint(0, 4000)) for _ in range(300)) for _ in range(60)]
    docs = text_spark.createDataFrame([*enumerate(texts), (60, None), (61, "")], "doc_id long, text string").repartition(3)
    found = tokens.token_counts(docs, path, buckets=3, block_chars=20_000, most_words=most_words).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {60: 0, 61: 0} | {i: len(loaded.encode(t)) for i, t in enumerate(texts)}


def test_long_texts_pass_the_tree(text_spark):
    """Cuts fall within words, marks, special tokens, composed letters and runs without an end; long texts repeat."""
    codec, tokenizer = bpe.Codec(WORDS), Tokenizer.from_file(WORDS)
    random.seed(4)
    pieces = ["the", "Running", "don't", "e\u0301te\u0301", "ÇOK", "中文字", "<|endoftext|>", "--!?", "12345", "x" * 70, "\u00a0", "a\u2003b"]
    texts = ["".join(random.choice(pieces) + random.choice(["", " ", "\n", "\r\n", "\t"]) for _ in range(random.randint(40, 400))) for _ in range(60)]
    kinds = Counter(kind for text in texts for kind, _ in codec.cut(text, 100))
    assert min(kinds[k] for k in (0, 1, 2)) > 100 and kinds[3]
    rows = [*enumerate(texts), (0, texts[0]), (0, texts[0]), (70, texts[0]), (None, texts[1])]
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for size in (50, 100, 333):
        found = bpe.bpe_digests(docs, WORDS, run=size).collect()
        assert Counter(map(tuple, found)) == Counter((k, *whole(tokenizer, t)) for k, t in rows)


def test_plain_runs_are_the_librarys():
    codec, tokenizer = bpe.Codec(WORDS), Tokenizer.from_file(WORDS)
    assert codec.is_plain
    random.seed(5)
    letters = [c for c in map(chr, range(256)) if bpe.PLAIN.fullmatch(c)]
    marks = [chr(i) for i in range(33, 127) if not chr(i).isalnum()]
    runs = {"".join(random.choices(letters, k=random.randint(1, 9)) + random.choices(marks, k=random.randint(0, 4))) for _ in range(20_000)}
    codec.learn(runs)
    for run in runs:
        ids = tokenizer.encode(run, add_special_tokens=False).ids
        assert codec.runs[run] == (len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)), run


def test_cutting_takes_linear_time():
    codec = bpe.Codec(WORDS)
    for text in ("x" * 3_000_000, "ab " * 1_000_000, "word" * 5000 + " " + "y" * 2_000_000):
        parts = list(codec.cut(text, 10_000))
        assert "".join("".join(bpe.split(part)) for _, part in parts) == text.replace(" ", "")
        assert max(len(t) for _, t in parts) <= 10_000
