"""Token ids, offsets and counts against the public libraries."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from asterism.llm import bpe, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "'", "s", "t", "re", "ve", "ll", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "\r", "1",
         "½", "é", "!", "😀", "中", "٣", "́", "\xa0", "　", "S", "'S", "the", "\x00", "​"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(BYTES), special_tokens={}
    )


def random_texts(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.choice([0, 1, 2, 3, 20, 300]))) for _ in range(n)]


def ids(line):
    return np.frombuffer(line, "<u4").tolist()


def test_encode_as_the_library(spark, library):
    texts = [None, "", " ", "a" * 5000, " " * 3000, "!" * 700, "x\n" * 2000, "<|endoftext|>", *random_texts(1)]
    texts.append("".join(random_texts(2)))  # far longer than a block of the scan
    rows = [(i, t, "kept", 3) for i, t in enumerate(texts)] + [(0, "again", "kept", 3)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, IDS string, n_tokens int")
    tokenizer = bpe.ByteBPE(spark, BYTES)
    coded = tokenizer.encode(df)
    assert coded.columns == ["doc_id", "text", "ids", "offsets", "n_tokens"]
    decoded = tokenizer.decode(coded, offsets="offsets").collect()
    assert len(decoded) == len(rows)
    assert sorted(map(str, decoded)) == sorted(map(str, tokenizer.encode(df, decoded="decoded").collect()))
    for row in decoded:
        text = row.text or ""
        expected = library.encode_ordinary(text)
        assert ids(row.ids) == expected
        assert row.n_tokens == len(expected)
        assert row.decoded == text.encode()
        begins = np.cumsum([0] + [len(library.decode_single_token_bytes(t)) for t in expected])[:-1]
        assert ids(row.offsets) == begins.tolist()


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    tokenizer = bpe.ByteBPE(spark, BYTES)
    assert tokenizer.decode(tokenizer.encode(df)).collect() == []
    assert tokens.Unigram(spark, tokens.Vocabulary((("<unk>", 0.0),))).count(df).collect() == []


def test_wrong_offsets_fail(spark):
    df = spark.createDataFrame([("two words",)], "text string")
    tokenizer = bpe.ByteBPE(spark, BYTES)
    coded = tokenizer.encode(df)
    coded = coded.withColumn("offsets", coded["ids"])
    with pytest.raises(Exception, match="offsets"):
        tokenizer.decode(coded, offsets="offsets").collect()


def test_boundaries_of_all_short_texts():
    """Every text of up to four characters out of one of each kind."""
    kinds = ["a", "s", "1", "!", "'", " ", "\n"]
    texts = ["".join(t) for n in range(5) for t in itertools.product(kinds, repeat=n)]
    raw, edges, counts = bpe.pretokens(texts, bpe.class_table())
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        cut = [raw[edges[i] : edges[i + 1]].decode() for i in range(at, at + n)]
        assert cut == regex.findall(public_tokenizers.PATTERN, text)
        at += n


def test_long_slices_merge_alike():
    ranks = bpe.load_ranks(BYTES)
    rng = random.Random(4)
    for n in (2, 5, 47, 200):
        piece = "".join(rng.choices("thein ", k=n)).encode()
        low, bpe.LONG_SLICE = bpe.LONG_SLICE, 1 << 30
        short = bpe.merge_pairs(piece, ranks)
        bpe.LONG_SLICE = low
        assert bpe._merge_long(piece, ranks) == short or piece in ranks


# --- unigram counts --------------------------------------------------------


def reference(vocabulary, by_bytes):
    model = models.Unigram(list(vocabulary.entries), vocabulary.unknown, by_bytes)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_of_the_public_vocabulary(spark):
    vocabulary = tokens.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    count = reference(vocabulary, True)
    texts = [None, "", " ", "▁", "a▁b", "\n", "word\nword", "<s>", "<0x0A>", "é" * 500, *random_texts(7)]
    texts.append(" ".join(random_texts(8)))
    rows = [(i, t, 9) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, N_Tokens int")
    got = tokens.Unigram(spark, vocabulary).count(df)
    assert got.columns == ["doc_id", "text", "n_tokens"]
    got = got.collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.n_tokens == count(row.text), row.text


def test_ties_and_unknowns():
    """Small whole scores make ties common; without byte entries unknowns fuse."""
    rng = random.Random(9)
    for _ in range(20):
        words = {"".join(rng.choices("abc▁", k=rng.randint(1, 4))) for _ in range(12)}
        entries = (("<unk>", 0.0), *((w, float(-rng.randint(0, 3))) for w in sorted(words)))
        vocabulary = tokens.Vocabulary(entries)
        count, own = reference(vocabulary, False), tokens.Counter(vocabulary)
        for _ in range(200):
            text = "".join(rng.choices("aabbcd \n", k=rng.randint(0, 14)))
            assert own.count(text) == count(text), (entries, text)
