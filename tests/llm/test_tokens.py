"""Token counts against the library, for tokenizers that drop white space and that keep it."""

import random

import pytest

from quarry.llm import queries as Q
from quarry.llm import token_count as T

PIECES = ["word", "Wörter", " ", "  ", "\n", "\t \n", "　", "'s", "don't", "1234", "!?", "<|endoftext|>", "é", "中文", "🙂", "x" * 40]


@pytest.mark.parametrize("name,splices", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_equal_to_library(spark, name, splices):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(Q.tokenizer_path(name))
    assert T.drops_space(t) == splices
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(n)) for n in (0, 1, 5, 60, 400, 900, 3000)] * 3
    texts += ["x" * 5000, " " * 5000, " ".join(["a"] * 4000), "\n".join("line %d" % i for i in range(2000)), None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk, overlap in ((64, 8), (700, 60), (8192, 512)):
        got = {r.doc_id: r for r in T.token_counts(d, Q.tokenizer_path(name), chunk=chunk, overlap=overlap).collect()}
        for i, s in enumerate(texts):
            assert got[i].n_tokens == len(t.encode(s or "", add_special_tokens=False)), (i, chunk)
            assert got[i].n_bytes == len((s or "").encode()) and got[i].over_limit == (got[i].n_tokens > 2048)


def test_splice_of_mixed_texts():
    """Small chunks and overlaps, so that splices, wider overlaps and longer chunks all occur."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(Q.tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(5, 120)))
        chunk, overlap = rng.choice([(64, 8), (40, 6), (100, 30), (700, 60)])
        assert T.resync_count(t, text, chunk, overlap) == len(t.encode(text, add_special_tokens=False)), (text, chunk)
