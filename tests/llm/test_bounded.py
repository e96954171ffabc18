"""Very long texts: memory and time of one text stay in proportion to its length."""

import random
import time
import tracemalloc

import numpy as np
import pytest

from quarry.llm import license_scan, pii
from tests.llm.test_edges import DOCS


def learned() -> pii.SpanModel:
    rng = random.Random(4)
    texts = [f"write to a{i}@mail.example or call +49 30 {rng.randrange(10**6, 10**7)} token = {rng.randbytes(12).hex()} in 19{i % 90 + 10}"
             for i in range(60)]
    return pii.train(texts, rounds=6)


def unbroken(n: int) -> str:
    rng = random.Random(n)
    return "".join(rng.choices("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/", k=n))


def test_segments_in_a_stream_equal_all_at_once():
    model = learned()
    for text in [unbroken(400), "a@b.c " * 40 + "x1 y2 (3)", "1", "call +49 30 1234567 or 4111 1111 1111 1111 now 12"]:
        want = []
        for lo, hi in pii.islands(text):
            island = pii.Island(text, lo, hi)
            if hi - lo >= 5 and island.spans:
                scores = np.array([model.score(f) for f in island.features])
                found = pii._best(len(island.at), island.spans, scores, model.trans)
                want += [(island.at[i][0], island.at[j - 1][1], pii.KINDS[c]) for i, j, c in found]
        assert model.spans(text) == want


def test_an_unbroken_run_is_not_held_as_segments():
    model, text = learned(), unbroken(24_000)
    tracemalloc.start()
    model.spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(text)   # all segments with their features: about 5,000 bytes a character


def test_many_notices_and_tags_in_one_text(spark):
    n = 20_000
    rows = [(1, "MIT License, Apache License Version 2.0; " * n, None, None, 0),
            (2, "SPDX-License-Identifier: (MIT OR ISC) é; " * n, None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    before = time.time()
    got = {r.doc_id: r for r in license_scan.licences(df).collect()}
    assert time.time() - before < 60
    assert got[1].labels == "apache-2.0,mit" and len(got[1].spans) == 2 * n
    assert got[2].labels == "isc,mit" and got[2].expressions == ["(MIT OR ISC)"] * n
    text = rows[1][1]
    assert all(text[s.start:s.end] == "SPDX-License-Identifier: (MIT OR ISC)" for s in got[2].spans)


@pytest.mark.parametrize("seed", range(20))
def test_overlapping_notices_by_the_plain_rule(seed):
    rng = random.Random(seed)
    notices = [(s, s + rng.randrange(1, 7), "x") for s in rng.choices(range(40), k=30)]
    kept: list = []
    for s, e, v in sorted(notices, key=lambda x: (x[0] - x[1], x[0])):
        if all(e <= a or s >= b for a, b, _ in kept):
            kept.append((s, e, v))
    assert license_scan._longest(notices) == kept
