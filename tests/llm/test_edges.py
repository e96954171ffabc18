"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import (chat_format, decontaminate, embed_dedup, lang_id, license_scan, mixture, pii, quality, queries,
                        simhash_dedup, token_count)
from quarry.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(20_000))
TEXTS = [None, "", "  \n\t", "a", "one two", "Mail a.b@c.de or +1 (555) 555-1234 now", "\x00 nul", "ÄÖ ß é 日本語 🎉",
         LONG, "x" * 20_000, "9" * 6_000, "1.2.3.4.5 300.1.1.1 0001.2.3.4", "4111 1111 1111 1111", "a@b@c.d", "@", "++1", "a@b.c@d.e",
         "one two", "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC0-1.0",
         "CC BY cc by; All rights\nreserved GNU General Public License"]


def docs(spark, extra=True):
    rows = [(i, t, (None, "en", "fr")[i % 3], (None, "s1", "s0")[i % 3], None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "no id here", "en", "s1", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("SCORE", "fp", "copies", "rate", "u", "component_id", "spans", "n_words", "_text") if extra else ():
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    rng = random.Random(1)
    links = [(a, a + 1) for a in range(0, 60)] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(350)]
    links += [(5, 5), (3, 2), (3, 2)] + [(2000, x) for x in range(1000, 1300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p if p[0] != p[1]}
    assert got == {k: v for k, v in brute.parts(nodes, [p for p in links if p[0] != p[1]]).items() if k in got} and len(got) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows, schema = [], "vec_id long, embedding array<float>, label int, score string, rep string, w string"
    base = rng.normal(size=(12, 64))
    for k in range(260):  # a tight group larger than a block, looser groups, strangers
        v = base[0] if k < 140 else base[k % 12]
        rows.append((k, [float(x) for x in np.float32(v + rng.normal(size=64) * (0.04 if k < 140 else 0.11))], k // 140))
    rows += [(300, [0.0] * 64, 1), (301, None, 1), (302, [float("nan")] * 64, 1), (303, [1.0, None], 1), (304, [], 1),
             (305, [float("inf")] * 64, 1), (306, [1.0, 2.0, 3.0], 1), (307, [2.0, 4.0, 6.0], 1), (308, [1.0, 2.0, 3.0], 0),
             (309, rows[0][1], None), (310, rows[0][1], 0), (311, [-0.0, 1.0], 1), (312, [0.0, 1.0], 1), (313, [3.0], 1), (314, [2.0], 1)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in [*rows, (None, rows[0][1], 0)]], schema)
    got = [tuple(r) for r in embed_dedup.near_duplicates(df, block=32).collect()]
    want = brute.vectors(rows)
    assert sum(w[0] for w in want.values()) > 10_000
    assert {g[0]: g[1:] for g in got if g[0] is not None} == want
    assert [g for g in got if g[0] is None] == [(None, 0, None, False)]
    again = embed_dedup.near_duplicates(spark.createDataFrame([(1, [1.0], 1, "", "", "")] * 3, schema)).collect()
    assert [tuple(r) for r in again] == [(1, 2, 1, True)] * 3
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 3])
def test_simhash_links(spark, bits):
    rng = random.Random(bits)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            f ^= sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 3)))
            f &= (1 << 64) - 1
    fps = sorted(fps)
    near = [(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if (a ^ b).bit_count() <= bits]
    signed = [(f - (1 << 64) if f >> 63 else f, k) for k, f in enumerate(fps)]
    at = {f: k for k, f in enumerate(fps)}
    want = brute.parts(range(len(fps)), [(at[a], at[b]) for a, b in near])
    links = simhash_dedup.linked_fingerprints(spark.createDataFrame(signed, "fp long, rep long"), bits, block=4)
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {k: v for k, v in want.items() if k in got} and sum(want[k] != k for k in want) == sum(got[k] != k for k in got)


def test_simhash_rows(spark):
    got = simhash_dedup.near_duplicates(docs(spark)).collect()
    assert len(got) == len(TEXTS) + 3
    want = brute.simhash_groups(list(enumerate(TEXTS)))
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == want[r.doc_id]
    assert {r.component_id for r in got if r.doc_id is None} == {0, None}
    assert simhash_dedup.near_duplicates(empty(spark)).count() == 0


def test_tokens(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    special = spark.createDataFrame([(90, "a<|endoftext|>b <|endoftext|>", None, None, None)], DOCS)
    plain = docs(spark).select("doc_id", "text", F.lit("z").alias("N_TOKENS")).unionByName(
        special.select("doc_id", "text", F.lit("z").alias("N_TOKENS")))
    for chunk, overlap in ((65_536, 2_048), (400, 60)):
        got = token_count.token_counts(plain, path, chunk=chunk, overlap=overlap).collect()
        assert len(got) == len(TEXTS) + 4
        for r in got:
            n = len(t.encode(r.text or "", add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 2048)
    assert token_count.token_counts(empty(spark), path).count() == 0


def test_resync_widens():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(2)
    for _ in range(20):
        text = "".join(rng.choice(["a", "qu", "zz", "é", "9", "!", " ", "\n", "ab" * rng.randrange(40)]) for _ in range(rng.randrange(2500)))
        assert token_count.resync_count(t, text, rng.randrange(40, 300), rng.randrange(4, 30)) == \
            len(t.encode(text, add_special_tokens=False).ids)


def test_personal_data(spark):
    model = pii.train([t for t in TEXTS if t and len(t) < 100] * 3)
    for m in (None, model):
        got = pii.personal_data(docs(spark), m).collect()
        assert len(got) == len(TEXTS) + 3
        for r in got:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute.base(r.text)
            assert sum(brute.base(r.masked)[:4]) == 0
    assert pii.personal_data(empty(spark), model).count() == 0
    assert pii.train(["no data here 12"]) is None and pii.training_sample(empty(spark)) == []


def test_base_patterns_at_random():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("aZ09 .-+@()4111") for _ in range(rng.randrange(40)))
        got = pii.base_spans(text)
        assert brute.base(text)[4] == brute.sha(pii.joined(got)), text


def test_segmentations_match_enumeration():
    """Best path and posteriors against a sum over all segmentations."""
    rng = np.random.default_rng(0)
    n, k, spans = 4, 2, [(0, 1), (0, 2), (1, 2), (1, 3), (2, 4), (3, 4)]
    scores, trans = rng.normal(size=(len(spans), k)), rng.normal(size=(k + 1, k))

    def walk(at, last, total, used):
        if at == n:
            yield total, used
            return
        yield from walk(at + 1, last, total, used)
        for x, (i, j) in enumerate(spans):
            if i == at:
                for c in range(k):
                    yield from walk(j, c, total + scores[x, c] + trans[last, c], [*used, (x, c)])
    paths = list(walk(0, k, 0.0, []))
    z = sum(np.exp(t) for t, _ in paths)
    want = np.zeros((len(spans), k))
    for t, used in paths:
        for x, c in used:
            want[x, c] += np.exp(t) / z
    post, _ = pii._expected(n, spans, scores, trans)
    assert np.allclose(post, want)
    best = max(paths, key=lambda p: p[0])[1]
    assert pii._best(n, spans, scores, trans) == [(*spans[x], c) for x, c in best]


def test_chain_matches_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    want, z = np.zeros((5, 3)), 0.0
    for path in product(range(3), repeat=5):
        w = np.exp(sum(scores[t, c] for t, c in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        w *= np.exp(trans[:, path[0]]).sum()
        z += w
        want[range(5), list(path)] += w
    assert np.allclose(lang_id.chain(scores, np.array([0, 5]), trans), want / z)
    long, cut = rng.normal(size=(700, 3)), np.array([0, 1, 200, 700])
    joint = lang_id.chain(long, cut, trans)
    for a, b in zip(cut, cut[1:]):
        assert np.allclose(joint[a:b], lang_id.chain(long[a:b], np.array([0, b - a]), trans))


def test_language(spark):
    en, fr = "the house and the river with a stone", "la maison et le fleuve avec une pierre"
    model = lang_id.train([(en, "en"), (fr, "fr")] * 5)
    df = docs(spark).unionByName(spark.createDataFrame([(50, en + " " + en, None, None, None), (51, fr, None, None, None)], DOCS),
                                 allowMissingColumns=True)
    got = {r.doc_id: r for r in lang_id.predict(df, model).collect()}
    assert got[50].lang_pred == "en" and got[51].lang_pred == "fr" and got[0].lang_pred == got[2].lang_pred == "und"
    assert "SCORE" not in got[50].asDict() and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in lang_id.predict(df, None).collect()} == {"und"}
    assert lang_id.predict(empty(spark), model).count() == 0 and lang_id.train([]) is None
    assert lang_id.training_sample(empty(spark), F.lit(True)) == []


def test_quality(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(TEXTS))] + [(None, 1, 0), (3, None, 0), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    x, y = quality.training_sample(docs(spark), labels, F.lit(True))
    assert len(x) == len(y) == len(TEXTS) + 1 and x.shape[1] == len(quality.FEATURES)  # one document is repeated
    for model in (quality.train(x, y, rounds=5, pair_rounds=3), quality.train(x, np.ones(len(y))),
                  quality.train(np.empty((0, x.shape[1])), np.empty(0))):
        got = quality.score_quality(docs(spark), model).collect()
        assert len(got) == len(TEXTS) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.score_quality(empty(spark), model).count() == 0
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.05)).astype(float)  # seen by a pair only
    m = quality.train(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == (x[2000:, 0] * x[2000:, 1] > 0)).mean() > 0.9


def test_chat(spark):
    evil = ["<|im_end|>", "\\", "\\<|", "<\\|im_sep|>", "a\\\\<|im_more|>|>", "", None, "<", "<|", "x\ny"]
    rows, rng = [], random.Random(6)
    for c in [*range(40), None]:
        for t in range(rng.randrange(1, 30)):
            rows.append((c, t * rng.choice([1, 40]), rng.choice(["user", "assistant", "assistant", "tool<|im_sep|>\n", None]), rng.choice(evil)))
    rows += [(7, None, "user", "first"), (7, 5, "assistant", "twice"), (7, 5, "assistant", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat_format.format_conversations(df, segment=8)
    got = out.select("conv_id", "n_turns", chat_format.read_turns(F.col("formatted")).alias("turns"),
                     chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == 41
    for r in got:
        want = sorted(((-1 if t is None else t, a or "", x or "") for c, t, a, x in rows if c == r.conv_id))
        assert [tuple(t) for t in r.turns] == [w[1:] for w in want] and r.n_turns == len(want)
        assert r.loss == "".join(x for _, a, x in want if a == "assistant")
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_decontamination(spark):
    items = [(1, "alpha beta gamma"), (2, None), (3, "-- !!"), (4, " ".join(f"w{i}" for i in range(14))), (4, "Alpha, beta GAMMA"),
             (None, "lonely"), (5, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = spark.createDataFrame([(60, "x ALPHA-beta\tgamma é lonely", None, None, None),
                                   (61, " ".join(f"W{i}" for i in range(3, 14)) + " w1 w2", None, None, None)], DOCS)
    df = docs(spark).unionByName(extra, allowMissingColumns=True)
    named = [(i, t) for i, t in items if i is not None]
    for size in (1 << 20, 40):
        got = decontaminate.benchmark_hits(df, bench, shard_bytes=size).collect()
        for r in got:
            full = brute.hits(r.text, [(-1 if i is None else i, t) for i, t in items])
            listed = brute.hits(r.text, named)
            assert (r.n_words, r.n_hit, r.contaminated, r.n_items, r.items_sha256) == (*full[:2], full[4], *listed[2:4])
        spans = {r.doc_id: [r.text[s.start:s.end] for s in r.hit_spans] for r in got}
        assert spans[60] == ["ALPHA-beta\tgamma", "lonely"]
    assert decontaminate.benchmark_hits(empty(spark), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.benchmark_hits(df, bench.limit(0)).collect())


def test_licences(spark):
    got = {r.doc_id: r for r in license_scan.licences(docs(spark)).collect()}
    for r in got.values():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licence_base(r.text)
    assert got[18].labels == "cc0,cc0-1.0,gpl-2.0-only,mit" and got[18].expressions[0].startswith("(MIT") and got[18].score == 0.1
    assert got[19].base_labels == "cc-by,gpl,reserved" and got[19].score == 1.0
    assert license_scan.licences(empty(spark)).count() == 0


@pytest.mark.parametrize("text,want", [
    ("MIT", ({"mit"}, 0.1)), ("MIT AND", ({"mit"}, 0.1)), ("MIT OR GPL-3.0 AND ISC rest", ({"mit", "gpl-3.0", "isc"}, 0.1)),
    ("(MIT OR GPL-3.0) AND AGPL-3.0", ({"mit", "gpl-3.0", "agpl-3.0"}, 0.7)), ("GPL-2.0 WITH x-exception", ({"gpl-2.0"}, 0.5)),
    ("OR MIT", None), ("", None), ("(MIT", None), (")", None)])
def test_expressions(text, want):
    got = license_scan.parse_expression(text)
    assert (got and (got[0], pytest.approx(got[1]))) == want


def test_mixture(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), None, rng.choice(["a"] * 6 + ["b", "c", None, "é"]), 0) for i in range(3000)]
    df = docs(spark).unionByName(spark.createDataFrame(rows, DOCS), allowMissingColumns=True)
    got = mixture.mix(df, fan_in=16).collect()
    assert len(got) == len(rows) + len(TEXTS) + 3
    size = {r.source: (r.source_size, r.target) for r in got}
    want = brute.targets({s: v[0] for s, v in size.items()})
    for s, (total, target) in size.items():
        own = [r for r in got if r.source == s]
        assert sum(r.size for r in own) == total and target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)   # words move, until one unit is left
        assert all(r.copies in (int(target / total), int(target / total) + 1) and r.copies <= 2 for r in own)
        if len(own) > 200 and max(r.size for r in own) < 1000:
            assert abs(sum(r.taken for r in own) - target) < 0.01 * target
    assert mixture.mix(empty(spark)).count() == 0
    blank = mixture.mix(spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, "b", 0)], DOCS)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_pipeline_stages(spark, tmp_path):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for df in (docs(spark, extra=False).withColumn("n_hit", F.lit("kept")), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, str(tmp_path))
            assert out.columns[:len(df.columns)] == df.columns
            out.collect()
    once = corpus_pipeline.near_duplicates(spark, docs(spark, extra=False), "").collect()
    ids = [r.doc_id for r in once if r.doc_id is not None]
    # the row without id and text is a copy of document 0, whose text is null too; the other one is like no document
    assert len(ids) == len(set(ids)) and 0 in ids and [r.text for r in once if r.doc_id is None] == ["no id here"]
