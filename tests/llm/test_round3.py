"""Divergence, fill-in-middle and suffix-array dedup against plain versions, on the tables and on edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quarry.llm import divergence, fill_middle, queries as Q, suffix_dedup, suffix_merge

DOCS = "doc_id long, text string, lang string, source string"


def plain_repeats(texts, length):
    """(bytes, removed, runs, digest) per text, by a count of every string."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(c for c, g in zip(r, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(r), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def found_repeats(df):
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()]


def test_op13(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    want = dict(zip([d for d, _ in docs], plain_repeats([t for _, t in docs], 200)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in Q.op13_suffix_dedup(spark, SF_SMALL).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 10_000


@pytest.mark.parametrize("shard", [1 << 16, 16])
def test_merged_transforms(monkeypatch, shard):
    monkeypatch.setattr(suffix_merge, "SHARD", shard)
    rng = random.Random(shard)
    for trial in range(200):
        units = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(2)]
        records = [b"".join(rng.choice(units) * rng.randrange(5) for _ in range(3)) if trial % 2 else
                   bytes(rng.choice(b"ab") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 7))]
        length = rng.choice([8, 16, 24])
        seen = Counter(r[i:i + length] for r in records for i in range(len(r) - length + 1))
        want = sorted((j, i) for j, r in enumerate(records) for i in range(len(r) - length + 1) if seen[r[i:i + length]] > 1)
        record, start = suffix_merge.repeated_strings(records, length)
        assert sorted(zip(record.tolist(), start.tolist())) == want


def test_suffix_edges(spark):
    """Nulls, empty and short texts, periods, repeats inside a text, non-ASCII cuts, repeated rows, null ids, clashing
    names; with a limit of one content per anchor, so that every shared anchor is split down to whole strings."""
    rng = random.Random(3)
    words = ["río", "ñandú", "grün", "日本", "alpha", "beta", "gamma"]
    line = " ".join(rng.choice(words) for _ in range(12))
    prose = [" ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(40)) for _ in range(6)]
    texts = [None, "", "short", "a" * 500, "ab" * 300, "xyz" * 400 + prose[0], prose[0], prose[0], prose[0][7:] + "!",
             prose[1] + line + prose[2], prose[3] + line + prose[4], prose[5] + prose[5], "é" + prose[1], line]
    rows = [(None if i % 5 == 0 else i // 2, t, i, float(i), "h") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, u int, N_Bytes double, t string")
    for limit in (1024, 1):
        out = suffix_dedup.repeated_passages(df, length=64, anchor=16, limit=limit).orderBy("u")
        assert out.columns == ["doc_id", "text", "u", "t", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        got = out.collect()
        assert [r["text"] for r in got] == texts and [r["doc_id"] for r in got] == [r[0] for r in rows]
        assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == plain_repeats(texts, 64)
        for r in got:
            gone = b"".join((r["text"] or "").encode()[s["start"]:s["end"]] for s in r["spans"])
            assert len(gone) == r["n_removed"] and len(r["kept"]) + len(gone) == r["n_bytes"]
    empty = suffix_dedup.repeated_passages(df.filter("false"), length=64, anchor=16)
    assert empty.count() == 0 and "kept" in empty.columns
    with pytest.raises(ValueError):
        suffix_dedup.repeated_passages(df, length=65)


def test_long_text_steps(spark, monkeypatch):
    """Texts over the step of the anchor search, cut into steps, and a long period."""
    rng = random.Random(4)
    noise = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = [noise, "q" * 3000, noise[500:2500] + "z" * 700, "0123456789" * 200]
    search = suffix_dedup.AnchorSearch(64, 16)
    whole = search.records([t.encode() for t in texts])
    assert len(whole[0]) < 800  # the periods are few records
    monkeypatch.setattr(suffix_dedup, "STEP", 500)
    for got in (whole, search.records([t.encode() for t in texts])):
        strings = sorted((int(i), int(s) + k) for i, s, w, _, _, times in zip(*got) for k in range(w * times))
        assert strings == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 63)]


def plain_fill(doc_id, text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return len(lines), "spm" if h[3] % 100 < 50 else "psm", len(p), len(m), out


def test_op12_edges(spark):
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "<P>\nx", "x<S", "é\nñ\n日本\n", "\r\n\x0b\n", "\n" * 5000,
             "long " * 50_000, *("".join(rng.choice("ab\né日") for _ in range(rng.randrange(60))) for _ in range(300))]
    rows = [(None if i % 7 == 0 else i // 2, t, i, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, i int, Form string")
    out = fill_middle.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "i", "n", "form", "prefix_chars", "middle_chars", "output"]
    out = out.withColumn("back", fill_middle.restored(F.col("form"), F.col("output"))).orderBy("i").collect()
    for r, (doc_id, text, _, _) in zip(out, rows):
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_fill(doc_id, text or "")
        assert r["back"] == (text or "") and r["text"] == text
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(df.filter("false")).count() == 0


def plain_divergence(rows, min_docs, top):
    table, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
        table[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang in {k for k, _ in table}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (k, s), c in table.items() if k == lang}

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}
        own = {s: p(c) for s, c in groups.items()}
        q = p(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            raised = [(q[t] - own[s][t], t.encode(), t) for t in kept if groups[s][t] and own[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(raised)[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)}
    return out


def test_op11_edges(spark):
    rng = random.Random(6)
    words = ["Árbol", "tree", "Tree", "x1y", "ünder", "fox", "OX", "日本"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(12))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", None]))
            for _ in range(120)] + [(None, "fr", "only"), ("", "fr", "other"), ("...", "zz", "alone"), ("fox " * 3000, "en", "b")]
    df = spark.createDataFrame([(*r, i, "v") for i, r in enumerate(rows)], "text string, lang string, source string, g int, term string")
    for block, band, held in ((200_000, 256, 400_000), (3, 2, 1)):
        got = divergence.source_divergence(df, min_docs=10, top=3, block=block, band=band, held=held).collect()
        assert {tuple(r) for r in got} == plain_divergence(rows, 10, 3) and len(got) == len({tuple(r) for r in got})
    assert divergence.source_divergence(df.filter("false")).count() == 0


@pytest.mark.parametrize("name", ["op11_divergence", "op12_fill_in_middle", "op13_suffix_dedup"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = con.execute(Q.oracles()[name])
    cols = sorted(d[0] for d in want.description)
    at = [d[0] for d in want.description]
    want = Counter(tuple(r[at.index(c)] for c in cols) for r in want.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in Q.queries()[name](spark, SF_SMALL).collect()) == want
