"""The registered queries: equal to their check SQL, or to a brute-force version of the whole table."""

import hashlib
import re
import zlib

import __spark_entry__ as entry
import numpy as np
import pandas as pd
import pytest
import xxhash
from compare import difference
from touchline.llm.queries import ORACLE_SQL, QUERIES

NATIVE = {"op1_chat_formatting", "op6_source_mix", "op10_url_filter"}


def read(sf, name):
    return pd.read_parquet(f"{sf}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(name, spark, sf, con):
    assert difference(entry.queries()[name](spark, sf), con, ORACLE_SQL[name]) is None


def test_all_operators_and_the_pipeline():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native(name, spark, sf):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_op5_counts_as_the_library(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = read(sf, "documents")
    got = entry.queries()["op5_token_counts"](spark, sf).toPandas().set_index("doc_id")
    want = [len(e) for e in tokenizer.encode_batch(list(docs.text), add_special_tokens=False)]
    assert list(got.n_tokens.reindex(docs.doc_id)) == want
    assert list(got.n_bytes.reindex(docs.doc_id)) == [len(t.encode()) for t in docs.text]
    assert (got.over_limit == (got.n_tokens > 1024)).all()


def test_op6_meets_its_targets(spark, sf):
    docs = read(sf, "documents")
    run = entry.queries()["op6_source_mix"]
    got = run(spark, sf).toPandas()
    assert got.sort_values("doc_id").equals(run(spark, sf).toPandas().sort_values("doc_id")) or \
        set(map(tuple, got.values)) == set(map(tuple, run(spark, sf).toPandas().values))
    docs["size"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in docs.text]
    assert dict(zip(got.doc_id, got["size"])) == dict(zip(docs.doc_id, docs["size"]))
    sizes = docs.groupby("source")["size"].sum()
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes.index))}
    left, target = 1.5 * sizes.sum(), {}
    while True:  # deal by weight, stop what is above, deal the rest again
        free = {s: w for s, w in weights.items() if s not in target}
        level = left / sum(free.values())
        above = [s for s in free if level * free[s] > 2 * sizes[s]]
        if not above:
            break
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
    target |= {s: level * w for s, w in weights.items() if s not in target}
    per = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"), largest=("size", "max"))
    for s, r in per.iterrows():
        assert r.target == pytest.approx(target[s]) and r["size"] == sizes[s]
        assert abs(r.taken - r.target) <= r.largest / 2 + 1
    assert (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].clip(lower=1) == 0).all()


def test_op7_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op7_quality_classifier"](spark, sf).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(read(sf, "labels"), on="doc_id")
    assert (held.predicted == held.quality).mean() >= 0.97


def test_op8_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op8_language_id"](spark, sf).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(read(sf, "documents"), on="doc_id")
    assert (held.lang_pred == held.lang).mean() >= 0.99 and held.score.between(0, 1).all()


def fingerprints(texts):
    """SimHash of each text, shingle by shingle."""
    lower, prints = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        runs = [" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return prints


def fingerprint_groups(texts):
    """Smallest id reachable over fingerprints at most four bits apart, all pairs compared."""
    prints = fingerprints(texts)
    ids = sorted(prints)
    v, label = np.array([prints[i] for i in ids], np.uint64), np.arange(len(ids))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= 4) for x in v]
    for _ in ids:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    return {i: ids[k] for i, k in zip(ids, label)}


def test_op9_equals_brute_force(spark, sf):
    docs = read(sf, "documents")
    texts = dict(zip(docs.doc_id, docs.text))
    got = entry.queries()["op9_simhash_dedup"](spark, sf).toPandas().set_index("doc_id")
    assert got.fingerprint.to_dict() == {i: f"{p:016x}" for i, p in fingerprints(texts).items()}
    assert got.component_id.to_dict() == fingerprint_groups(texts)


def phrases(text):
    """LZ78 phrases of the bytes of a text, one byte at a time."""
    seen, open_ = set(), b""
    for b in text.encode():
        open_ += bytes([b])
        if open_ not in seen:
            seen.add(open_)
            open_ = b""
    return seen


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def test_op12_equals_brute_force(spark, sf):
    docs = read(sf, "documents").sort_values("doc_id").reset_index(drop=True)
    got = entry.queries()["op12_lempel_ziv_fingerprints"](spark, sf).toPandas().set_index("doc_id")
    assert sorted(got.index) == list(docs.doc_id)
    apart = []
    for k, (i, t) in enumerate(zip(docs.doc_id, docs.text)):
        after, r = docs.text[(k + 1) % len(docs)], got.loc[i]
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == lempel_print(t) and r.edited_fingerprint == lempel_print(edited)
        apart += [r.near_edited - jaccard(phrases(t), phrases(edited)), r.near_next - jaccard(phrases(t), phrases(after))]
    # 64 hashes tell a share to a standard error of 0.06 at most
    assert np.abs(apart).max() < 0.25 and np.std(apart) < 0.06 and abs(np.mean(apart)) < 0.01
    assert (got.near_edited > got.near_next).mean() > 0.98
    assert len(set(zip(docs.text, got.fingerprint.reindex(docs.doc_id)))) == docs.text.nunique()


def lempel_print(text):
    from touchline.llm import lempel

    tree = {}
    lempel.read_phrases(text.encode(), tree)
    assert len(tree) == len(phrases(text))
    return lempel.packed(lempel.smallest(lempel.phrase_hashes([tree])[0])).hex()


def runs_of(words, least=12):
    """Runs by comparing the words with themselves at every distance."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x, out = np.array([number[w] for w in words], int), {}
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], x[q:] == x[:-q], [0]]).astype(int)
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s + q >= max(least, 2 * q):
                out.setdefault((s, e + q), q)  # the smallest period comes first
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_op13_equals_brute_force(spark, sf):
    docs = read(sf, "documents")
    got = entry.queries()["op13_periodic_runs"](spark, sf).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    total = 0
    for i, t in zip(docs.doc_id, docs.text):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found, r = runs_of(words), got.loc[i]
        total += len(found)
        gone = {k for s, m, q in found for k in range(s + q, s + m)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert r.n_runs == len(found)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if found:
            s, m, q = min(found, key=lambda f: (-f[1], f[0], f[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, q, 1000 * m // q)
        else:
            assert pd.isna(r.start) and pd.isna(r.length) and pd.isna(r.period) and pd.isna(r.exponent_milli)
    assert total > 15
