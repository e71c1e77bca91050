"""Lempel-Ziv fingerprints: phrases, likeness, edits and the order of documents against brute force."""

import hashlib
import random

import pytest
from llm_texts import DOCS, HARD, docs
from test_llm_queries import jaccard, lempel_print, phrases
from touchline.llm import lempel as Z


def test_phrases_and_hashes():
    rng = random.Random(4)
    texts = ["", "a", "a" * 3000, "ab" * 500, "\u00e9\U0001f600" * 40] + ["".join(rng.choice("ab ") for _ in range(rng.randrange(200))) for _ in range(60)]
    trees = []
    for t in texts:
        whole, parts = {}, {}
        Z.read_phrases(t.encode(), whole)
        cut = rng.randrange(len(t.encode()) + 1)
        Z.read_phrases(t.encode()[cut:], parts, Z.read_phrases(t.encode()[:cut], parts))
        assert whole == parts and len(whole) == len(phrases(t))
        trees.append(whole)
    together = Z.phrase_hashes(trees)
    for tree, h in zip(trees, together):
        alone = Z.phrase_hashes([tree])[0]
        assert (alone == h).all() and len(set(h.tolist())) == len(h)
        some = len(h) // 2  # the first hashes may be known
        assert (Z.phrase_hashes([tree], [h[:some]])[0] == h).all()
    # equal phrases have equal hashes, whatever else their text holds
    for x, hx in zip(texts, together):
        for y, hy in zip(texts, together):
            assert len(set(hx.tolist()) & set(hy.tolist())) == len(phrases(x) & phrases(y))


def test_likeness_is_exact_for_short_texts():
    for a, b in (("", ""), ("", "a"), ("abcabc", "abcabd"), ("some words", "some other words"), ("xyz", "pqr")):
        assert Z.likeness(lempel_print(a), lempel_print(b)) == pytest.approx(jaccard(phrases(a), phrases(b)))


def test_fingerprints_on_hard_texts(spark):
    got = Z.fingerprints(docs(spark, HARD)).collect()
    assert len(got) == len(HARD)
    for r in got:
        assert r.fingerprint == lempel_print(r.text or "") and r.size == "x" and r.n_words == 5
    assert Z.fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    clash = Z.fingerprints(spark.createDataFrame([("a", 1)], "text string, fingerprint int"))
    assert clash.columns == ["text", "fingerprint"] and clash.first().fingerprint == lempel_print("a")


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_edits_against_brute_force(spark, parts):
    rows = HARD + [(k, "no id comes before, number", "p") for k in (None, None)] + [(20 + k, "word " * k + "\u00e9nd", "q") for k in range(12)]
    rows += [(50, "twice", "p")] * 3 + [(50, "thrice", "p"), (-1, "negative", "p")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = Z.compare_edits(docs(spark, rows).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    # rows of one id follow by hash: take their order from the result, the rest by brute force
    hashes = {r[0]: r[1] for r in docs(spark, rows).selectExpr("coalesce(text, '')", "xxhash64(text)").collect()}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1] or ""]))
    want = []
    for k, (i, t, _) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        a, e, n = lempel_print(t), lempel_print(edited), lempel_print(after)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, e, Z.likeness(a, e), Z.likeness(a, n)))
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_one_document_and_none(spark):
    one = Z.compare_edits(docs(spark, [(1, "abcdefgh", "p")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    assert Z.compare_edits(spark.createDataFrame([], DOCS)).count() == 0
