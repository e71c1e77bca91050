"""Periodic runs: extensions and runs against brute force, and the awkward texts."""

import re

import numpy as np
import pytest
from llm_texts import DOCS, HARD, docs
from test_llm_queries import runs_of
from touchline.llm import runs as R


@pytest.mark.parametrize("v", sorted(R.COVERS))
def test_covers_and_extensions(v):
    assert sorted((a - b) % v for a in R.COVERS[v] for b in R.COVERS[v] if a != b) == list(range(1, v))
    rng = np.random.default_rng(v)
    texts = [np.tile(rng.integers(0, 3, p), 200 // p + 1)[:n] for p, n in ((1, 150), (7, 200), (60, 190))] + [rng.integers(0, 2, n) for n in (0, 1, 90)]
    seq, owner = [], []
    for r, t in enumerate(texts):
        seq += [*t.tolist(), -1 - r]
        owner += [r] * (len(t) + 1)
    lce = R.CoverLce(np.array(seq), np.array(owner), v)
    pairs = [(i, j) for i in range(len(seq)) for j in range(i + 1, len(seq), 5) if owner[i] == owner[j]]
    i, j = (np.array([p[k] for p in pairs]) for k in (0, 1))
    for a, b, n in zip(i.tolist(), j.tolist(), lce.lengths(i, j).tolist()):
        assert seq[a:a + n] == seq[b:b + n] and seq[a + n] != seq[b + n]


@pytest.mark.parametrize("v", [7, 21])
def test_runs_against_brute_force(v):
    rng = np.random.default_rng(10 + v)
    for _ in range(60):
        texts = []
        for _ in range(rng.integers(0, 6)):
            n, k = int(rng.integers(0, 130)), int(rng.integers(1, 4))
            t = rng.integers(0, k, n)
            if n and rng.random() < 0.6:
                a, p = int(rng.integers(0, n)), int(rng.integers(1, n + 1))
                t = np.array([t[i] if i < a else t[min(n - 1, a + (i - a) % p)] for i in range(n)])
            texts.append(t)
        first = np.cumsum([0] + [len(t) for t in texts])
        codes = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64)
        found = list(zip(*(x.tolist() for x in R.word_runs(codes, first, 12, v, points=50))))
        assert found == [(r, *f) for r, t in enumerate(texts) for f in runs_of(t.tolist())]


def test_find_runs_on_hard_texts(spark):
    rows = HARD + [(8, "again and " * 9 + "again", "p"), (9, "x " * 50_000, None), (9, "x " * 50_000, None), (10, "a\u00a0b " * 12, "q")]
    got = R.find_runs(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_text = {r.text: r for r in got}
    for i, t, s in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        r = by_text[t]
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == runs_of(words)
        assert r.n_words == len(words) and r.size == "x" and r.items == "z"
    assert by_text["x " * 50_000].collapsed == "x" and [tuple(x) for x in by_text["x " * 50_000].runs] == [(0, 50_000, 1)]
    # 60 000 words of period 977, once with a word after them
    assert [tuple(x) for x in by_text[HARD[5][1]].runs] == [(0, 60_000, 977)]
    assert by_text[HARD[6][1]].collapsed.split() == [f"w{i}" for i in range(977)] + ["end"]
    assert by_text["again and " * 9 + "again"].collapsed == "again and"
    assert by_text[None].runs == [] and by_text[None].collapsed == "" and by_text["   \n "].collapsed == ""
    empty = R.find_runs(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and set(empty.columns) == {"doc_id", "text", "source", "lang", "size", "score", "items", "p", "m_u", "n_words", "runs", "collapsed"}
    clash = spark.createDataFrame([("u " * 20, 1, "x", 5, "c")], "text string, doc_id int, runs string, n_words int, collapsed string")
    row = R.find_runs(clash).first()
    assert [tuple(x) for x in row.runs] == [(0, 20, 1)] and row.collapsed == "u" and row.n_words == 20
