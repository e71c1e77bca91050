"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from llm_texts import DOCS, HARD, LONG, docs
from touchline.llm import chat, common, decontamination, embeddings, fmindex, langid, quality, sampling, simhash, substrings, tokens, urls
from touchline.llm import words as W


# --- words ------------------------------------------------------------------------------------------

def test_words_as_the_pattern():
    import pyarrow as pa

    texts = [t for _, t, _ in HARD] + ["", "x", " y", "z "]
    w = W.find_words(pa.array(texts, pa.string()))
    got = [[w.buf[w.start[k]:w.end[k]].tobytes().decode() for k in range(w.first[r], w.first[r + 1])] for r in range(len(texts))]
    assert got == [re.findall(common.WORD, t or "") for t in texts]
    h = W.word_hashes(w)
    flat = [x for g in got for x in g]
    assert len(set(h.tolist())) == len(set(flat))
    for n in (1, 3, 10, 20):
        seen = {}
        for i, x in enumerate(W.run_hashes(h, n).tolist()):
            assert seen.setdefault(x, flat[i:i + n]) == flat[i:i + n]


# --- chat -------------------------------------------------------------------------------------------

EVENTS = "conv_id bigint, seq bigint, message bigint, kind string, role string, text string"


def test_events_fold(spark):
    rows = [(1, 1, 1, "start", "user", "hi"), (1, 3, 2, "start", "assistant", None), (1, 5, 2, "delta", None, "b"), (1, 4, 2, "delta", None, "a"),
            (1, 6, 2, "regenerate", None, None), (1, 7, 2, None, None, "new"), (1, 8, 1, "edit", None, "hello"), (1, 9, 1, "delta", None, "!"),
            (1, 10, 3, "start", "user", "gone"), (1, 11, 3, "delete", None, None), (1, 12, 4, "noise", "user", "x"), (2, 1, 1, "start", None, "")]
    got = chat.fold_events(spark.createDataFrame(rows, EVENTS)).collect()
    assert {(r.conv_id, r.message, r.role, r.text) for r in got} == {(1, 1, "user", "hello!"), (1, 2, "assistant", "new"), (2, 1, None, "")}


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n<turn>### user\n", "\\b\\l\\h\\n \\", "", "\n", "<#\\", "\U0001f600" * 3, "x" * 200_000]
    turns = [(5, i, ["user", "assistant", "a\nb</turn>", None][i % 4], t) for i, t in enumerate(nasty)]
    turns += [(6, None, "assistant", None), (6, 1, "assistant", "twice"), (6, 1, "assistant", "twice"), (None, 1, "user", "no id")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.message_events(df))).collect()}
    assert set(got) == {5, 6, None}
    assert [(t.role, t.text) for t in got[5].turns] == [(r or "", t) for _, _, r, t in turns[:8]]
    assert got[5].loss_text == "".join(t for _, _, r, t in turns[:8] if r == "assistant")
    assert [t.text for t in got[6].turns] == ["", "twice", "twice"] and got[6].loss_text == "twicetwice"
    for s, t in zip(got[5].loss_spans, got[5].turns):
        assert (got[5].formatted[s.start:s.end] != "") == (t.role == "assistant" and t.text != "")
    assert chat.format_chats(chat.message_events(df.limit(0))).count() == 0


# --- embeddings -------------------------------------------------------------------------------------

def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 24))
    x[100:400] = x[0] + 0.05 * rng.standard_normal((300, 24))  # saturates every list
    x[400:410] = x[5] * np.arange(1, 11)[:, None]  # multiples of one vector
    x[410:600:2] = x[411:600:2] + 0.1 * rng.standard_normal((95, 24))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[7][1]) for i in range(5)] + [(1003, rows[7][1])]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [None] + [1.0] * 23), (2004, [float("nan")] * 24), (2005, [float("inf")] * 24), (2006, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as n", "'x' as id", "0 as component")
    got = embeddings.near_duplicates(df).collect()
    assert len(got) == len(rows) + len(odd)
    m = np.array([r[1] for r in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    ids = np.array([r[0] for r in rows])
    label = ids.copy()
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    want = sorted([(int(i), int(n.sum()) - 1, int(c), bool(i == c)) for i, n, c in zip(ids, near, label)] + [(i, 0, i, True) for i, _ in odd])
    assert sorted(map(tuple, got)) == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------------------------------

def test_fm_index_against_search():
    rng = np.random.default_rng(1)
    for size, n in ((3, 1), (4, 50), (5, 400), (40, 2000)):
        s = np.append(rng.integers(1, size, n), 0)
        index = fmindex.FMIndex(s, size)
        starts, lengths = rng.integers(0, n, 60), rng.integers(1, 6, 60)
        lengths = np.minimum(lengths, n - starts)
        lo, hi = index.search(s, starts, lengths)
        for a, k, x, y in zip(starts, lengths, lo, hi):
            want = [i for i in range(n) if tuple(s[i:i + k]) == tuple(s[a:a + k])]
            assert sorted(index.locate(np.arange(x, y)).tolist()) == want
        absent = index.search(np.array([size - 1] * 2000), np.array([0]), np.array([2000]))
        assert absent[0][0] >= absent[1][0]


BENCH = "item_id bigint, text string, extra string"


def test_decontamination_edges(spark, monkeypatch):
    ten = " ".join(f"t{i}" for i in range(12))
    bench = [(9, ten, "x"), (10, "Short phrase", "x"), (10, "short PHRASE", "x"), (11, None, "x"), (12, "..!", "x"), (None, "solo", "x")]
    rows = HARD + [(20, f"lead {ten} tail", "p"), (21, f"lead {ten[:-4]} other", "p"), (22, "a short, phrase; SOLO", "p"), (23, " ".join(ten.split()[:9]), "p"), (24, f"{ten} {ten}", "p")]
    df = docs(spark, rows)
    for block in (8 << 20, 8):  # one block of items, and several
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        out = decontamination.find_contamination(df, spark.createDataFrame(bench, BENCH), cut=True).collect()
        assert len(out) == len(rows)
        got = {r.doc_id: r for r in out}
        assert got[20]["items"] == ["9"] and got[20].text == "lead tail" and [tuple(h) for h in got[20].hits] == [(1, 13)]
        assert got[21]["items"] == ["9"] and got[21].text == "lead other"
        assert got[22]["items"] == ["", "10"] and [tuple(h) for h in got[22].hits] == [(1, 4)] and got[22].text == "a "
        assert got[23]["items"] == [] and got[23].text == rows[-2][1]
        assert got[24].text == "" and got[24].n_words == 24
        assert got[1].text is None and got[1].n_words == 0 and got[4].text == LONG
    none = decontamination.find_contamination(df, spark.createDataFrame([], BENCH)).collect()
    assert all(r["items"] == [] and r.hits == [] for r in none)
    assert decontamination.find_contamination(df.limit(0), spark.createDataFrame(bench, BENCH)).count() == 0


# --- substrings -------------------------------------------------------------------------------------

def repeats(rows, n):
    """Brute force: kept words and number of removed ones for each row."""
    first = {}
    low = lambda i: -1 << 63 if i is None else i
    split = [(low(i), re.findall(common.WORD, t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < (i, k):
                gone[k:k + n] = [True] * n
        out.append((None if i == -1 << 63 else i, " ".join(x for x, g in zip(w, gone) if not g), sum(gone)))
    return sorted(out, key=str)


def test_substrings_edges(spark):
    base = " ".join(f"b{i}" for i in range(50))
    rows = [(i, t, s) for i, t, s in HARD if t != LONG and t != LONG + " end"]
    rows += [(30, base, "p"), (29, f"x {base}\n y", "p"), (31, base, "p"), (31, base, "p"), (32, "a " * 300, "p"), (33, " a" * 100, "p"), (None, base, "p"), (34, f"{base}  {base}", "p"),
             (35, " ".join(base.split()[5:24]), "p")]
    rows += [(40, " ".join(f"w{i % 977}" for i in range(3000)), "q")]
    df = docs(spark, rows).repartition(3)
    out = substrings.remove_repeats(df).collect()
    got = sorted(((r.doc_id, " ".join(re.findall(common.WORD, r.text or "")), r.n_removed) for r in out), key=str)
    assert got == repeats([(i, t) for i, t, _ in rows], 20)
    assert all(sum(s.stop - s.first for s in r.removed) == r.n_removed for r in out)
    untouched = {r.doc_id: r.text for r in out if not r.n_removed}
    assert untouched[1] is None and untouched[7] == "   \n " and untouched[6] == HARD[7][1]
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_substrings_on_a_sample_of_windows_of_other_lengths(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = substrings.remove_repeats(spark.createDataFrame(rows), n=7).collect()
    got = sorted(((r.doc_id, " ".join(re.findall(common.WORD, r.text)), r.n_removed) for r in out), key=str)
    assert got == repeats([(r.doc_id, r.text) for r in rows], 7)


# --- tokens -----------------------------------------------------------------------------------------

def test_tokens_edges(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    extra = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "it's  we'll   x\r\n\r\n y\t", "\u2028\u3000 a\u0301 \u0bcd\u200d", "'s'S  ", "123\u00b2\u0664 \ud55c\uad6d", " " * 50]
    rows = HARD + [(50 + i, t, "p") for i, t in enumerate(extra)]
    with open(path, encoding="utf-8") as f:
        out = tokens.count_tokens(docs(spark, rows).selectExpr("*", "1 as n_tokens"), f.read()).collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted(((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in out), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out)


# --- sampling ---------------------------------------------------------------------------------------

def test_mix_edges(spark):
    rows = HARD + [(100 + i, "w " * (i % 37 + 1), "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    df = docs(spark, rows)
    weights = sampling.cycled_weights(df, (5.0, 2.0, 1.0))
    assert [r.source for r in weights.orderBy(weights.source.asc_nulls_last()).collect()] == ["hot", "p", "q", "s0", "s1", "s2", "s3", "s4", None]
    out = [r.asDict() for r in sampling.pareto_mix(df, weights).collect()]
    assert len(out) == len(rows) and all(0 <= r["copies"] <= 2 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r)
    for part in by.values():
        assert len({(r["source_size"], r["target"]) for r in part}) == 1
        taken, largest = sum(r["copies"] * r["size"] for r in part), max(r["size"] for r in part)
        assert abs(taken - part[0]["target"]) <= largest + 1 and part[0]["target"] <= 2 * part[0]["source_size"]
    assert sum(part[0]["target"] for part in by.values()) == pytest.approx(1.5 * sum(r["size"] for r in out))
    assert sampling.pareto_mix(df.limit(0), weights).count() == 0
    none = sampling.pareto_mix(docs(spark, [(1, None, "p"), (2, "", "q")]), weights).collect()
    assert [r["copies"] for r in none] == [0, 0]


# --- quality ----------------------------------------------------------------------------------------

def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 5, 8])
    u, step, start = rng.standard_normal(8) * 3, rng.standard_normal((2, 2)), rng.standard_normal(2)
    good, steps, firsts = quality.forward_backward(u, first, step, start)
    all_steps, all_first = np.zeros((2, 2)), np.zeros(2)
    for a, b in zip(first[:-1], first[1:]):
        if a == b:
            continue
        weight, total = np.zeros(b - a), 0.0
        local_steps, local_first = np.zeros((2, 2)), np.zeros(2)
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            s = start[y[0]] + sum(u[a + k] for k in range(b - a) if y[k]) + sum(step[p, q] for p, q in zip(y, y[1:]))
            p = np.exp(s)
            total += p
            weight += p * np.array(y)
            local_first[y[0]] += p
            for q, r in zip(y, y[1:]):
                local_steps[q, r] += p
        assert np.allclose(good[a:b], weight / total)
        all_steps, all_first = all_steps + local_steps / total, all_first + local_first / total
    assert np.allclose(steps, all_steps) and np.allclose(firsts, all_first)


def test_quality_edges(spark):
    good, bad = "A calm line of words.\nAnother one here.", "### *** $$$ ###\n!!! ### %%%"
    train = [(i, good if i % 2 else bad, "p") for i in range(40)]
    df = docs(spark, train + [(100 + (i or 0), t, s) for i, t, s in HARD] + [(None, good, "p"), (200, "\n\n", "p"), (201, bad, "p")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(1, 1, 0), (None, 1, 0), (2, None, 0), (999, 0, 0), (3, 7, 0)], "doc_id bigint, quality int, toxic int")
    field = quality.train(df, labels)
    out = quality.score(df, field).collect()
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r.score for r in out}
    assert got[201] < 0.3 < 0.7 < got[1] and got[101] == got[102] == got[200] == pytest.approx(field.prior)
    empty = quality.train(df.limit(0), labels)
    assert {r.score for r in quality.score(df, empty).collect()} == {0.5}
    assert quality.score(df.limit(0), field).count() == 0


# --- languages --------------------------------------------------------------------------------------

def test_language_edges(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(i, "der hund und die katze", "de") for i in range(5)] + [(1, None, "en"), (2, "x", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    df = docs(spark, HARD + [(300, "the THE dog", "p"), (301, "hundkatze", "p"), (302, "12 34 !", "p")])
    out = {r.doc_id: r for r in langid.predict(df.selectExpr("*", "1 as lang_pred"), model).collect()}
    assert (out[300].lang_pred, out[301].lang_pred) == ("en", "de")
    for i in (1, 2, 7, 302):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in out.values())
    untrained = langid.train(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in langid.predict(df, untrained).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


# --- simhash ----------------------------------------------------------------------------------------

def test_bit_sliced_labels_against_brute_force():
    rng = np.random.default_rng(4)
    for radius in (1, 3, 4, 9):
        base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
        f = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(6)] + [rng.integers(0, 2 ** 63, 200, dtype=np.uint64)])
        group = np.sort(rng.integers(0, 3, len(f)))
        every = np.ones(len(f), bool)
        got = simhash.close_labels(f, group, every, every, radius)
        label = np.arange(len(f))
        near = [np.flatnonzero((np.bitwise_count(f ^ x) <= radius) & (group == g)) for x, g in zip(f, group)]
        while True:
            new = np.array([label[n].min() for n in near])
            if (new == label).all():
                break
            label = new
        assert (got == label).all()


def test_links_do_not_depend_on_how_a_hot_key_is_dealt(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 3, dtype=np.int64)
    f = sorted({int(b) ^ sum(1 << int(k) for k in rng.integers(0, 20, 3)) for b in base for _ in range(200)})
    df = spark.createDataFrame([(x,) for x in f], "f bigint")
    v = np.array(f, np.int64).view(np.uint64)
    label = np.arange(len(v))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= 4) for x in v]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    for part in (1 << 15, 64):
        groups = {r.node: r.component for r in common.components(simhash.fingerprint_links(df, 4, part)).collect()}
        got = [groups.get(x, x) for x in f]
        assert len(set(got)) == len(set(label)) and len(set(zip(got, label.tolist()))) == len(set(got))


def test_simhash_edges(spark):
    rows = HARD + [(60, "alpha beta gamma delta epsilon zeta", "p"), (61, "Alpha  beta\ngamma delta epsilon ZETA", "p")]
    df = docs(spark, rows).selectExpr("*", "1 as simhash", "2 as component_id")
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert got[60].component_id == got[61].component_id == 60
    assert got[1].simhash == got[2].simhash == got[7].simhash == 0 and got[7].component_id == 1
    assert {r.component_id for r in out if r.doc_id is None or r.doc_id == 3} == {3}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (1000, 1001)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


# --- urls -------------------------------------------------------------------------------------------

def test_url_edges(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("EXAMPLE.com", "/en/", "block"), ("www.example.com", "/en/", "Allow"), ("net", "/a", "block"), (None, "/", "block")]
    pages = [(1, None), (2, "no scheme"), (3, "http://WWW.Example.com/en/x?y#z"), (4, "https://sub.example.com/en/"), (5, "https://badexample.com/en/"), (6, "x://a.net/abc"),
             (7, "http://example.com"), (8, "http://a.net?/a"), (9, "http:///a"), (None, "http://b.com/"), (10, "http://b.com/"), (10, "http://b.com/"), (11, "http://a..com/q"),
             (12, "https://h.com/" + "p/" * 3000), (13, "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string").selectExpr("*", "1 as host", "2 as rule", "3 as key", "4 as best", "5 as j_url", "6 as row")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urls.match_rules(df, r).collect()}
    assert got[1] == got[2] == got[13] == ("", "", None, "allow")
    assert got[3] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[4] == ("sub.example.com", "/en/", "example.com/en/", "block")
    assert got[5][2:] == ("com/", "allow") and got[6] == ("a.net", "/abc", "net/a", "block")
    assert got[7] == ("example.com", "", None, "allow") and got[8] == ("a.net", "", None, "allow") and got[9] == ("", "/a", None, "allow")
    assert got[11][2] == "com/" and got[12][2] == "com/" and got[None][2] == "com/"
    assert urls.match_rules(df, r).count() == len(pages) and urls.match_rules(df.limit(0), r).count() == 0
    assert {x.rule for x in urls.match_rules(df, r.limit(0)).collect()} == {None}
    tiny = {(x.page_id, x.rule, x.verdict) for x in urls.match_rules(df, r, blocks=1).collect()}  # a full filter changes nothing
    assert tiny == {(x.page_id, x.rule, x.verdict) for x in urls.match_rules(df, r).collect()}
