"""Language identification against a plain version that keeps every count in dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest
from touchline.llm import langid as L


def scores(counts, langs):
    """Fixed-point log frequency of every item in every language."""
    items = {i for c in counts.values() for i in c}
    size = [sum(counts[name].values()) + 0.5 * max(1, len(items)) for name in langs]
    return {i: [math.floor(math.log((counts[name][i] + 0.5) / t) * L.UNIT + 0.5) for name, t in zip(langs, size)] for i in items}


def half_up(x):
    return math.floor(abs(x) + 0.5) * (1 if x >= 0 else -1)


class Plain:
    def __init__(self, rows):
        counts = defaultdict(Counter)
        for text, lang in rows:
            if text is not None and lang is not None:
                counts[lang].update(L.words_of(text))
        self.langs = sorted(k for k, c in counts.items() if c)
        counts = {k: counts[k] for k in self.langs}
        self.words = scores(counts, self.langs)
        self.grams = {}
        for n in range(1, L.LONGEST + 1):
            cut = {k: Counter() for k in self.langs}
            for k, c in counts.items():
                for w, times in c.items():
                    for g in L.grams_of(w, n):
                        cut[k][g] += times
            self.grams[n] = scores(cut, self.langs)

    def word(self, w):
        if w in self.words:
            return self.words[w]
        for n in range(L.LONGEST, 0, -1):
            known = [self.grams[n][g] for g in L.grams_of(w, n) if g in self.grams[n]]
            if known:
                return [half_up(sum(s) * L.BACKOFF / len(known)) for s in zip(*known)]
        return [0] * len(self.langs)

    def predict(self, text):
        counts = Counter(L.words_of(text or ""))
        if not counts or not self.langs:
            return "und", 0.0
        total = sum(counts.values())
        mean = [sum(n * self.word(w)[k] for w, n in counts.items()) / total / L.UNIT for k in range(len(self.langs))]
        best = max(mean)
        return self.langs[mean.index(best)], 1 / sum(math.exp(m - best) for m in mean)


def close(got, want):
    assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-4)


@pytest.mark.parametrize("head", [20, 100_000])
def test_equals_plain_version(spark, head):
    rng = random.Random(head)
    parts = {"de": ["ein", "sch", "keit", "ü", "ver"], "en": ["the", "ing", "tion", "wh"], "fr": ["eau", "é", "que", "tion"], "zh": ["你", "好", "们"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 12)))
        rows.append((i, rng.choice([text, text.upper(), None]) if i % 9 == 0 else text, None if i % 13 == 0 else lang))
    texts = [t for _, t, _ in rows] + ["", "12 ?", "zzzz", "Keitsch! unseenthing", "the the THE", "é́ à", "x" * 3000, None]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3))
    plain = Plain([(t, lang) for _, t, lang in rows])
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    got = {r.id: (r.lang_pred, r.score) for r in L.predict(df, model, head=head).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        close(got[i], plain.predict(t))


def test_small_language_and_words_seen_once(spark):
    """130 000 words, each seen once, and a language with a thousandth of the rows: all are known words."""
    def word(k, letters):
        out = ""
        while True:
            out += letters[k % len(letters)]
            k //= len(letters)
            if not k:
                return out + "q"

    big = [" ".join(word(k, "abcdefghij") for k in range(i * 130, i * 130 + 130)) for i in range(1000)]
    small = " ".join(word(k, "abcdefghijklm") for k in range(50_000, 50_130))  # the same letters
    rows = [(i, t, "big") for i, t in enumerate(big)] + [(1000, small, "small")]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.words.count() == len({w for t in (*big, small) for w in t.split()})
    own = sorted(set(small.split()) - {w for t in big for w in t.split()})
    probes = [(1, " ".join(own), "small"), (2, big[7], "big"), (3, " ".join(big[k].split()[k % 130] for k in range(0, 1000, 9)), "big")]
    out = {r.id: r.lang_pred for r in L.predict(spark.createDataFrame(probes, "id int, text string, want string"), model, head=100).collect()}
    assert out == {i: want for i, _, want in probes}


def test_columns(spark):
    model = L.train(spark.createDataFrame([(1, "the cat", "en")], "doc_id bigint, text string, lang string"))
    df = spark.createDataFrame([(1, "the", "keep", 2, 3), (1, "the", "keep", 2, 3), (None, None, None, None, None)], "doc_id bigint, text string, place string, rest int, row int")
    out = L.predict(df.selectExpr("*", "'x' as score", "1 as sums", "2 as mean", "3 as n_words"), model)
    assert out.columns == ["doc_id", "text", "place", "rest", "row", "sums", "mean", "n_words", "lang_pred", "score"]
    assert sorted((r.doc_id or 0, r.place, r.lang_pred, r.score, r.mean) for r in out.collect())[1:] == [(1, "keep", "en", 1.0, 2)] * 2
    assert L.predict(df, model, keep=["doc_id", "rest"]).columns == ["doc_id", "rest", "lang_pred", "score"]
    assert L.predict(df.limit(0), model).count() == 0
