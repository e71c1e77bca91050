"""Each stage of the pipeline against its rule, on its own input."""

import re

import corpus_pipeline
import pytest
from test_llm_queries import fingerprint_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base, docs, kept = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    kept["documents"] = docs.toPandas().set_index("doc_id", drop=False)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        kept[name] = docs.toPandas()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
            kept[name] = kept[name].set_index("doc_id", drop=False)
    return kept


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_quality_keeps_good_documents(stages, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    kept = set(stages["quality classifier"].doc_id)
    assert [i in kept for i in labels.doc_id] == [q == 1 for q in labels.quality]


def test_one_copy_of_each_group_stays(stages):
    before, after = stages["quality classifier"], stages["simhash near-dedup"]
    component = fingerprint_groups(dict(zip(before.doc_id, before.text)))
    assert set(after.doc_id) == set(component.values())
    assert all(after.text[i] == before.text[i] for i in after.doc_id) and len(after) < len(before)


def test_no_window_repeats(stages):
    before, after = stages["simhash near-dedup"], stages["substring dedup"]
    seen, want = {}, {}
    for i in sorted(before.doc_id):
        w = words(before.text[i])
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if seen.setdefault(tuple(w[k:k + 20]), (i, k)) != (i, k):
                gone[k:k + 20] = [True] * 20
        want[i] = [x for x, g in zip(w, gone) if not g]
    assert {i: words(t) for i, t in zip(after.doc_id, after.text)} == {i: w for i, w in want.items() if w or not words(before.text[i])}
    assert [len(t) for t in after.text] == list(after.n_chars)


def test_no_benchmark_passage_stays(stages, spark, sf):
    def tokens(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())

    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = tokens(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    sizes = {len(x) for x in windows}
    hits = lambda w: [(i, n) for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows]
    before, after = stages["substring dedup"], stages["benchmark decontamination"]
    for i, t in zip(before.doc_id, before.text):
        w, gone = tokens(t), set()
        for a, n in hits(w):
            gone |= set(range(a, a + n))
        left = [x for k, x in enumerate(w) if k not in gone]
        if gone and not left:
            assert i not in after.doc_id or not words(after.text[i]) or tokens(after.text[i]) == []
        else:
            assert tokens(after.text[i]) == left
        if not gone:
            assert after.text[i] == t


def test_mix_repeats_documents_up_to_twice(stages):
    mix = stages["source mix"]
    assert mix.doc_id.value_counts().max() <= 2
    sizes = mix.assign(size=[len(words(t)) for t in mix.text])
    assert (sizes["size"] == mix["size"]).all()
    before = stages["benchmark decontamination"]
    largest = before.assign(size=[len(words(t)) for t in before.text]).groupby("source")["size"].max()
    for source, part in mix.groupby("source"):
        assert abs(part["size"].sum() - part.target.iloc[0]) <= largest[source] / 2 + 1


ODD = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, simhash string, removed string, n_words string,"
       " hits string, items string, size string, copy string, target string, component_id string, packed_changed string, `a.b` string, component string")


def test_clashing_columns_nulls_and_repeated_rows(spark, tmp_path):
    good = "a clear sentence about rivers and towns that anybody would like to read today"
    rows = [(1, good, "en", "s"), (1, good, "en", "s"), (2, good, "en", None), (None, None, None, None), (3, "", "en", "s"), (None, good + " x", None, "s"),
            (4, " ".join(f"word{i}" for i in range(40_000)), "en", "t"), (5, "item phrase of six words only", "fr", "t"), (6, "   ", None, "t")]
    clash = [f"keep{k}" for k in range(len(ODD.split(",")) - 5)]
    df = spark.createDataFrame([(i, t, lang, s, len(t or ""), *clash) for i, t, lang, s in rows], ODD)
    base = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([("b", "phrase of six words")], "item_id string, text string").write.parquet(f"{base}/benchmark.parquet")
    for table in (df, df.limit(0)):
        docs = table
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, base)
            path = f"{base}/{table is df}/{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            last = k == len(corpus_pipeline.STAGES) - 1
            untouched = [c for c in df.columns[5:] if not (last and c in ("copy", "size", "target"))]
            assert [c for c in docs.columns if c not in ("copy", "size", "source_size", "target")] == [c for c in df.columns if c not in ("copy", "size", "target")] \
                if last else docs.columns == df.columns
            for r in docs.collect():
                assert [r[c] for c in untouched] == [clash[df.columns.index(c) - 5] for c in untouched]
            if table is df and name == "simhash near-dedup":
                kept = [(r.doc_id, r.text) for r in docs.collect()]
                assert kept.count((1, good)) == 2 and (2, good) not in kept and (None, None) in kept and (None, good + " x") in kept
            if table is df and name == "benchmark decontamination":
                assert {r.text: r.n_chars for r in docs.filter("doc_id = 5").collect()} == {"item only": 9}
        if table is not df:
            assert docs.count() == 0
