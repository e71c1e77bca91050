"""Sources whose next document is far too long for what is missing."""

from pyspark.sql import functions as F

from touchline.llm import sampling


def test_short_documents_fill_any_gap(spark):
    sizes = {}
    for k in range(8):  # the short ones are more than the target, so that they can fill any gap before a long one
        sizes |= {(f"even{k}", 10_000 * k + i): 10 for i in range(2000)} | {(f"even{k}", 10_000 * k + 5000): 10_000}
        sizes |= {(f"mixed{k}", 500_000 + 10_000 * k + i): 3 + i * i % 97 for i in range(300)} | {
            (f"mixed{k}", 500_000 + 10_000 * k + 5000 + i): 2000 * (i + 1) for i in range(3)}
    df = spark.createDataFrame([(i, "w " * n, s) for (s, i), n in sizes.items()], "doc_id bigint, text string, source string")
    weights = df.groupBy("source").agg(F.sum(sampling.size_in_words(F.col("text"))).cast("double").alias("weight"))
    out = sampling.pareto_mix(df, weights, share=0.5).collect()
    assert len(out) == len(sizes)
    for source in {r.source for r in out}:
        part = [r for r in out if r.source == source]
        left = min(r.size for r in part if r.copies == 0)
        assert abs(sum(r.copies * r.size for r in part) - part[0].target) <= left / 2
