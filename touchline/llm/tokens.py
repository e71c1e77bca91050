"""Token counts: pieces counted once for each distinct pre-token, then joined to a document's pre-token frequencies."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pre-token pattern of the byte-level tokenizers.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Pre-tokens whose piece counts a task keeps; beyond, it starts over.
KEPT_PRE_TOKENS = 1_000_000
# Characters split at a time, so that a long text needs no list of all its pre-tokens.
CHUNK = 1 << 20


class PieceCounter:
    """Pieces of texts under one tokenizer, each distinct pre-token tokenized once while it is remembered."""

    def __init__(self, tokenizer_json: str, kept: int = KEPT_PRE_TOKENS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.pattern = regex.compile(PRE_TOKEN)
        self.kept, self.pieces = kept, {}

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Frequency of each pre-token, and the number of added tokens written in the text."""
        found: Counter = Counter()
        parts, n_added = [text], 0
        if self.added and self.added.search(text):
            parts = self.added.split(text)
            n_added = len(parts) - 1
        for part in parts:
            if len(part) <= CHUNK:
                found.update(self.pattern.findall(part))
            else:
                found.update(m.group() for m in self.pattern.finditer(part))
        return found, n_added

    def count(self, texts: list[str]) -> list[int]:
        each = [self.frequencies(t) for t in texts]
        if len(self.pieces) > self.kept:
            self.pieces.clear()
        new = list({p for c, _ in each for p in c if p not in self.pieces})
        for i in range(0, len(new), 20_000):
            some = new[i:i + 20_000]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.pieces[p] = len(e)
        pieces = self.pieces
        return [sum([n * pieces[p] for p, n in c.items()]) + extra for c, extra in each]


def count_tokens(docs: DataFrame, tokenizer_json: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer_json`` is the content of a byte-level tokenizer file. Counts are
    those of the library for whole texts, without begin, end or padding; added
    tokens written inside a text count as one. A task splits its texts into
    pre-tokens, takes the frequency of each one in each document, has each
    distinct pre-token of the task cut into pieces once, and sums frequency
    times pieces; ids are never kept. Distinct pre-tokens are joined inside the
    task: joining them across the cluster would shuffle one row for each
    document and distinct word, several times the text itself.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent, so
    repeated rows, ties and empty tables need no rule; columns named like the
    new ones are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary file: fixed size
    schema = docs.select(*kept).schema
    names = list(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(shared.value)
        for batch in batches:
            at = names.index(text)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(counter.count(texts), pa.int64())], names=[*names, "n_tokens"])

    out = docs.select(*kept).mapInArrow(run, schema.add("n_tokens", "long"))
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return out.select(*kept, n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
