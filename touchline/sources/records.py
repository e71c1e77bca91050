"""Large text files in pieces: CSV records over line breaks, and marks of content, with many tasks for one file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import kept_in_files


def file_path() -> Column:
    """Path of the file a row comes from, without URL escapes."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, root: str, glob: str = "*", line: str = "line") -> DataFrame:
    """Lines of all files with ``path``, ``block`` (where the piece of the file starts) and ``at`` (order within the piece).

    Spark cuts large files into pieces; within one, ``at`` rises by one from line to line.
    The cuts depend on the cores of the moment unless a number is set: one is
    set, so that files scanned again, after an executor came or went, are cut alike.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))
    lines = spark.read.options(recursiveFileLookup=True, pathGlobFilter=glob, lineSep="\n").text(root)
    return lines.select(
        file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias(line))


PIECE = ["path", "block"]
# Where quotes are open, lines are put in order by stretches of a piece, so that a task never has to hold a whole piece.
STRETCH = 20_000


def csv_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """Records of CSV files out of their lines: ``path``, ``block``, ``at`` of the first line, ``record``.

    A line break ends a record unless it stands within quotes, that is after an
    odd number of them (doubled quotes count twice, as they should). Every
    stretch of a piece counts its lines with an odd number of quotes; a running
    parity over the stretches tells in which state each begins. The stretches
    with open quotes are written down, one row for each: where there are none,
    mostly all, lines are records as they are, without a shuffle. In the others
    lines find their state by a running sum within the stretch, and only lines
    of records with several of them are brought together.

    Quotes must stand only around fields. A quote that is never closed takes the
    rest of its file into one record, as it does in any CSV reader.
    """
    odd = (F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))) % 2 == 1
    parts_of = [*PIECE, "stretch"]
    lines = lines.withColumns({"odd": odd, "stretch": F.floor(F.col("at") / STRETCH)})
    stretches = lines.groupBy(*parts_of).agg(F.count_if("odd").alias("n"))
    before = Window.partitionBy("path").orderBy("block", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1)
    open_ = kept_in_files(stretches.filter("n > 0 or inside").select(*parts_of, "inside"))
    if open_.isEmpty():
        return lines.select(*PIECE, "at", F.col("line").alias("record"))
    plain = lines.join(open_, parts_of, "left_anti").select(*PIECE, "at", F.col("line").alias("record"))

    order = Window.partitionBy(*parts_of).orderBy("at")
    some = lines.join(open_, parts_of)
    odds = F.coalesce(F.sum(F.col("odd").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = some.withColumn("within", (odds + F.col("inside").cast("int")) % 2 == 1)
    some = some.withColumn("nth", F.sum((~F.col("within")).cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    single = some.filter("not within and not odd").select(*PIECE, "at", F.col("line").alias("record"))
    parts = some.filter("within or odd")
    # lines before the first record of a stretch belong to the last record of the stretches before it
    last = parts.groupBy(*parts_of).agg(F.max("nth").alias("nth"), F.min("nth").alias("low"))
    begun = F.last(F.when(F.col("nth") > 0, F.struct("block", "stretch", "nth")), ignorenulls=True).over(before)
    carried = last.withColumn("begun", begun).filter("low = 0").select(*parts_of, F.lit(0).cast("bigint").alias("nth"), "begun")
    parts = parts.join(carried, [*parts_of, "nth"], "left")
    owner = F.coalesce("begun", F.struct("block", "stretch", "nth"))
    whole = parts.groupBy("path", owner.alias("owner")).agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    joined = whole.select(
        "path", F.col("owner.block").alias("block"), F.col("lines")[0]["at"].alias("at"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    return plain.unionByName(single).unionByName(joined)


CSV = {"quote": '"', "escape": '"', "multiLine": "true"}


def _row(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width))


def csv_fields(record: Column, width: int) -> Column:
    """The fields of a CSV record, in order."""
    row = F.from_csv(record, _row(width), CSV)
    return F.array(*[row[f"c{i}"] for i in range(width)])


def _filled(records: DataFrame) -> DataFrame:
    """Records without the mark at the start of a file, without carriage return at their end, and not empty."""
    return records.withColumn("record", F.regexp_replace("record", "^\ufeff|\r$", "")).filter("record <> ''")


def _first_records(lines: DataFrame) -> DataFrame:
    """``path``, ``at``, ``record``: what each file begins with, one row for each."""
    def first(records: DataFrame) -> DataFrame:
        return kept_in_files(records.groupBy("path").agg(F.min(F.struct("at", "record")).alias("head")).select("path", "head.*"))

    heads = first(_filled(lines.withColumnRenamed("line", "record")))
    broken = F.regexp_count("record", F.lit('"')) % 2 == 1  # the first record goes on in the next line
    return heads if heads.filter(broken).isEmpty() else first(_filled(csv_records(lines)))


def read_csv_records(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """CSV files as text columns, named by the first record of each file; a large file is read by many tasks.

    Files may have their columns in different order, or lack some. Empty
    records are left out.
    """
    lines = read_lines(spark, root, glob)
    records = _filled(csv_records(lines))
    heads = _first_records(lines.filter("block = 0"))
    width = heads.agg(F.max(F.length("record") - F.length(F.replace("record", F.lit(","), F.lit("")))) + 1).first()[0] or 1
    heads = heads.select("path", F.col("at").alias("head_at"), F.filter(csv_fields(F.col("record"), width), lambda n: n.isNotNull()).alias("names"))
    named = heads.select("names").distinct()
    same = named.limit(2).collect()
    names = list(same[0]["names"]) if len(same) == 1 else [r["name"] for r in named.select(F.posexplode("names").alias("place", "name")).groupBy(
        "name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()]  # the columns of the table
    body = records.join(heads, "path").filter("block > 0 or at > head_at")
    if len(same) == 1:
        row = F.from_csv("record", _row(len(names)), CSV)
        return body.select(row.alias("row")).select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
    body = body.select("names", csv_fields(F.col("record"), width).alias("fields"))
    return body.select(*[F.get("fields", F.array_position("names", F.lit(n)).cast("int") - 1).alias(n) for n in names])


def content_marks(spark: SparkSession, root: str, glob: str = "*", name: Column | str = "path") -> DataFrame:
    """``file``, ``lines`` and ``mark`` of the content of each file, whatever its time, and however it is cut for reading.

    With h the 64-bit hash of a line, in two halves, and i its number in the
    file, the mark holds the sums of h and of h * i. A piece of a file gives its
    sums with numbers of its own; they are moved by the lines before the piece
    when the pieces of a file are put together in order, so no file passes
    through one row or one task. A changed, added or removed line changes the
    mark, and so do two lines that swap places.

    ``name``, made of ``path``, names the file; several paths of one name, as a
    folder of parts, count as one file, in order of path.
    """
    lines = read_lines(spark, root, glob)
    name = F.col(name) if isinstance(name, str) else name
    h = F.xxhash64("line")
    halves = {"a": F.shiftrightunsigned(h, 32), "b": h.bitwiseAND(F.lit(0xFFFFFFFF))}
    wide = "decimal(38,0)"
    sums = []
    for k, x in halves.items():
        sums += [F.sum(x.cast(wide)).alias(k), F.sum(x.cast("decimal(10,0)") * F.col("at").cast("decimal(19,0)")).cast(wide).alias(f"{k}at")]
    pieces = lines.groupBy(name.alias("file"), *PIECE).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), *sums)
    order = Window.partitionBy("file").orderBy(*PIECE).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("move", (F.coalesce(F.sum("n").over(order), F.lit(0)) - F.col("low")).cast("decimal(19,0)"))
    moved = [F.sum((F.col(f"{k}at") + F.col(k) * F.col("move")).cast(wide)).alias(f"{k}at") for k in halves]
    files = pieces.groupBy("file").agg(F.sum("n").alias("lines"), *[F.sum(k).alias(k) for k in halves], *moved)
    mark = F.sha2(F.concat_ws("-", "lines", *[F.col(c).cast("string") for k in halves for c in (k, f"{k}at")]), 256)
    return files.select("file", "lines", mark.alias("mark"))
