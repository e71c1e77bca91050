"""Team names of all sources brought to one spelling.

The aliases are a table the user supplies (columns ``alias`` and
``canonical``), not a list in the code: clubs and spellings change by season.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import col

_SPACE = " \t\r\n"


def trimmed(name) -> Column:
    return F.btrim(col(name), F.lit(_SPACE))


def alias_key(name) -> Column:
    return F.lower(trimmed(name))


def alias_table(aliases: DataFrame) -> DataFrame:
    """One row per spelling, case ignored."""
    return aliases.groupBy(alias_key("alias").alias("_key")).agg(F.min("canonical").alias("_canonical"))


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Spellings that lead to more than one team; should be empty."""
    return (
        aliases.groupBy(alias_key("alias").alias("alias_key"))
        .agg(F.min("canonical").alias("first_canonical"), F.max("canonical").alias("last_canonical"))
        .filter("first_canonical <> last_canonical")
    )


def normalize_team(df: DataFrame, aliases: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Replace each name by its canonical form; unknown names are only trimmed.

    ``columns`` maps a raw column to the column to write, or lists columns to
    write in place. One equi-join per column on the lower-case name: Spark
    broadcasts the alias table while it is under the broadcast threshold.
    """
    if not isinstance(columns, dict):
        columns = {c: c for c in columns}
    table = alias_table(aliases)
    for raw, out in columns.items():
        joined = df.withColumn("_key", alias_key(raw)).join(table, "_key", "left")
        df = joined.withColumn(out, F.coalesce("_canonical", trimmed(raw))).drop("_key", "_canonical")
    return df


def all_names(*sources: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Distinct non-empty names over several tables and columns."""
    parts = [
        df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("name")).distinct()
        for df, columns in sources
    ]
    return reduce(DataFrame.union, parts).filter("name <> ''").distinct()


def unmapped_names(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names no alias covers."""
    keyed = names.select("name", alias_key("name").alias("_key"))
    return keyed.join(alias_table(aliases), "_key", "left_anti").select("name")
