"""Writing: canonical JSON lines, tables that are never overwritten, small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.functions.hashing import canonical_json


def as_canonical(df: DataFrame, key: str) -> DataFrame:
    """key, body: each row as canonical JSON."""
    columns = {f.name: (F.col(f.name), f.dataType) for f in df.schema.fields}
    return df.select(key, canonical_json(columns).alias("body"))


def write_canonical(df: DataFrame, key: str, path: str) -> None:
    """One JSON document a line, in the order of the key; a path that exists is an error.

    Rows are sorted by range partitions, so the files read one after the other are in order.
    """
    as_canonical(df, key).orderBy(key).select("body").write.mode("errorifexists").text(path)


def write_new(df: DataFrame, path: str) -> None:
    """Parquet under Spark's commit protocol; never over what is there."""
    df.write.mode("errorifexists").parquet(path)


def content(df: DataFrame) -> tuple:
    """What tells the rows of two frames apart whatever their order: a count and sums of two digests."""
    row = F.struct(*sorted(df.columns))
    one = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.to_json(row)).cast("decimal(38,0)"))
    return tuple(df.agg(F.count(F.lit(1)), one(1), one(2)).first())


def write_once(df: DataFrame, path: str) -> str:
    """`written`, or `identical` where the path already holds the same rows; other rows there are an error.

    The write itself is Spark's commit protocol on a path that must not exist, so a race ends in an error too.
    """
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        write_new(df, path)
        return "written"
    if content(spark.read.parquet(path)) != content(df):
        raise ValueError(f"{path} holds other rows")
    return "identical"


def markdown(title: str, counts: DataFrame, most: int = 1000) -> str:
    """A table of a small aggregate: its rows are groups of a declared dimension; more than `most` are an error."""
    names = counts.columns
    rows = sorted(tuple("" if v is None else str(v) for v in r) for r in counts.limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"a report has {most} rows at most")
    head = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    return "\n".join([f"# {title}", "", *head, *("| " + " | ".join(r) + " |" for r in rows), ""])
