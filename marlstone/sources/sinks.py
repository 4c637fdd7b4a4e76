"""Tables as files. Spark's commit protocol writes beside the target and renames, so that a broken job leaves
nothing half written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, escape: bool = False, mode: str = "overwrite") -> int:
    """JSON lines; the number of rows. escape: characters beyond ASCII as \\u sequences."""
    seen = Observation("written")
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if not escape:
        rows.write.mode(mode).option("ignoreNullFields", "false").json(path)
    else:
        text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})
        rows.select(text.alias("value")).write.mode(mode).text(path)
    return seen.get["n"]


def write_books(reports: dict[str, DataFrame], path: str, book_col: str = "book") -> None:
    """Each report below its name, one folder per book."""
    for name, df in reports.items():
        part = df.where(F.col(book_col).isNotNull()) if book_col in df.columns else df
        part.write.mode("overwrite").partitionBy(book_col).json(f"{path}/{name}")


def write_report(df: DataFrame, path: str) -> None:
    """A report of one row as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_blocks(df: DataFrame, path: str) -> None:
    """Packed blocks of token ids."""
    df.select("block", F.col("tokens").cast("array<int>").alias("tokens")).write.mode("overwrite").parquet(path)


def publish(sets: dict[str, DataFrame], path: str, split_col: str = "split") -> dict[str, str]:
    """Each set's train and validation rows below <set>/<split>; the folders written."""
    out = {}
    for name, df in sets.items():
        for split, folder in (("train", "train"), ("val", "validation")):
            out[f"{name}/{folder}"] = f"{path}/{name}/{folder}"
            df.where(F.col(split_col) == split).drop(split_col).write.mode("overwrite").parquet(out[f"{name}/{folder}"])
    return out


def write_pairs(items: DataFrame, path: str) -> None:
    """Generated items as two row shapes side by side, one folder per source."""
    items.select("source", "question", F.col("chosen").alias("answer"), "topic").write.mode("overwrite").partitionBy("source").json(f"{path}/sft")
    items.select("source", F.col("question").alias("prompt"), "chosen", "rejected", "topic").write.mode("overwrite").partitionBy("source").json(f"{path}/dpo")
