"""Line dedup by overlapping three-line windows, with DataFrame functions only.

Every three consecutive lines of a text are one window, told by a 128-bit digest. The first place of a window in the order
(doc_id, digest of the text, line) stays; at every later place its three lines are covered, and covered lines are removed.
Windows without a word do not count. A window repeated inside one document counts like any other.

Null text stays null and has no lines. Null doc_ids sort first. Rows equal in doc_id and text are one document delivered
twice and get the same result. Texts of fewer than three lines stay as they are. Extra columns are passed on.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharewright.session import Stages

WINDOW = 3


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_k": F.coalesce("doc_id", F.lit(-2**63)), "_h": F.xxhash64("text")})


def covered_lines(docs: DataFrame) -> DataFrame:
    """_k, _h, gone: line numbers to remove, for the documents that lose any."""
    stages = Stages(docs.sparkSession, "line-windows")
    lines = _keyed(docs.select("doc_id", "text")).select("_k", "_h", F.split("text", "\n", -1).alias("lines")).filter(
        F.size("lines") >= WINDOW)
    places = lines.select("_k", "_h", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("lines") - WINDOW),
        lambda i: F.concat_ws("\n", *[F.get("lines", i + k) for k in range(WINDOW)]))).alias("i", "body")).filter(
        r"translate(body, ' \t\n\r\f', '') != ''").select(
        "_k", "_h", "i", F.unhex(F.md5("body")).alias("w"))
    places = stages(places, "windows")
    repeated = stages(places.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_k", "_h", "i")).alias("first"))
                      .filter("n > 1").select("w", "first"), "repeated")
    later = places.join(repeated.hint("merge"), "w").filter(F.struct("_k", "_h", "i") > F.col("first"))
    return later.groupBy("_k", "_h").agg(F.collect_set("i").alias("starts")).select(
        "_k", "_h", F.array_distinct(F.flatten(F.transform(
            "starts", lambda i: F.array(*[i + k for k in range(WINDOW)])))).alias("gone"))


def drop_repeated_windows(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the text reduced, and n_lines, n_removed (long)."""
    gone = Stages(docs.sparkSession, "line-dedup")(covered_lines(docs), "gone")
    # texts are shuffled once, and by the same kind of join at every size
    joined = _keyed(docs).join(gone.hint("merge"), ["_k", "_h"], "left")
    lines = joined.withColumn("_lines", F.split("text", "\n", -1))
    # the runs of lines between removed ones; time is linear in the lines
    stops = F.array_sort(F.concat(F.array(F.lit(-1)), "gone", F.array(F.size("_lines"))))
    lines = lines.withColumn("_stops", stops)
    runs = F.transform(F.sequence(F.lit(0), F.size("_stops") - 2), lambda i: F.slice(
        "_lines", F.get("_stops", i) + 2, F.get("_stops", i + 1) - F.get("_stops", i) - 1))
    left = F.array_join(F.flatten(runs), "\n")
    return lines.select(
        *[F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(c)
          for c in docs.columns],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
