"""Quality rules with host verdicts, in DataFrame operations only.

Every document is measured and judged by itself. Per host (domain) the failures
are counted, the failure rate is shrunk towards the corpus with a beta prior
fitted to all hosts, and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import BLANK, materialize

SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"


def measure(docs: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row per document: ``id_cols``, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Measures are of the whole text; a null text counts as empty and has 0 in all.
    Repeated rows stay separate. The three-word windows of a text are sorted, so
    that equal ones stand together; only the windows found twice leave the task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = (docs.select(*id_cols, text.alias("_q_text"), F.monotonically_increasing_id().alias("_q_row"))
           .withColumn("n_symbols", (F.length("_q_text") - F.length(F.regexp_replace("_q_text", f"[{SYMBOLS}]+", "")))
                       .cast("long"))
           .withColumn("_q_words", F.array_remove(F.split("_q_text", BLANK), ""))
           .withColumn("_q_lines", F.filter(F.split("_q_text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))))
    out = out.select(*id_cols, "_q_row", "n_symbols", "_q_words", F.size("_q_words").cast("long").alias("n_words"),
                     F.length(F.array_join("_q_words", "")).cast("long").alias("word_chars"),
                     (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"))
    n = F.size("_q_words") - 2
    windows = F.arrays_zip(F.slice("_q_words", 1, n).alias("a"), F.slice("_q_words", 2, n).alias("b"),
                           F.slice("_q_words", 3, n).alias("c"), F.sequence(F.lit(0), n - 1).alias("i"))
    keys = ["_q_row", *id_cols, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    rest = 1 << 30
    out = out.select(*keys, F.when(n > 0, F.sort_array(windows)).alias("_q_windows"))
    out = out.select(*keys, F.posexplode_outer(F.arrays_zip(
        F.col("_q_windows").alias("x"), F.slice("_q_windows", 2, rest).alias("y"))).alias("_q_at", "_q_pair"))
    x, y = F.col("_q_pair.x"), F.col("_q_pair.y")
    again = F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    out = (out.where(F.col("_q_at").isNull() | (F.col("_q_at") == 0) | again).groupBy(*keys)
           .agg(F.collect_set(F.when(again, x["i"])).alias("_q_x"), F.collect_set(F.when(again, y["i"])).alias("_q_y"))
           .withColumn("_q_starts", F.sort_array(F.array_union("_q_x", "_q_y"))))
    # a repeated window adds three words, or as many as it lies behind the one before
    before = F.concat(F.array(F.lit(-3)), F.slice("_q_starts", 1, F.greatest(F.size("_q_starts") - 1, F.lit(0))))
    steps = F.zip_with("_q_starts", before, lambda a, b: F.least(F.lit(3), a - b))
    repeated = F.aggregate(steps, F.lit(0).cast("long"), lambda s, d: s + d)
    return out.select(*keys[1:], F.when(F.size("_q_starts") > 0, repeated).otherwise(F.lit(0)).cast("long")
                      .alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def host_verdicts(judged: DataFrame, host_col: str, failed_col: str, limit: float = 0.5, z: float = 3.0) -> DataFrame:
    """One row per host: documents, failures, shrunk rate, and whether the host is rejected.

    The beta prior is fitted to all hosts by moments, with each host weighted by
    its documents. A host is rejected only if the shrunk rate less ``z`` posterior
    deviations is still above ``limit``; few documents never suffice. With less
    variation between hosts than chance makes, the prior's weight is 1000
    documents. Null hosts have no verdict.
    """
    hosts = (judged.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("_q_host"))
             .agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed_col).cast("long")).alias("host_failed")))
    rate = F.col("host_failed") / F.col("host_docs")
    total = hosts.agg(F.sum("host_docs").alias("n"), F.sum("host_failed").alias("f"), F.count(F.lit(1)).alias("k"),
                      F.sum(F.col("host_docs") * rate * rate).alias("q")).first()
    mean, weight = beta_prior(total["n"] or 0, total["f"] or 0, total["k"], total["q"] or 0.0)
    n = F.col("host_docs") + weight
    shrunk = (F.col("host_failed") + mean * weight) / n
    sure = shrunk - z * F.sqrt(shrunk * (1 - shrunk) / (n + 1))
    return hosts.select("_q_host", "host_docs", "host_failed", shrunk.alias("host_rate"), (sure > limit).alias("host_rejected"))


def beta_prior(docs: int, failed: int, hosts: int, squares: float) -> tuple[float, float]:
    """Mean and weight (in documents) of the prior from four totals; ``squares``: sum of documents * rate squared."""
    if not docs:
        return 0.0, 1000.0
    mean = failed / docs
    spread = mean * (1 - mean)
    between = squares / docs - mean * mean - spread * hosts / docs  # less what binomial noise adds
    return mean, max(0.01, spread / between - 1) if between > spread / 1000 else 1000.0


def judge(docs: DataFrame, host_col: str = "source", id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          limit: float = 0.5, z: float = 3.0) -> DataFrame:
    """One row per document: its id, measures, base_failed, host figures and kept.

    kept is false if the document fails by itself or its host is rejected. The
    text is read once; the narrow measures are written to the shared folder and
    serve both the counts per host and the result. Null and empty texts fail (no
    words); documents without a host are judged by themselves; repeated rows
    are judged each; an empty table gives no rows.
    """
    keep = docs.select(*id_cols, F.col(host_col).alias("_q_host"), F.col(text_col).alias("_q_text"))
    measured = materialize(measure(keep, (*id_cols, "_q_host"), "_q_text").withColumn("base_failed", base_failed()), "quality")
    hosts = host_verdicts(measured, "_q_host", "base_failed", limit, z)
    return (measured.join(hosts, "_q_host", "left")
            .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("_q_host"))
