"""Quality rules of documents and of the hosts they come from, in DataFrame functions only.

Every document is judged by base rules. Rule failures are then counted by host (``source``), the failure rates are
shrunk with a beta prior fitted to all hosts, and hosts whose rate is surely above the threshold lose all their
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.llm.common import let, words
from filmgrid.session import written

# Characters that count as symbols, white space.
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: a host goes if the lower bound of its failure rate (posterior mean less so many deviations) is above the limit
MAX_FAILURE_RATE, DEVIATIONS = 0.5, 1.645
#: bounds of the fitted correlation inside a host; prior strength is 1 / correlation - 1 documents, so 10 to 999
CORRELATION = (0.001, 1 / 11)


def repeated_words(word: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in windows of ``window`` words found twice or more in the array, the first included.

    Windows are compared by 64-bit hashes. Only if some hash repeats, the hashes are sorted with their places; the
    places of repeated windows, in order, give the length of the union of the windows.
    """
    places = F.sequence(F.lit(0), F.size(word) - window)
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(word, i + 1, F.lit(window))))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twins(p: Column) -> Column:
            same = F.filter(
                p,
                lambda x, i: (F.get(p, i + 1)["h"].eqNullSafe(x["h"])) | ((i > 0) & F.get(p, F.greatest(i - 1, F.lit(0)))["h"].eqNullSafe(x["h"])),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def union(at: Column) -> Column:
            gaps = F.transform(at, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))))
            return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

        return let(let(pairs, twins), union)

    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(word) <= window, F.lit(0)).otherwise(found).cast("long")


def base_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)``, a row per row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), whole.alias("text"), words(F.col(text)).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, BLANK, "")) > 0)
    measured = read.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANK, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return measured.withColumn("base_failed", failed)


def host_verdicts(hosts: DataFrame) -> DataFrame:
    """``(host, rate, rejected)`` from ``(host, n, k)``: documents and failed documents of each host.

    The prior's mean is the rate over all hosts, its strength follows from how much more the hosts differ than chance
    would have it (moments of the intra-class correlation).
    """
    mean = hosts.agg(((F.sum("k") + 0.5) / (F.sum("n") + 1)).alias("m")).scalar()
    with_mean = hosts.withColumn("m", mean)
    rate, noise = F.col("k") / F.col("n"), F.col("m") * (1 - F.col("m"))
    excess = F.sum(F.col("n") * (rate - F.col("m")) * (rate - F.col("m"))) - F.sum(noise)
    possible = F.sum(noise * (F.col("n") - 1))
    fitted = F.least(F.greatest(F.when(possible > 0, excess / possible).otherwise(CORRELATION[1]), F.lit(CORRELATION[0])), F.lit(CORRELATION[1]))
    strength = with_mean.agg((1 / fitted - 1).alias("c")).scalar()
    alpha = F.col("k") + F.col("c") * F.col("m")
    total = F.col("n") + F.col("c")
    posterior = with_mean.withColumn("c", strength).select("host", (alpha / total).alias("rate"), total.alias("total"))
    lower = F.col("rate") - DEVIATIONS * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("total") + 1))
    return posterior.select("host", "rate", (lower > MAX_FAILURE_RATE).alias("rejected"))


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``, a row per row.

    Null and empty texts have no words and fail. A null host is a host of its own. Repeated rows are judged alike and
    count as often as they come. An empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    # written, since hosts are counted first and documents judged second; the texts are read once
    measured = written(base_measures(docs, doc_id, text, host), "host-quality")
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("k"))
    return _joined(measured, host_verdicts(hosts)).drop("host")


def _joined(measured: DataFrame, verdicts: DataFrame) -> DataFrame:
    back = verdicts.select(F.col("host").alias("judged_host"), "rejected")
    joined = measured.join(back, F.col("host").eqNullSafe(F.col("judged_host")), "left").drop("judged_host")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return joined.withColumn("kept", kept).drop("rejected")
