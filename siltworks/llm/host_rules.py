"""Quality rules on documents, and verdicts on the hosts they come from.

Column functions only. A document fails by its own measures; a host fails when the share
of its documents that fail, shrunk towards the corpus by a beta prior fitted to the
hosts, is above a limit. A host's verdict holds for all its documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.frames import let, without
from siltworks.staging import settle

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
RUN = 8
MOST_FAILING = 0.5
# The prior weighs as much as so many documents, between these limits.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*MEASURES, "base_failed", "kept", "host_kept"]


def repeated_words(words: Column, run: int = RUN) -> Column:
    """Words inside windows of ``run`` words that the text holds twice or more.

    Hashes show whether any window repeats at all; only then are the windows themselves
    sorted and neighbours compared.
    """
    last = F.size(words) - run

    def covered(places: Column) -> Column:
        # Places ascend, so each adds what the one before it has not covered.
        return F.aggregate(
            places,
            F.struct(F.lit(-run).alias("before"), F.lit(0).alias("total")),
            lambda acc, at: F.struct(
                at.alias("before"),
                (acc["total"] + F.least(F.lit(run), at - acc["before"])).alias("total"),
            ),
            lambda acc: acc["total"],
        )

    def repeats(windows: Column) -> Column:
        def same(x, i):
            before = F.get(windows, i - 1)["window"]
            after = F.get(windows, i + 1)["window"]
            return F.coalesce(before == x["window"], F.lit(False)) | F.coalesce(
                after == x["window"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(windows, same), lambda x: x["at"]))

    sorted_windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.array_join(F.slice(words, i + 1, run), " ").alias("window"), i.alias("at")
            ),
        )
    )
    hashes = F.transform(
        F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, run))
    )
    distinct = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return (
        F.when(last < 0, F.lit(0))
        .when(distinct, F.lit(0))
        .otherwise(let(let(sorted_windows, repeats), covered))
    )


def measured(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the measures of each whole text."""
    value = F.coalesce(F.col(text), F.lit(""))
    marks = "".join("\\" + c for c in SYMBOLS)
    lines = F.filter(F.split(value, "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    words = F.filter(F.split(value, BLANKS, -1), lambda word: word != "")
    return docs.select(
        *keep,
        words.alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(value, BLANKS, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(value, f"[^{marks}]+", "")).cast("bigint").alias("n_symbols"),
    ).select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("bigint").alias("n_repeat_words"),
    )


def prior_strength(n: Column, failed: Column) -> Column:
    """How many documents the prior weighs: the sum of a beta-binomial's two parameters.

    An aggregate over hosts, by the method of moments. The chi-square of the hosts' rates
    against their common rate is k - 1 on average where k hosts differ by chance alone; what
    is above that is the spread between hosts. A host of one document says nothing about the
    spread, so only hosts of two or more take part. Without any spread the prior has its
    greatest strength.
    """
    n, failed = (F.when(n > 1, x) for x in (n, failed))
    documents, failures, hosts = F.sum(n), F.sum(failed), F.count(n)
    between = F.sum(failed * failed / n) - failures * failures / documents
    common = failures / documents * (1 - failures / documents)
    chi_square = between / F.when(common > 0, common)
    strength = (documents - F.sum(n * n) / documents - chi_square) / (chi_square - hosts + 1)
    bounded = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    return F.when(chi_square > hosts - 1, bounded).otherwise(F.lit(MOST_STRENGTH))


def failing_hosts(docs: DataFrame, host: str, failed: str, limit: float) -> DataFrame:
    """Hosts whose shrunk failure rate is above ``limit``, one row each."""
    hosts = (
        docs.filter(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("_host"))
        .agg(
            F.count("*").cast("double").alias("_n"),
            F.count_if(F.col(failed)).cast("double").alias("_failed"),
        )
    )
    hosts = settle(hosts, "hosts")
    total = hosts.agg(F.sum("_n").alias("n"), F.sum("_failed").alias("failed"))
    mean = total.select(F.col("failed") / F.col("n")).scalar()
    strength = hosts.agg(prior_strength(F.col("_n"), F.col("_failed"))).scalar()
    rate = (F.col("_failed") + mean * strength) / (F.col("_n") + strength)
    return hosts.filter(rate > limit).select("_host")


def host_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    keep: Sequence[str] = ("doc_id",),
    limit: float = MOST_FAILING,
) -> DataFrame:
    """Measures and verdicts of all documents, with the columns ``keep``.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (under 20 words, or over 30 percent of them in repeated windows),
    ``kept`` and ``host_kept``. These replace kept columns of the same names.

    A null text has no words. A document without a host is judged alone. Repeated rows
    stay and count once each. What is written in between are the measures, not the texts.
    """
    kept = [name for name in without(docs, RESULTS) if name.lower() in {k.lower() for k in keep}]
    narrow = docs.select(
        *(F.col(name).alias(f"_k{i}") for i, name in enumerate(kept)),
        F.col(text).alias("_text"),
        F.col(host).alias("_of"),
    )
    found = measured(narrow, "_text", [*(f"_k{i}" for i in range(len(kept))), "_of"])
    found = settle(
        found.withColumn(
            "base_failed",
            (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        ),
        "measures",
    )
    bad = failing_hosts(found, "_of", "base_failed", limit)
    joined = found.join(bad, found["_of"] == bad["_host"], "left")
    return joined.select(
        *(F.col(f"_k{i}").alias(name) for i, name in enumerate(kept)),
        *MEASURES,
        "base_failed",
        (~F.col("base_failed") & F.col("_host").isNull()).alias("kept"),
        F.col("_host").isNull().alias("host_kept"),
    )
