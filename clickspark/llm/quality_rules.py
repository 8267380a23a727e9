"""Quality rules for documents, and for the hosts they come from.

Only DataFrame functions: nothing here runs Python in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.names import unused
from clickspark.sources.shared import materialize

WHITE = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
_RUN = 3

#: Rules a document can fail, on its metrics. The first two are the base rules.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "2 * n_dup_lines > n_lines",
}
BASE_RULES = ("short", "repeats")

VERDICTS = ("base_failed", "kept")
METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the metrics of whole texts (long; 0 for null texts).

    Words are runs of characters other than space and tab to carriage return.
    ``word_chars``: code points in words; ``n_symbols``: characters of
    ``#*$%&|<>``; ``n_lines``: lines with a word; ``n_dup_lines``: those equal
    to an earlier one; ``n_repeat_words``: words in windows of three words that
    the text has more than once, the first included. Columns of these names are
    replaced.
    """
    inner = unused(docs.columns, "text", "words", "lines", "hashes", "shift", "marked", "at")
    text_, words, lines, hashes, shift, marked, at = map(F.col, inner)
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in METRICS]
    split = docs.select(*rest, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(inner[0]))
    split = split.select(
        "*",
        F.array_remove(F.split(text_, WHITE), "").alias(inner[1]),
        F.filter(F.split(text_, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(inner[2]),
    )
    n = F.size(words)
    windows = F.when(n < _RUN, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - _RUN, F.lit(0))),
            lambda i: F.xxhash64(*(words[i + k] for k in range(_RUN))),
        )
    )
    counted = split.select(
        *rest,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text_, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        windows.alias(inner[3]),
    )
    # Windows in order of hash, then place: the place replaces the lowest bits
    # of the hash, so that longs are sorted and not structures.
    counted = counted.select("*", F.ceil(F.log2(F.size(hashes) + 2)).cast("int").alias(inner[4]))
    placed = F.transform(
        hashes, lambda h, i: _times(_over(h, shift), shift).bitwiseOR(i.cast("long"))
    )
    counted = counted.select("*", F.sort_array(placed).alias(inner[5]))
    last = F.size(marked) - 1
    repeated = F.filter(
        marked,
        lambda x, j: ((j > 0) & (_over(marked[j - 1], shift) == _over(x, shift)))
        | ((j < last) & (_over(marked[j + 1], shift) == _over(x, shift))),
    )
    # The hash without those bits may confuse windows that the whole one tells
    # apart (about one long text in a million); then structures are sorted.
    kinds = F.aggregate(
        F.transform(
            marked,
            lambda x, j: F.when(
                (j > 0) & (_over(marked[j - 1], shift) == _over(x, shift)), 0
            ).otherwise(1),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    low = _times(F.lit(1).cast("long"), shift) - 1
    short_way = F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low).cast("int")))
    counted = counted.select(
        "*",
        F.when(kinds == F.size(F.array_distinct(hashes)), short_way)
        .otherwise(_repeated_places(hashes))
        .alias(inner[6]),
    )
    spread = F.transform(
        at,
        lambda p, j: F.when(
            j < F.size(at) - 1, F.least(F.lit(_RUN), at[j + 1] - p)
        ).otherwise(_RUN),
    )
    repeat = F.aggregate(spread, F.lit(0), lambda a, b: a + b).cast("long")
    return counted.select("*", repeat.alias("n_repeat_words")).select(*rest, *METRICS)


def _repeated_places(hashes: Column) -> Column:
    """Places of hashes that occur twice or more."""
    order = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    runs = F.aggregate(
        order,
        F.struct(
            F.lit(None).cast("long").alias("h"),
            F.lit(-1).alias("i"),
            F.array().cast("array<int>").alias("found"),
        ),
        lambda seen, x: F.struct(
            x["h"].alias("h"),
            x["i"].alias("i"),
            F.when(
                seen["h"].eqNullSafe(x["h"]),
                F.concat(seen["found"], F.array(seen["i"], x["i"])),
            )
            .otherwise(seen["found"])
            .alias("found"),
        ),
    )
    return F.sort_array(F.array_distinct(runs["found"]))


def _over(x: Column, shift: Column) -> Column:
    return F.call_function("shiftright", x, shift)


def _times(x: Column, shift: Column) -> Column:
    return F.call_function("shiftleft", x, shift)


def host_rates(
    metrics: DataFrame, host: str = "source", rules: dict[str, str] = RULES
) -> DataFrame:
    """One row per host and rule: ``n`` documents, ``failed`` of them, and
    ``rate``, the share that fails, shrunk by a beta prior.

    The prior is fitted to the hosts by moments, for each rule by itself: its
    mean is the mean of their shares, and its weight follows from how much
    these differ beyond what chance gives hosts of their size. Where they don't,
    all hosts get the mean. Hosts with few documents are drawn to the mean most.
    Documents without a host are left out.
    """
    names = list(rules)
    failures = F.array(*(F.expr(rules[r]).cast("long") for r in names))
    tall = metrics.where(F.col(host).isNotNull()).select(
        F.col(host).alias("host"), F.posexplode(failures).alias("k", "fails")
    )
    hosts = tall.groupBy("host", "k").agg(F.count("fails").alias("n"), F.sum("fails").alias("failed"))
    hosts = materialize(hosts, "hosts")
    share = F.col("failed") / F.col("n")
    prior = hosts.groupBy("k").agg(
        F.avg(share).alias("mean"),
        F.var_pop(share).alias("spread"),
        F.avg(F.lit(1.0) / F.col("n")).alias("per_doc"),
    )
    noise = F.col("mean") * (1 - F.col("mean")) * F.col("per_doc")
    beyond = F.col("spread") - noise
    weight = F.when(beyond > 0, F.greatest(F.col("mean") * (1 - F.col("mean")) / beyond - 1, F.lit(0.0)))
    prior = F.broadcast(prior.select("k", "mean", weight.alias("weight")))
    rate = F.when(F.col("weight").isNull(), F.col("mean")).otherwise(
        (F.col("failed") + F.col("weight") * F.col("mean")) / (F.col("n") + F.col("weight"))
    )
    name = F.element_at(F.array(*map(F.lit, names)), F.col("k") + 1)
    return hosts.join(prior, "k").select("host", name.alias("rule"), "n", "failed", rate.alias("rate"))


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    most: float = 0.5,
    rules: dict[str, str] = RULES,
    base: tuple[str, ...] = BASE_RULES,
) -> DataFrame:
    """``docs`` without their text, with the metrics, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules and no rule's shrunk rate is
    above ``most`` at its host. Documents without a host are judged by the base
    rules alone. Null and empty texts have no words and fail the first rule.
    Rows that repeat are counted and judged each. The broadcast has one row per
    rule; verdicts are joined by host, and only of hosts that fail.
    """
    others = [c for c in docs.columns if c != text and c.lower() not in (*METRICS, *VERDICTS)]
    metrics = with_metrics(docs.select(text, *others), text).select(*others, *METRICS)
    metrics = materialize(metrics, "metrics")
    its_host, rejected = unused(metrics.columns, "host", "rejected")
    failing = (
        host_rates(metrics, host, rules)
        .where(F.col("rate") > most)
        .select(F.col("host").alias(its_host))
        .distinct()
        .withColumn(rejected, F.lit(True))
    )
    base_failed = F.expr(" or ".join(f"({rules[r]})" for r in base))
    joined = metrics.join(failing, metrics[host] == failing[its_host], "left")
    return joined.select(
        *others,
        *METRICS,
        base_failed.alias("base_failed"),
        (~base_failed & F.col(rejected).isNull()).alias("kept"),
    )
