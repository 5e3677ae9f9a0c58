"""Quality rules per document and verdicts per host, in DataFrame functions only.

Each document gets its base counts from array functions inside its own row (no
explode, no shuffle of words).  Failures of four rules are summed by host
(``source``) with a partial aggregate.  A beta prior is fitted to the hosts'
failure rates by moments, and each host's rate is shrunk towards it.  A host is
rejected if for some rule the lower bound of its shrunk rate, ``BOUND``
standard deviations of its beta distribution below the mean, passes
``HOST_LIMIT``: small hosts need more evidence, large ones stand on their own
figures, and bad hosts do not shift the limit by widening the prior.  The host
table is joined back to the slim document table.

Rules: fewer than 50 words; more than 50 % of words in repeated 3-word
windows (these two decide ``base_failed``); more than 10 symbols per 100 word
characters; more than 30 % of lines repeated.

Defined results: a null text counts as empty (no words, so it fails the first
rule); a null source is a host of its own; repeated rows are judged each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import WHITE, materialise, text_or_empty

SYMBOLS = "#*$%&|<>"     # counted symbols (fixed value)
HOST_LIMIT = 0.3         # a host whose failure rate may lie below this is not rejected
BOUND = 1.645            # standard deviations to a bound: one side, 95 % of a normal distribution
RULES = ["short", "repeats", "symbols", "dup_lines"]


def _repeated_words(words):
    """Words inside 3-word windows that occur twice or more in the list.

    The windows are sorted with their positions, so equal ones are neighbours;
    each repeated window covers three words, and overlapping ones are counted
    once by the gap to the next repeated window.
    """
    n = F.size(words)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    placed = F.sort_array(F.transform(starts, lambda i: F.struct(window(i).alias("w"), i.alias("i"))))
    return placed


def _equal_neighbours(placed):
    """Sorted distinct positions of the windows equal to a neighbour in ``placed``."""
    following = F.slice(placed, F.lit(2), F.greatest(F.size(placed), F.lit(1)))
    pairs = F.zip_with(placed, following, lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _covered(positions):
    following = F.slice(positions, F.lit(2), F.greatest(F.size(positions), F.lit(1)))
    gaps = F.zip_with(positions, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """doc_id, _host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed."""
    t = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").alias("_host"),
                    text_or_empty(text_col).alias("_text"))
    words = F.filter(F.split("_text", WHITE), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.select("doc_id", "_host", words.alias("_words"), lines.alias("_lines"),
                 (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).alias("n_symbols"),
                 F.length(F.regexp_replace("_text", WHITE, "")).alias("word_chars"))
    t = t.select("*", F.size("_words").alias("n_words"), F.size("_lines").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
                 _repeated_words(F.col("_words")).alias("_placed")).drop("_words", "_lines")
    t = t.select("*", _equal_neighbours(F.col("_placed")).alias("_at")).drop("_placed")
    t = t.select("*", _covered(F.col("_at")).alias("n_repeat_words")).drop("_at")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    short, repeats = F.col("n_words") < 50, 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    return t.select("doc_id", "_host", *[F.col(c).cast("long").alias(c) for c in counts]).select(
        "*", short.alias("short"), repeats.alias("repeats"),
        (10 * F.col("n_symbols") > F.col("word_chars")).alias("symbols"),
        (100 * F.col("n_dup_lines") > 30 * F.col("n_lines")).alias("dup_lines"),
        (short | repeats).alias("base_failed"))


def host_verdicts(counts: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(_host, host_docs, rate_<rule>, host_ok): failure rates shrunk by a beta prior over hosts.

    The prior's mean and strength come from the hosts' rates by moments: with
    mean m and variance v, strength = m (1 - m) / v - 1, at least 1 (hosts that
    differ wildly) and at most 1,000 (hosts that barely differ).
    """
    hosts = counts.groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"),
                                        *[F.count_if(r).alias(f"fails_{r}") for r in RULES])
    rate = {r: F.col(f"fails_{r}") / F.col("host_docs") for r in RULES}
    moments = hosts.agg(*[F.avg(rate[r]).alias(f"m_{r}") for r in RULES],
                        *[F.var_pop(rate[r]).alias(f"v_{r}") for r in RULES]).first()
    shrunk, ok = [], F.lit(True)
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        strength = min(max(m * (1 - m) / v - 1, 1.0), 1000.0) if v > 0 else 1000.0
        weight = F.col("host_docs") + F.lit(strength)
        mean = (F.col(f"fails_{r}") + F.lit(m * strength)) / weight
        shrunk.append(mean.alias(f"rate_{r}"))
        ok = ok & (mean - BOUND * F.sqrt(mean * (1 - mean) / (weight + 1)) <= F.lit(limit))
    return hosts.select("_host", "host_docs", *shrunk, ok.alias("host_ok"))


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    limit: float = HOST_LIMIT) -> DataFrame:
    """Base counts, base_failed, the host's rates and verdict, and ``kept`` for every row."""
    counts = materialise(base_counts(docs, id_col, text_col, host_col), "quality-counts")
    hosts = materialise(host_verdicts(counts, limit), "quality-hosts")
    joined = counts.join(hosts, counts["_host"].eqNullSafe(hosts["_host"])).drop(hosts["_host"])
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")) \
        .withColumnRenamed("_host", "host")
