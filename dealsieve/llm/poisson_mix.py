"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's mean repetition rate is (target share x all bytes) / (its bytes).
Each document's count is drawn from the Poisson distribution with that mean by
inverting its distribution function at a number hashed from the document's id
and a seed, so a rerun or a retried task gives the same counts.  Documents are
exploded by their counts, and the copies are shuffled globally by a hash.

A rate above ``CHUNK_RATE`` is split into equal parts, each inverted at a
number of its own; a sum of independent Poisson counts is Poisson with the
summed mean, and no part's probabilities underflow.

Target shares: given per source, or proportional to bytes ** ``SMOOTHING``
(0.5: between natural and uniform).  The rate table has one row per source;
it is joined without a broadcast hint, as sources grow with the input.

Defined results: a null source is a source of its own; a null text has no
bytes but its row is still drawn; rows with a null id draw by their text;
repeated rows draw the same count; a source missing from given shares gets
rate 0; sources with no bytes at all keep rate 1; an empty table gives an
empty result; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise, text_or_empty

CHUNK_RATE = 8.0   # largest mean inverted at once
TERMS = 64         # terms of the inverted sum: P(count > 64) < 1e-30 at mean 8, below a double's resolution of 1
SMOOTHING = 0.5
SEED = 1


def uniform(*parts):
    """A number in [0, 1) from the first 52 bits of an MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def invert_poisson(u, rate):
    """Smallest k with P(Poisson(rate) <= k) > u, for rates up to ``CHUNK_RATE``."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))

    def step(acc, i):
        p = acc["p"] * rate / i
        more = F.struct(p.alias("p"), (acc["c"] + p).alias("c"), (acc["k"] + 1).alias("k"))
        return F.when(u >= acc["c"], more).otherwise(acc)
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["k"])


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                 shares: dict[str, float] | None = None) -> DataFrame:
    """(source, rate): mean repetitions of a document of that source."""
    size = F.octet_length(text_or_empty(text_col)).cast("long")
    per = docs.groupBy(F.col(f"`{source_col}`").alias("_source")).agg(F.sum(size).alias("_bytes"))
    if shares is None:
        weighted = per.withColumn("_weight", F.pow(F.col("_bytes").cast("double"), F.lit(SMOOTHING)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()],
                                                  "_given string, _weight double")
        weighted = per.join(given, per["_source"].eqNullSafe(given["_given"]), "left") \
            .select("_source", "_bytes", F.coalesce("_weight", F.lit(0.0)).alias("_weight"))
    total = weighted.agg(F.sum("_bytes").alias("bytes"), F.sum("_weight").alias("weights")).first()
    mean = F.col("_weight") / F.lit(total.weights or 1.0) * F.lit(float(total.bytes or 0)) / F.col("_bytes")
    return weighted.select("_source", F.when(F.col("_bytes") > 0, mean).otherwise(F.lit(1.0)).alias("_rate"))


def replicate(docs: DataFrame, shares: dict[str, float] | None = None, id_col: str = "doc_id",
              source_col: str = "source", text_col: str = "text", seed: int = SEED,
              details: bool = False) -> DataFrame:
    """Every copy of every drawn document, globally shuffled, with the input's columns.

    ``details`` adds ``copy`` (from 1), ``copies`` (the document's count),
    ``rate`` and ``mix_key`` (the shuffle's order) in place of input columns
    of these names.
    """
    rates = materialise(source_rates(docs, source_col, text_col, shares), "mix-rates")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(f"`{source_col}`").alias("_source"),
                        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"), F.lit("")).alias("_key"))
    joined = inner.join(rates, inner["_source"].eqNullSafe(rates["_source"])).drop("_source")
    rate = F.col("_rate")
    parts = F.greatest(F.ceil(rate / CHUNK_RATE), F.lit(1)).cast("int")
    draws = F.transform(F.sequence(F.lit(1), parts), lambda j: invert_poisson(
        uniform(F.col("_key"), F.lit(str(seed)), j.cast("string")), rate / parts))
    counted = joined.withColumn("_n", F.aggregate(draws, F.lit(0), lambda a, x: a + x)) \
        .where((F.col("_n") > 0) & (rate > 0))
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    key = F.md5(F.concat_ws(":", "_key", F.lit(str(seed)), F.lit("order"), F.col("_copy").cast("string")))
    mixed = copies.withColumn("_mix", key)
    shuffled = mixed.repartition("_mix").sortWithinPartitions("_mix")
    made = {"copy": "_copy", "copies": "_n", "rate": "_rate", "mix_key": "_mix"} if details else {}
    return shuffled.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in made],
                           *[F.col(own).alias(name) for name, own in made.items()])
