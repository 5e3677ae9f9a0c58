"""Peer-multiple valuation: widening peer selection, value distributions, quantiles.

Peers are matched by code prefix (``startswith``).  Instead of scanning the
peer table once per target, every peer is exploded into the prefix keys it
answers to, ``(length, prefix)`` for each length up to the finest one plus
``(0, '')`` for "all peers", and targets look those keys up with equi-joins.
Work is peers + targets, never peers x targets (except in the explicit full
distribution, whose output is that product).

A target code shorter than the prefix length still matches by ``startswith``
and is reported at the longer length; an empty code matches every peer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.operators.quantiles import exact_quantiles
from dealsieve.schemas import nan_to_null, require_columns
from dealsieve.session import cpu_partitions

# Widening rule and reported quantiles (fixed values).
FINEST_CODE_LENGTH = 3
MINIMUM_PEER_COUNT = 8
DISTRIBUTION_QUANTILES = [0.10, 0.25, 0.50, 0.75, 0.90]
BLOCK_ROWS = 4096       # rows of one key, on either side, that meet in one block of the value distribution


def _peer_keys(peers: DataFrame, finest: int) -> DataFrame:
    """Each peer once per prefix key it matches: (plen, prefix, multiple)."""
    code = F.col("industry_code")
    keys = [F.struct(F.lit(0).alias("plen"), F.lit("").alias("prefix"))]
    for n in range(1, finest + 1):
        keys.append(F.when(F.length(code) >= n, F.struct(F.lit(n).alias("plen"),
                                                          F.substring(code, 1, n).alias("prefix"))))
    exploded = peers.select(F.explode(F.array(*keys)).alias("k"), "multiple").where(F.col("k").isNotNull())
    return exploded.select("k.plen", "k.prefix", "multiple")


def _code_keys(codes: DataFrame, finest: int) -> DataFrame:
    """Each code once per tried length L (finest..1, then 0) with its lookup key."""
    tries = []
    for n in list(range(finest, 0, -1)) + [0]:
        prefix = F.substring("_code", 1, n) if n else F.lit("")
        tries.append(F.struct(F.lit(n).alias("L"), F.length(prefix).alias("plen"), prefix.alias("prefix")))
    return codes.select("_code", F.explode(F.array(*tries)).alias("t")).select("_code", "t.L", "t.plen", "t.prefix")


def widened(targets: DataFrame, peers: DataFrame, finest: int = FINEST_CODE_LENGTH,
            minimum: int = MINIMUM_PEER_COUNT) -> DataFrame:
    """Every target row, columns unchanged, with code_length_used, peer_count and its lookup key
    (key_length, key_prefix).

    The finest length with at least ``minimum`` peers wins; if none does, all
    peers are used with length 0 and no minimum.  The choice depends on the
    code only, so it is made once per distinct code and joined back: rows of
    one company stay apart.
    """
    require_columns(targets, ["company_number", "industry_code"], "targets")
    require_columns(peers, ["industry_code", "multiple"], "peers")
    coded = targets.withColumn("_code", F.coalesce("industry_code", F.lit("")))
    counts = _peer_keys(peers, finest).groupBy("plen", "prefix").agg(F.count(F.lit(1)).alias("n"))
    tried = _code_keys(coded.select("_code").distinct(), finest).join(counts, ["plen", "prefix"], "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)))
    ok = (F.col("n") >= minimum) | (F.col("L") == 0)         # the largest L with enough peers; 0 always qualifies
    chosen = tried.where(ok).groupBy("_code").agg(F.max(F.struct("L", "plen", "prefix", "n")).alias("c"))
    return coded.join(chosen, "_code").select(
        *targets.columns, F.col("c.L").cast("int").alias("code_length_used"), F.col("c.n").alias("peer_count"),
        F.col("c.plen").alias("key_length"), F.col("c.prefix").alias("key_prefix"))


def peer_widening(targets: DataFrame, peers: DataFrame, finest: int = FINEST_CODE_LENGTH,
                  minimum: int = MINIMUM_PEER_COUNT) -> DataFrame:
    """Code length used and peer count per target row, plus the chosen lookup key."""
    return widened(targets, peers, finest, minimum).select(
        "company_number", "industry_code", "code_length_used", "peer_count", "key_length", "key_prefix")


def _keyed_multiples(peers: DataFrame, finest: int) -> DataFrame:
    return _peer_keys(nan_to_null(peers), finest).withColumnRenamed("plen", "key_length") \
        .withColumnRenamed("prefix", "key_prefix")


def key_multiples(targets: DataFrame, peers: DataFrame, finest: int = FINEST_CODE_LENGTH) -> DataFrame:
    """(key_length, key_prefix, multiple): the peers of every key that a ``widened`` target uses.

    With the targets' keys this is the whole of the value distributions in
    peers + targets rows; ``value_distribution`` expands it.
    """
    return _keyed_multiples(peers, finest).join(targets.select("key_length", "key_prefix").distinct(), ["key_length", "key_prefix"], "left_semi")


def value_distribution(targets: DataFrame, peers: DataFrame, finest: int = FINEST_CODE_LENGTH,
                       minimum: int = MINIMUM_PEER_COUNT, requested: DataFrame | None = None) -> DataFrame:
    """Every peer multiple applied to the target's scaling value, kept whole (one row per target row and peer).

    The output is targets x their peers; ``requested`` (company_number) limits
    it to the companies asked for before anything is expanded.  Targets and
    peers of a key are dealt into blocks, and each pair of blocks meets on its
    own, so a key that very many rows use (such as all peers) is the work of
    many tasks.  Equal multiples of a key travel as one row and its count and
    are written side by side, where they and their values compress.
    """
    require_columns(targets, ["company_number", "industry_code", "scaling_value"], "targets")
    rows = widened(nan_to_null(targets), peers, finest, minimum)
    if requested is not None:
        rows = rows.join(requested.select("company_number").distinct(), "company_number", "left_semi")
    key, block = ["key_length", "key_prefix"], ["_target_block", "_peer_block"]
    blocks = rows.groupBy(*key).agg(_blocks(F.count(F.lit(1))).alias("_target_blocks"),
                                    _blocks(F.max("peer_count")).alias("_peer_blocks"))

    def dealt(side: DataFrame, own: str, other: str, place) -> DataFrame:
        """Each row in one block of its own side, copied to every block of the other one."""
        return side.join(blocks, key).withColumn(f"_{own}_block", F.pmod(place, F.col(f"_{own}_blocks"))) \
            .withColumn(f"_{other}_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}_blocks") - 1))) \
            .repartition(cpu_partitions(side.sparkSession), *key, *block)
    one = dealt(rows.select(*key, "company_number", "code_length_used", "scaling_value")
                .withColumn("_row", F.monotonically_increasing_id()), "target", "peer", F.col("_row"))
    # A multiple that very many peers have is cut into pieces, which go to blocks of their own.
    counted = _keyed_multiples(peers, finest).groupBy(*key, "multiple").agg(F.count(F.lit(1)).alias("_n"))
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), _blocks(F.col("_n")) - 1))) \
        .withColumn("_n", F.least(F.lit(BLOCK_ROWS), F.col("_n") - F.col("_piece") * BLOCK_ROWS).cast("int"))
    two = dealt(pieces, "peer", "target", F.xxhash64("multiple", "_piece")) \
        .select(*key, *block, "multiple", F.array_repeat(F.lit(0).cast("byte"), F.col("_n")).alias("_copies"))
    return one.join(two, [*key, *block]).select(
        "company_number", "code_length_used", "multiple",
        (F.col("scaling_value") * F.col("multiple")).alias("estimated_value"), F.explode("_copies").alias("_copy")).drop("_copy")


def _blocks(rows):
    return F.greatest(F.ceil(rows / F.lit(BLOCK_ROWS)), F.lit(1)).cast("long")


def valuation_quantiles(targets: DataFrame, peers: DataFrame, finest: int = FINEST_CODE_LENGTH,
                        minimum: int = MINIMUM_PEER_COUNT,
                        quantiles: list[float] = DISTRIBUTION_QUANTILES) -> DataFrame:
    """Peer count, length used and value quantiles per target row.

    Linear quantiles commute with scaling: q_p(s*m) = s*q_p(m) for s >= 0 and
    s*q_(1-p)(m) for s < 0.  So quantiles are computed once per prefix key, on
    the multiples, and each target rescales them: cost is peers + targets.
    The quantile list must be symmetric for the reversal (it is).
    """
    require_columns(targets, ["company_number", "industry_code", "scaling_value"], "targets")
    rows = widened(nan_to_null(targets), peers, finest, minimum)
    per_key = exact_quantiles(key_multiples(rows, peers, finest), ["key_length", "key_prefix"], "multiple",
                              quantiles).drop("n")
    joined = rows.join(per_key, ["key_length", "key_prefix"], "left")
    s = F.col("scaling_value")
    k = len(quantiles)
    cols = []
    for i, q in enumerate(quantiles):
        up, down = F.col(f"q{i}"), F.col(f"q{k - 1 - i}")
        cols.append(F.when(s >= 0, s * up).otherwise(s * down).alias(f"value_quantile_{int(round(q * 100))}"))
    return joined.select("company_number", "peer_count", "code_length_used", *cols)
