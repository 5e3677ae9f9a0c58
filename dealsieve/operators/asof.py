"""Point-in-time (as-of) join: the latest fact knowable at each decision date.

For every (company, decision_date) keep the fact with the greatest
``fact_date <= decision_date``; ties on ``fact_date`` are broken by the
caller's tie keys (descending), then by the remaining fact columns, so the
answer is deterministic.

Both strategies of ``as_of`` first pre-aggregate the facts per (company, fact_date).  The
pick is a ``max`` over a struct whose first field is the fact date, which is
associative, so this is exact and Spark runs it as a partial (map-side)
aggregate: a company that owns a third of all fact rows is combined on the
map side before it is shuffled.

* ``join``  equi-joins the pre-aggregated facts to the distinct decisions on
  the company, filters ``fact_date <= decision_date`` and takes the struct
  max per (company, decision_date).  Work grows as facts x dates per company,
  so use it for few decision dates per company.
* ``scan``  unions facts and decisions and runs a running struct max in time
  order.  To keep a hot company out of a single task the running max is
  computed in two levels: inside (company, month) partitions, plus a prefix
  max over the per-month maxima of earlier months.  Work grows as facts +
  dates, independent of how many dates each company has.

``decision_rows`` asks for several fact tables at once.  Its ``merge``
strategy makes one pass for all of them: facts and decisions become one
stream of events, exchanged once by (company, month), and each table has its
own running struct max over that one sorted stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The reference's fixed order for assembling decision rows (fixed values).
FACT_TABLE_ORDER = ["filings", "tenders", "charges", "ownership"]

_FACT = "_fact"
_DAY = "_fact_day"


def _fact_struct(facts: DataFrame, key: str, fact_date: str, tie_keys: Sequence[str]):
    rest = [c for c in facts.columns if c not in (key, fact_date, *tie_keys)]
    return F.struct(*[F.col(f"`{c}`") for c in (*tie_keys, *rest)]), [*tie_keys, *rest]


def _pre_aggregate(facts: DataFrame, key: str, fact_date: str, tie_keys: Sequence[str]):
    """One row per (company, fact_date): the tie-key-greatest fact of that instant."""
    payload, payload_cols = _fact_struct(facts, key, fact_date, tie_keys)
    daily = (facts.where(F.col(key).isNotNull() & F.col(fact_date).isNotNull())
             .groupBy(key, fact_date).agg(F.max(payload).alias(_FACT)))
    return daily, payload_cols


def as_of(facts: DataFrame, decisions: DataFrame, key: str = "company_number",
          fact_date: str = "fact_date", decision_date: str = "decision_date",
          tie_keys: Sequence[str] = (), strategy: str = "join") -> DataFrame:
    """Latest fact per distinct (key, decision_date); decisions without a fact are absent.

    Output columns: key, decision_date, fact_date, tie keys, other fact columns.
    Null fact or decision dates never match (the ``<=`` is false for null).
    """
    for c in (key, fact_date, *tie_keys):
        if c not in facts.columns:
            raise ValueError(f"facts lack column {c!r}")
    daily, payload_cols = _pre_aggregate(facts, key, fact_date, tie_keys)
    wanted = (decisions.select(key, decision_date)
              .where(F.col(key).isNotNull() & F.col(decision_date).isNotNull())
              .distinct())
    if strategy == "join":
        best = (daily.join(wanted, key, "inner")
                .where(F.col(fact_date) <= F.col(decision_date))
                .groupBy(key, decision_date)
                .agg(F.max(F.struct(F.col(fact_date).alias("d"), F.col(_FACT).alias("f"))).alias("_best")))
    elif strategy == "scan":
        best = _scan_best(daily, wanted, key, fact_date, decision_date)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = best.select(
        key, decision_date,
        F.col("_best.d").alias(fact_date),
        *[F.col(f"_best.f.`{c}`").alias(c) for c in payload_cols],
    )
    return guard_no_future_facts(out, fact_date, decision_date)


def _scan_best(daily: DataFrame, wanted: DataFrame, key: str, fact_date: str, decision_date: str) -> DataFrame:
    """Two-level running max in time order (see module docstring)."""
    t, kind, bucket = "_t", "_kind", "_bucket"
    best_type = F.struct(F.col(fact_date).alias("d"), F.col(_FACT).alias("f"))
    fact_rows = daily.select(key, F.col(fact_date).alias(t), F.lit(0).alias(kind), best_type.alias("_v"))
    null_best = F.lit(None).cast(fact_rows.schema["_v"].dataType)
    decision_rows = wanted.select(key, F.col(decision_date).alias(t), F.lit(1).alias(kind), null_best.alias("_v"))
    events = fact_rows.unionByName(decision_rows).withColumn(bucket, F.date_trunc("month", F.col(t)))

    # Level 1: running max inside (company, month); facts sort before decisions on equal time.
    inner = Window.partitionBy(key, bucket).orderBy(t, kind).rowsBetween(Window.unboundedPreceding, 0)
    within = (events.withColumn("_within", F.max("_v").over(inner))
              .where(F.col(kind) == 1)
              .select(key, bucket, F.col(t).alias(decision_date), "_within"))

    # Level 2: max of all earlier months, from one summary row per (company, month).
    per_month = events.groupBy(key, bucket).agg(F.max("_v").alias("_month_best"))
    earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    prior = per_month.select(key, bucket, F.max("_month_best").over(earlier).alias("_prior"))

    return (within.join(prior, [key, bucket], "left")
            .select(key, decision_date, F.greatest("_within", "_prior").alias("_best"))
            .where(F.col("_best").isNotNull()))


def guard_no_future_facts(df: DataFrame, fact_date: str = "fact_date",
                          decision_date: str = "decision_date") -> DataFrame:
    """Inline leak guard: the job fails if any row has fact_date > decision_date."""
    leak = F.col(fact_date) > F.col(decision_date)
    guarded = F.when(leak, F.raise_error(F.lit("point in time leak: fact dated after its decision date"))) \
        .otherwise(F.col(fact_date))
    return df.withColumn(fact_date, guarded.cast(df.schema[fact_date].dataType))


def future_fact_leaks(df: DataFrame, fact_date: str = "fact_date",
                      decision_date: str = "decision_date") -> DataFrame:
    """One-row table with the number of rows that leak and of rows checked (lazy form of the guard)."""
    return df.agg(F.count_if(F.col(fact_date) > F.col(decision_date)).alias("leak_count"),
                  F.count(F.lit(1)).alias("rows_checked"))


def assert_no_future_facts(df: DataFrame, fact_date: str = "fact_date",
                           decision_date: str = "decision_date") -> None:
    """Eager check: raises ValueError with the number of leaking rows."""
    leaked = future_fact_leaks(df, fact_date, decision_date).first()["leak_count"]
    if leaked:
        raise ValueError(f"Point in time leak, {leaked} facts dated after their decision date")


def decision_rows(decisions: DataFrame, fact_tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
                  key: str = "company_number", decision_date: str = "decision_date",
                  fact_date: str = "fact_date", order: Sequence[str] = FACT_TABLE_ORDER,
                  strategy: str = "merge", bucket: str = "month") -> DataFrame:
    """One row per input decision row with every fact table's as-of columns.

    ``fact_tables`` maps table name -> (facts, tie_keys).  Absent tables are
    skipped; every fact column comes out as ``<table>__<column>`` so nothing
    collides.  Rows out = rows in: repeated decisions stay, and those without
    a company or a date have no facts.  ``merge`` reads all tables in one
    pass; ``join`` and ``scan`` make one as-of join per table.
    """
    present = {name: fact_tables[name] for name in order if fact_tables.get(name) is not None}
    if strategy == "merge":
        return _merged_rows(decisions, present, key, decision_date, fact_date, bucket)
    out = decisions
    for name, (facts, tie_keys) in present.items():
        latest = as_of(facts, decisions, key, fact_date, decision_date, tie_keys, strategy)
        renamed = latest.select(key, decision_date, *[
            F.col(f"`{c}`").alias(f"{name}__{c}") for c in latest.columns if c not in (key, decision_date)
        ])
        out = out.join(renamed, [key, decision_date], "left")
    return out


def _merged_rows(decisions: DataFrame, tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
                 key: str, decision_date: str, fact_date: str, bucket: str) -> DataFrame:
    """The ``merge`` strategy of ``decision_rows``.

    An event is (company, month, one best fact per table, decision row).  The
    facts of all tables are first combined per (company, time) by one partial
    aggregate.  The exchange by (company, month) then feeds two readers: the
    running max inside each month, and one summary row per company and month,
    whose running max over the earlier months is joined back.  No task sorts
    more than one month of one company.
    """
    if not tables:
        return decisions
    k, month, row = "_key", "_month", "_row"
    slots = {name: f"_best_{i}" for i, name in enumerate(tables)}
    payloads, tagged = {}, []
    for name, (facts, tie_keys) in tables.items():
        for c in (key, fact_date, *tie_keys):
            if c not in facts.columns:
                raise ValueError(f"facts of {name!r} lack column {c!r}")
        payload, payloads[name] = _fact_struct(facts, key, fact_date, tie_keys)
        at = F.col(f"`{fact_date}`")
        tagged.append((name, facts.where(at.isNotNull()).select(
            F.col(f"`{key}`").alias(k), at.alias("_at"), F.struct(at.alias("d"), payload.alias("f")).alias("_v"))))
    kinds = {name: t.schema["_v"].dataType for name, t in tagged}

    def event(df, own=None):
        """``df`` with one column per table: its own fact in its own column, nulls elsewhere."""
        return [(F.col("_v") if name == own else F.lit(None).cast(kinds[name])).alias(slots[name]) for name in tables]

    facts = reduce(DataFrame.unionByName, [t.select(k, "_at", *event(t, name)) for name, t in tagged])
    facts = facts.groupBy(k, "_at").agg(*[F.max(slot).alias(slot) for slot in slots.values()])
    row_struct = F.struct(*[F.col(f"`{c}`") for c in decisions.columns])
    dated = F.col(f"`{key}`").isNotNull() & F.col(f"`{decision_date}`").isNotNull()
    rows = decisions.where(dated).select(F.col(f"`{key}`").alias(k), F.col(f"`{decision_date}`").alias("_at"),
                                         row_struct.alias(row))
    events = (facts.withColumn(row, F.lit(None).cast(rows.schema[row].dataType))
              .unionByName(rows.select(k, "_at", row, *event(rows)))
              .select(k, F.date_trunc(bucket, F.col("_at")).alias(month), row, *slots.values())
              .where(F.col(k).isNotNull() & F.col(month).isNotNull())
              .repartition(k, month))

    # The time of an event is that of its decision or of its facts, which all share it; facts come before
    # decisions of the same time.  Both readers use the same columns, so that one exchange serves both.
    at = F.coalesce(F.col(f"{row}.`{decision_date}`"), *[F.col(slot)["d"] for slot in slots.values()])
    running = Window.partitionBy(k, month).orderBy(at, F.col(row).isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    within = (events.select(k, month, row, *[F.max(slot).over(running).alias(slot) for slot in slots.values()])
              .where(F.col(row).isNotNull()))
    months = events.groupBy(k, month).agg(F.max(F.col(row).isNotNull()).alias("_asked"),
                                          *[F.max(slot).alias(slot) for slot in slots.values()])
    earlier = Window.partitionBy(k).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    prior = (months.select(k, month, "_asked",
                           *[F.max(slot).over(earlier).alias(f"_prior{slot}") for slot in slots.values()])
             .where("_asked").drop("_asked"))

    best = within.join(prior, [k, month]).select(
        row, *[F.greatest(slot, f"_prior{slot}").alias(slot) for slot in slots.values()])
    columns = [F.col(f"{row}.`{c}`").alias(c) for c in decisions.columns]
    for name, slot in slots.items():
        columns.append(F.col(slot)["d"].alias(f"{name}__{fact_date}"))
        columns += [F.col(slot)["f"][c].alias(f"{name}__{c}") for c in payloads[name]]
    out = best.select(*columns)
    for name in tables:
        out = guard_no_future_facts(out, f"{name}__{fact_date}", decision_date)
    undated = decisions.where(~dated).select(
        *[F.col(f"`{c}`") for c in decisions.columns],
        *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in out.columns[len(decisions.columns):]])
    return out.unionByName(undated)
