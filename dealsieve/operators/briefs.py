"""Written briefs: screened-candidate intake, rendering, and the dispatch queue.

The intake splits each CSV line on every comma (no quoting, trailing empty
fields kept) and keeps rows with exactly the header's field count; the rest
go to a quarantine table instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.functions.text import is_abstained
from dealsieve.operators.pairs import with_each
from dealsieve.schemas import DISPATCH_LOG, SCREENED_FIELDS, SCREENED_OPTIONAL_FIELD

# Brief wording (fixed values, in the order they appear in a brief).
ABSTAINED_STATUS = "abstained"
ABSTAINED_LINE = ("ABSTAINED. The screen declined to score this company. "
                  "Do not treat the figures below as a recommendation.")
SCORED_LINE = "Scored. The screen returned a usable result for this company."
CAUSAL_LABEL = "causal"
ASSOCIATIONAL_LABEL = "associational"
LEVER_WARNING = ("An associational lever describes what moves with the outcome, not what causes it. "
                 "Do not act on one without separate evidence.")
SKIPPED_OUTCOME = "skipped_abstained"
QUEUED_OUTCOME = "queued"
NO_RECIPIENT = "none"
HEADER_START = "company_number,"


def read_screened(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(accepted candidates, quarantined lines) from the lines of the screened-candidate CSV.

    Header lines (starting ``company_number,``) are skipped.  A header with the
    optional tenth column ``lever_evidence_type`` makes ten fields the expected
    count; otherwise nine.
    """
    header = lines.where(F.col(value).startswith(HEADER_START))
    has_tenth = header.agg(F.max(F.col(value).contains(SCREENED_OPTIONAL_FIELD).cast("int")).alias("t")) \
        .first()["t"] == 1
    names = SCREENED_FIELDS + ([SCREENED_OPTIONAL_FIELD] if has_tenth else [])
    body = lines.where(~F.col(value).startswith(HEADER_START)).withColumn("_f", F.split(value, ",", -1))
    ok = F.size("_f") == len(names)
    accepted = body.where(ok).select(*[F.col("_f")[i].alias(n) for i, n in enumerate(names)])
    if not has_tenth:
        accepted = accepted.withColumn(SCREENED_OPTIONAL_FIELD, F.lit(None).cast("string"))
    quarantined = body.where(~ok).select(F.col(value).alias("line"), F.size("_f").alias("field_count"),
                                         F.lit(len(names)).alias("expected_count"))
    return accepted, quarantined


def render_briefs(candidates: DataFrame) -> DataFrame:
    """(company_number, brief_text): abstention line first, then identity, probability and
    interval, drivers, comparables, levers (with evidence type when given) and the warning."""
    c = F.col
    levers = F.when(F.coalesce(c(SCREENED_OPTIONAL_FIELD), F.lit("")) != "",
                    F.concat(c("counterfactual_levers"), F.lit(" ["), c(SCREENED_OPTIONAL_FIELD), F.lit("]"))) \
        .otherwise(c("counterfactual_levers"))
    first = F.when(c("abstention_status") == ABSTAINED_STATUS, F.lit(ABSTAINED_LINE)).otherwise(F.lit(SCORED_LINE))
    text = F.concat(
        first, F.lit("\n\n"),
        F.lit("Company: "), c("company_name"), F.lit(" ("), c("company_number"), F.lit(")\n\n"),
        F.lit("Calibrated probability: "), c("probability"), F.lit(" (interval "), c("interval_lower"),
        F.lit(" to "), c("interval_upper"), F.lit(")\n\n"),
        F.lit("Top drivers:\n"), c("top_drivers"), F.lit("\n\n"),
        F.lit("Nearest comparable companies:\n"), c("comparable_companies"), F.lit("\n\n"),
        F.lit(f"Counterfactual levers, marked {CAUSAL_LABEL} or {ASSOCIATIONAL_LABEL}:\n"), levers, F.lit("\n\n"),
        F.lit(LEVER_WARNING + "\n"))
    return candidates.select("company_number", text.alias("brief_text"))


def dispatch_queue(briefs: DataFrame, recipients: DataFrame) -> DataFrame:
    """One row per (brief, recipient) to send; an abstained brief gives one skipped row.

    ``recipients`` is a table with a ``recipient`` column.
    """
    judged = briefs.select(F.col("company_number").alias("brief"), is_abstained("brief_text").alias("_a"))
    queued = with_each(judged.where(~F.col("_a")).select("brief"), recipients.select("recipient")) \
        .select("recipient", "brief", F.lit(QUEUED_OUTCOME).alias("outcome"))
    skipped = judged.where("_a").select(F.lit(NO_RECIPIENT).alias("recipient"), "brief",
                                        F.lit(SKIPPED_OUTCOME).alias("outcome"))
    return queued.unionByName(skipped)


def write_briefs(briefs: DataFrame, path: str) -> None:
    """One table of briefs (company_number, brief_text)."""
    briefs.select("company_number", "brief_text").write.mode("overwrite").parquet(path)


def append_dispatch_log(queue: DataFrame, path: str) -> None:
    """Append dispatch rows stamped with the send time."""
    stamped = queue.withColumn("sent_at", F.localtimestamp())
    stamped.select(*DISPATCH_LOG.fieldNames()).write.mode("append").parquet(path)
