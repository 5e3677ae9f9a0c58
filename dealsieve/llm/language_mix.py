"""Language identification by mixture inference.

Training counts hashed character trigrams per language over all labelled
documents: each task sums its documents, Spark adds the sums up.  A document
is then explained as a mixture of languages: expectation-maximisation finds
the proportions that make its trigrams most likely, and the set of languages
is chosen by penalised likelihood, dropping the smallest share while that does
not cost more than the penalty per language.  The prediction is the largest
share of the chosen set, the score is that share.

The model has one row of ``BINS`` numbers per label value, whatever the
number of documents; that bounds what is collected and shipped.

Defined results: a null text, or one without a letter, is ``und`` with score
0; null or empty labels are not learned; with no labelled document every
prediction is ``und``; repeated rows count each; an empty table gives an empty
result; extra columns are ignored (or carried along by ``keep_identified``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.llm.common import ship_by_value, small_batches, text_or_empty

BINS = 1 << 15
UNDETERMINED = "und"
SMOOTHING = 0.5       # added to every trigram count
STEPS = 30            # most steps of one fit
SETTLED = 1e-3        # a fit ends when no share moves more
PENALTY = 3.0         # log-likelihood that one more language must earn, times log(trigrams)
MIN_SHARE = 0.5       # share below which ``keep_identified`` rejects a document

NOT_LETTERS = re.compile(r"[\W\d_]+")
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("langs", T.ArrayType(T.StringType())),
                       T.StructField("shares", T.ArrayType(T.DoubleType()))])


def trigram_bins(text: str | None) -> np.ndarray | None:
    """Bins of the text's trigrams (lower case, words framed by blanks); None without a letter."""
    letters = NOT_LETTERS.sub(" ", (text or "").lower())
    if not letters.strip():
        return None
    codes = np.frombuffer(f" {letters.strip()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes.astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             + codes[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)


def learnable(id_col: str = "doc_id"):
    """True for the documents that may be learned from: crc32 of the id's text, mod 3, is not 1."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(3)) != 1


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their trigram probabilities, from every row with a label."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                bins = trigram_bins(text.as_py())
                if bins is not None:
                    own = sums.setdefault(lang, np.zeros(BINS, np.int64))
                    own += np.bincount(bins, minlength=BINS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                              "bin": pa.array(at.astype(np.int32)), "n": pa.array(own[at])})

    labelled = small_batches(docs).where(F.col(f"`{lang_col}`").isNotNull() & (F.col(f"`{lang_col}`") != "")) \
        .select(F.col(f"`{lang_col}`").alias("lang"), text_or_empty(text_col).alias("text"))
    sums = labelled.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin") \
        .agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    table = np.full((len(langs), BINS), SMOOTHING)
    where = {lang: i for i, lang in enumerate(langs)}
    np.add.at(table, (sums["lang"].map(where).to_numpy(dtype=np.int64), sums["bin"].to_numpy(dtype=np.int64)),
              sums["n"].to_numpy(dtype=np.float64))
    return langs, (table / table.sum(axis=1, keepdims=True)) if langs else table


def fit_shares(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture shares and log-likelihood, by expectation-maximisation."""
    total = counts.sum()
    shares = np.full(likely.shape[1], 1.0 / likely.shape[1])
    for _ in range(STEPS):
        nxt = shares * (likely.T @ (counts / (likely @ shares))) / total
        done = np.abs(nxt - shares).max() < SETTLED
        shares = nxt
        if done:
            break
    return shares, float(counts @ np.log(likely @ shares))


def explain(bins: np.ndarray, model: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Chosen languages and their shares, largest first."""
    at, counts = np.unique(bins, return_counts=True)
    likely, counts = np.ascontiguousarray(model[:, at].T), counts.astype(np.float64)
    penalty = PENALTY * np.log(counts.sum() + 1.0)
    shares, fit = fit_shares(likely, counts)
    chosen = list(range(len(shares)))
    while len(chosen) > 1:
        fewer = [c for i, c in enumerate(chosen) if i != int(shares.argmin())]
        if len(fewer) == 1:
            next_shares, next_fit = np.ones(1), float(counts @ np.log(likely[:, fewer[0]]))
        else:
            next_shares, next_fit = fit_shares(likely[:, fewer], counts)
        if next_fit + penalty < fit:
            break
        chosen, shares, fit = fewer, next_shares, next_fit
    order = np.argsort(-shares, kind="stable")
    return [chosen[i] for i in order], shares[order]


def identifier(langs: list[str], model: np.ndarray):
    """A column function: text -> struct(lang_pred, score, langs, shares)."""
    small = model.astype(np.float32)

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = small.astype(np.float64)
        for texts in batches:
            rows = []
            for text in texts:
                bins = trigram_bins(text) if langs else None
                if bins is None:
                    rows.append((UNDETERMINED, 0.0, [], []))
                    continue
                chosen, shares = explain(bins, table)
                rows.append((langs[chosen[0]], float(min(max(shares[0], 0.0), 1.0)),
                             [langs[c] for c in chosen], [float(s) for s in shares]))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "langs", "shares"])
    return identify


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs, shares for every row; learned outside the held-out third."""
    langs, model = train(docs.where(learnable(id_col)), text_col, lang_col)
    found = identifier(langs, model)(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), (~learnable(id_col)).alias("held_out"), found.alias("_p")) \
        .select("doc_id", "held_out", "_p.*")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    min_share: float = MIN_SHARE) -> DataFrame:
    """The rows whose language is determined with a share of at least ``min_share``, columns unchanged."""
    langs, model = train(docs.where(learnable(id_col)), text_col, lang_col)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      identifier(langs, model)(F.col(f"`{text_col}`")).alias("_p"))
    return row.where((F.col("_p.lang_pred") != UNDETERMINED) & (F.col("_p.score") >= min_share)) \
        .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


ship_by_value(__name__)
