"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and reread as the next stage's docs.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from dealsieve.llm import bpe_lexicon, content_sort, language_mix, poisson_mix, sketch_dedup
from dealsieve.llm.common import documents, materialise
from dealsieve.llm.queries import BYTE_BPE, tokenizer_file


NEAR_COPY = (80, 100)      # near copies share four fifths of their 5-word shingles; op2's 85/100 binds that query only


def identify_language(spark, docs, sf_dir):
    """Drops documents without a letter, or whose text is no language's by at least half."""
    return language_mix.keep_identified(docs)


def drop_exact_copies(spark, docs, sf_dir):
    """Of texts equal up to white space, the smallest id stays."""
    return content_sort.exact_dedup(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of near-duplicates, the smallest id stays."""
    return sketch_dedup.near_dedup(docs, threshold=NEAR_COPY)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as its Poisson count at square-root smoothed source shares, globally shuffled."""
    return poisson_mix.replicate(docs)


def encode_texts(spark, docs, sf_dir):
    """Token ids of every row's whole text, decoded once to check them."""
    return bpe_lexicon.with_tokens(docs, tokenizer_file(BYTE_BPE))


STAGES = [
    ("language_mix", identify_language),
    ("content_sort", drop_exact_copies),
    ("sketch_dedup", drop_near_copies),
    ("poisson_mix", mix_sources),
    ("bpe_lexicon", encode_texts),
]

# Language mixtures and BPE merges cannot be written as SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows after all stages."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
