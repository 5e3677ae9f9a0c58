"""The pipeline against plain versions of its stages."""

import math
import re
from collections import Counter, defaultdict

import corpus_pipeline as P
from tokenizers import Tokenizer

from dealsieve.llm.queries import BYTE_BPE, tokenizer_file

from .helpers import awkward_rows, clashing
from .test_dedup import families, smallest
from .test_near_threshold import components_at
from .test_shards_mix import plain_count


def test_stages_in_order():
    assert [name for name, _ in P.STAGES] == ["language_mix", "content_sort", "sketch_dedup", "poisson_mix", "bpe_lexicon"]


def test_run_equals_plain_stages(spark, tmp_dir):
    rows = [r for r in awkward_rows() + families(7, 6, 60) if r[0] is not None]
    clashing(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    # 1: the labels are those of one language model each; only texts without a letter go.
    rows = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    first = P.STAGES[0][1](spark, docs, tmp_dir)
    assert first.columns == docs.columns
    shared = {r.doc_id for r in first.collect()}
    assert shared <= {r[0] for r in rows}
    rows = [r for r in rows if r[0] in shared]
    # 2: of texts equal up to white space, one row with the smallest id.
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1])].append(r)
    rows = [min(g, key=lambda r: r[0]) for g in groups.values()]
    # 3: of near copies, the smallest id.
    component = components_at(rows, *P.NEAR_COPY)
    rows = [r for r in rows if component[r[0]] == r[0]]
    # 4: Poisson counts.
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1].encode())
    weight = {s: math.sqrt(b) for s, b in size.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / b for s, b in size.items()}
    want = +Counter({r[0]: plain_count(str(r[0]), 1, rate[r[3]]) for r in rows})
    # 5: token ids.
    library = Tokenizer.from_file(tokenizer_file(BYTE_BPE))
    text = {r[0]: r[1] for r in rows}
    out = P.run(spark, tmp_dir).collect()
    assert Counter(r.doc_id for r in out) == want
    for r in out:
        assert r.decodes and r.token_ids == library.encode(text[r.doc_id], add_special_tokens=False).ids


def test_language_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = P.STAGES[0][1](spark, docs, None)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_stages_take_an_empty_table(spark):
    docs = clashing(spark, awkward_rows()).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, None).count() == 0
    assert smallest([None, 3, 2]) == 2
