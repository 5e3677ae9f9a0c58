"""The registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table
(``documents``, or what its name says) and derives the digest columns of its
contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealsieve.llm import (bpe_lexicon, burst_trie, content_sort, credential_links, curve_clusters, host_rules,
                           language_mix, license_templates, poisson_mix, sketch_dedup, slot_shards, token_files, window_dedup)
from dealsieve.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SHARDS = 8


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return wrap


@query("op1_slot_shards")
def op1_slot_shards(spark, sf_dir):
    """Shards 0 to 7 through 4,096 slots; sizes near equal.  Version 2 of the map is for nine shards."""
    out = slot_shards.shard_documents(documents(spark, sf_dir), SHARDS, rebalance_to=SHARDS + 1)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
                      "rebalanced_shard")


@query("op5_host_rules", oracle="""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, source, text,
             list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM s WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep)
        GROUP BY doc_id),
b AS (SELECT s.doc_id, source, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(l)::BIGINT AS n_lines
      FROM s LEFT JOIN cov ON s.doc_id = cov.doc_id),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
             10 * n_symbols > word_chars AS f3, 100 * n_dup_lines > 30 * n_lines AS f4 FROM b),
h AS (SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS r,
             unnest([count(*) FILTER (f1), count(*) FILTER (f2), count(*) FILTER (f3), count(*) FILTER (f4)]) AS k
      FROM f GROUP BY source),
m AS (SELECT r, avg(k / n) AS m, var_pop(k / n) AS v FROM h GROUP BY r),
p AS (SELECT r, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) ELSE 1000.0 END AS s FROM m),
e AS (SELECT source, n + s AS w, (k + m * s) / (n + s) AS rate FROM h JOIN p ON h.r = p.r),
ok AS (SELECT source, bool_and(rate - 1.645 * sqrt(rate * (1 - rate) / (w + 1)) <= 0.3) AS host_ok FROM e GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 OR f2) AS base_failed,
       (NOT (f1 OR f2) AND host_ok) AS kept
FROM f JOIN ok ON f.source IS NOT DISTINCT FROM ok.source
""")
def op5_host_rules(spark, sf_dir):
    """Base counts of every document; kept unless its own rules or its host's verdict say no."""
    return host_rules.judge_documents(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_poisson_mix", oracle="""
WITH d AS (SELECT doc_id, lang, source, n_chars, md5(coalesce(text, '')) AS text_md5,
                  octet_length(encode(coalesce(text, ''))) AS b FROM documents),
r AS (SELECT source, sqrt(sum(b)::DOUBLE) AS w, sum(b)::DOUBLE AS bytes FROM d GROUP BY source),
rate AS (SELECT source, w / (SELECT sum(w) FROM r) * (SELECT sum(bytes) FROM r) / bytes AS rate FROM r),
j AS (SELECT d.*, rate, greatest(ceil(rate / 8.0), 1)::INT AS parts
      FROM d JOIN rate ON d.source IS NOT DISTINCT FROM rate.source),
q AS (SELECT *, unnest(generate_series(1, parts)) AS part FROM j),
u AS (SELECT *, ('0x' || md5(doc_id || ':1:' || part)[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM q),
t AS (SELECT *, unnest(generate_series(0, 63)) AS k, rate / parts AS m FROM u),
c AS (SELECT doc_id, part, u, sum(exp(-m) * pow(m, k) / gamma(k + 1)) OVER
             (PARTITION BY doc_id, part ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM t),
n AS (SELECT doc_id, count(*) FILTER (cdf <= u) AS n FROM c GROUP BY doc_id),
x AS (SELECT j.*, n AS copies, unnest(generate_series(1, n)) AS copy FROM j JOIN n ON j.doc_id = n.doc_id)
SELECT doc_id, text_md5, lang, source, n_chars, copy::INT AS copy, copies::INT AS copies, rate,
       md5(doc_id || ':1:order:' || copy) AS mix_key FROM x
""")
def op7_poisson_mix(spark, sf_dir):
    """Every copy drawn at square-root smoothed source shares, globally shuffled; texts as their MD5."""
    out = poisson_mix.replicate(documents(spark, sf_dir), details=True)
    return out.withColumn("text", F.md5(F.coalesce("text", F.lit("")))).withColumnRenamed("text", "text_md5")


@query("op9_content_sort", oracle="""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
""")
def op9_content_sort(spark, sf_dir):
    """Exact copies by a content sort of the whole normalised texts."""
    return content_sort.content_groups(documents(spark, sf_dir))


@query("op6_language_mix")
def op6_language_mix(spark, sf_dir):
    """Languages by mixture inference, learned from the documents that are not held out."""
    return language_mix.identify_languages(documents(spark, sf_dir))


@query("op10_license_templates")
def op10_license_templates(spark, sf_dir):
    """Phrase places and accepted license notices of every document."""
    return license_templates.scan_licenses(documents(spark, sf_dir))


BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op4_bpe_lexicon")
def op4_bpe_lexicon(spark, sf_dir):
    """Every whole text encoded through the frequent-word automaton and decoded again."""
    return bpe_lexicon.token_digests(documents(spark, sf_dir), tokenizer_file(BYTE_BPE))


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    """Every whole text written as Re-Pair compressed token ids and read back."""
    return token_files.token_files(documents(spark, sf_dir), tokenizer_file(WORD_BPE)) \
        .select("doc_id", "start", "n_tokens", "ids_crc32", F.col("part").alias("file_part"))


@query("op8_window_dedup", oracle="""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                                      lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM w WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win)
          WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS t,
                count(*) AS n_words, count(gone.p) AS n_removed
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT w.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
""")
def op8_window_dedup(spark, sf_dir):
    """Words of every document outside the 20-word windows that also start earlier."""
    out = window_dedup.drop_windows(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_sketch_dedup", oracle="""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
""")
def op2_sketch_dedup(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return sketch_dedup.near_duplicates(documents(spark, sf_dir)) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def _cluster_sql(clusters: int, rounds: int) -> str:
    """Each round spelled out: distances to all centroids, the nearest, and the means rounded down."""
    parts = [f"""
v AS MATERIALIZED (SELECT vec_id, j, floor(256 * embedding[j + 1]::DOUBLE)::BIGINT AS x
                   FROM (SELECT vec_id, embedding, unnest(generate_series(0, 63)) AS j FROM embeddings
                         WHERE len(embedding) = 64
                           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM v)),
c0 AS MATERIALIZED (SELECT k, j, x FROM f JOIN v ON f.vec_id = v.vec_id WHERE k < {clusters})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT vec_id, min(d * 1000 + k) % 1000 AS k, min(d) AS d
     FROM (SELECT r.vec_id, c.k, sum((r.x - c.x) * (r.x - c.x))::BIGINT AS d FROM v AS r JOIN c{i} AS c ON r.j = c.j
           GROUP BY r.vec_id, c.k) GROUP BY vec_id)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (SELECT c.k, c.j, coalesce(floor(m.s / m.n)::BIGINT, c.x) AS x FROM c{i} AS c
     LEFT JOIN (SELECT a.k, r.j, sum(r.x)::DOUBLE AS s, count(*) AS n FROM a{i} AS a JOIN v AS r ON a.vec_id = r.vec_id
                GROUP BY a.k, r.j) AS m ON m.k = c.k AND m.j = c.j)""")
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, a.k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} AS a JOIN (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256
                          FROM c{rounds} GROUP BY k) AS h ON a.k = h.k"""


@query("op11_curve_clusters", oracle=_cluster_sql(40, 5))
def op11_curve_clusters(spark, sf_dir):
    """Five rounds from 40 centroids over the whole ``embeddings`` table, in blocks along a Hilbert curve."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return curve_clusters.cluster_vectors(table).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op12_credential_links")
def op12_credential_links(spark, sf_dir):
    """Secrets of every whole text, and the weak parts that stand beside their complement."""
    out = credential_links.scan_credentials(documents(spark, sf_dir))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.past)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x.kind.isin(credential_links.BASE))
    return out.select("doc_id", *[count(kind) for kind in credential_links.BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"), F.size("links").cast("long").alias("n_links"))


FIRST_TURNS = 6      # a rebuilt conversation begins with fewer turns of its base than this


def rebuilt_conversations(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Placed turns and ids of the rebuilt conversations: the first h turns of conversation c - c % 100, then c's
    own turns after its first h, h being the checksum of c's digits modulo 6."""
    conv = F.col("conv_id")
    based = placed.withColumn("base", conv - conv % 100) \
        .withColumn("h", F.crc32(conv.cast("string").cast("binary")) % FIRST_TURNS)
    lead = placed.where((conv % 100 == 0) & (F.col("place") < FIRST_TURNS)).withColumnRenamed("conv_id", "base")
    first = based.select("conv_id", "base", "h").distinct().join(lead, "base").where("place <= h") \
        .select("conv_id", "place", "turn_id", "size")
    led = F.least("h", F.coalesce("n", F.lit(0)))
    own = based.where("place > h").join(lead.groupBy("base").agg(F.count(F.lit(1)).alias("n")), "base", "left") \
        .select("conv_id", (F.col("place") - F.col("h") + led).alias("place"), "turn_id", "size")
    return first.unionByName(own), placed.select("conv_id")


@query("op13_burst_trie", oracle="""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda a, b: list_reduce(generate_series(1, 8)::BIGINT[], lambda y, k:
            CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(a, b)), 4294967295)) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM o)),
n AS (SELECT c.*, least(h, (SELECT count(*) FROM o WHERE o.conv_id = c.base)) AS led FROM c),
t AS (SELECT n.conv_id, o.p, role, text FROM n JOIN o ON o.conv_id = n.base WHERE o.p <= h
      UNION ALL SELECT n.conv_id, o.p - h + led, role, text FROM n JOIN o ON o.conv_id = n.conv_id WHERE o.p > h),
x AS (SELECT n.conv_id, 0 AS depth, '' AS path, 0 AS size FROM n UNION ALL
      SELECT conv_id, p, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY p), length(text)
      FROM t),
m AS (SELECT conv_id, max(depth) AS d FROM x GROUP BY conv_id),
y AS MATERIALIZED (SELECT x.path, min(x.conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(size) AS size,
             string_agg(x.conv_id::VARCHAR, ',' ORDER BY x.conv_id) FILTER (depth = d) AS ends
      FROM x JOIN m ON x.conv_id = m.conv_id GROUP BY x.path),
k AS MATERIALIZED (SELECT y.*, (SELECT count(*) FROM y AS z WHERE z.depth = y.depth + 1 AND starts_with(z.path, y.path)) AS n_children
                   FROM y)
SELECT k.conv_id, k.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children,
       (SELECT count(*) FROM k AS z WHERE starts_with(z.path, k.path) AND z.n_children = 0) AS n_leaves,
       (SELECT sum((z.n_convs - 1) * z.size) FROM k AS z WHERE starts_with(z.path, k.path))::BIGINT AS saved_tokens,
       sha256(coalesce(k.ends, '')) AS ends_sha256
FROM k LEFT JOIN y AS u ON k.depth > 0 AND u.path = left(k.path, -32)
""")
def op13_burst_trie(spark, sf_dir):
    """The prefix trie of all rebuilt conversations."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    placed = burst_trie.number_turns(burst_trie.turn_rows(table))
    return burst_trie.build_trie(*rebuilt_conversations(placed))
