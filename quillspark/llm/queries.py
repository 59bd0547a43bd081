"""The package's queries by name, and SQL for those that SQL can express (not:
fitted models, tokenizers, keyed permutations, classes of a similarity join)."""

from __future__ import annotations

from itertools import permutations

from . import common as C
from . import (centroids, chosen_path, decontam, filter_audit, gam_quality, jaccard_join, packing, pii, quality_rules, substring_dedup, suffix_dedup,
               token_counts, token_store)


def _vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark, sf_dir):
    return C.plain(C.read(spark, sf_dir, "documents"), "doc_id", "text")


def op1_gam_quality(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return gam_quality.score(docs, gam_quality.train(docs, C.read(spark, sf_dir, "labels")))


def op2_decontamination(spark, sf_dir):
    return decontam.report(_docs(spark, sf_dir), C.read(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(_docs(spark, sf_dir))


def op4_packing(spark, sf_dir, tokenizer=None):
    return packing.pack(_docs(spark, sf_dir), tokenizer or _vocabulary("byte_bpe_50k.json"), literal=False)


def op5_token_counts(spark, sf_dir, vocabulary=None):
    return token_counts.count_tokens(_docs(spark, sf_dir), vocabulary or _vocabulary("byte_bpe_50k.tiktoken"))


def op6_token_store(spark, sf_dir, tokenizer=None):
    return token_store.round_trip(_docs(spark, sf_dir), tokenizer or _vocabulary("word_bpe_49k.json"), literal=False)


def op7_pii(spark, sf_dir):
    return pii.report(_docs(spark, sf_dir))


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.report(_docs(spark, sf_dir))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.report(_docs(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    weights, toxicity = quality_rules.learn(docs, docs, C.read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, weights, toxicity=toxicity)


def op11_centroids(spark, sf_dir):
    return centroids.cluster(C.read(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text",
                                                         "cast(source as string) as part")
    return filter_audit.audit(docs, C.read(spark, sf_dir, "labels"))


def op13_chosen_path(spark, sf_dir):
    return chosen_path.report(_docs(spark, sf_dir))


# DuckDB SQL of the queries that SQL can express; it shares nothing with the code.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bench_words(text):
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_bench_words('text')} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, w, least(10, len(w)) AS k
      FROM (SELECT item_id, {_bench_words('text')} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
          FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
wins AS (SELECT r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hit AS (SELECT r, wins.k, i, item FROM wins JOIN grams USING (k, g)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
wins AS (SELECT r, doc_id, p, substr(h, 2 * p - 1, 2) AS c, CASE WHEN 2 * p + 98 <= length(h) THEN substr(h, 2 * p - 1, 100) END AS s
       FROM (SELECT *, unnest(range(1, length(h) // 2 + 1)) AS p FROM d)),
old AS (SELECT r, p, c, coalesce(s IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY s), false) AS old FROM wins),
gone AS (SELECT r, p, c, bool_or(old) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM old),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY r ORDER BY p) AS starts FROM gone),
k AS (SELECT r, count_if(gone) AS n, count_if(starts) AS spans, string_agg(c, '' ORDER BY p) FILTER (NOT gone) AS kept FROM runs GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM again),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
         FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""



def _op11_sql(rounds=centroids.ROUNDS):
    """Rounds of assignment and floor means, spelled out."""
    def assigned(r):
        return f"""d{r} AS MATERIALIZED (SELECT r, c, sum((x - y) * (x - y)) AS d FROM e JOIN c{r} USING (i) GROUP BY r, c),
a{r} AS MATERIALIZED (SELECT r, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""

    steps = []
    for r in range(rounds):
        steps.append(f"""{assigned(r)},
c{r + 1} AS MATERIALIZED (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{r} LEFT JOIN
  (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN e USING (r) GROUP BY c, i) USING (c, i)),""")
    body = "\n".join(steps)
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
e AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range(64)) AS i FROM k),
s AS (SELECT r, row_number() OVER (ORDER BY h, v) - 1 AS c
      FROM (SELECT r, v, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM k) QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, i, x AS y FROM s JOIN e USING (r)),
{body}
{assigned(rounds)},
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN k USING (r) JOIN h USING (c)
"""


_ORDERS = ", ".join("('" + "".join(p) + "')" for p in permutations("ABCDE"))

OP12_SQL = rf"""
WITH lab AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, t, regexp_extract_all(t, '[^ 	-
]+') AS w,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM (SELECT *, coalesce(text, '') AS t FROM documents) LEFT JOIN lab USING (doc_id)),
f AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x
        WHEN 'A' THEN len(w) < 200 WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
        WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) WHEN 'D' THEN regexp_matches(t, '[#$%&*|]') ELSE copy END) AS bad
      FROM (SELECT *, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy FROM d)),
g AS (SELECT part, bad, count(*) AS n, count_if(good) AS n_good, count_if(toxic) AS n_toxic FROM f GROUP BY part, bad),
o AS (SELECT o, s, o[s] AS x, o[:s - 1] AS before FROM (VALUES {_ORDERS}) AS v(o), range(1, 6) AS r(s)),
m AS (SELECT *, list_contains(bad, x) AS fails, len(list_filter(bad, lambda b: contains(before, b))) > 0 AS earlier FROM g, o),
r AS (SELECT part, o, s, x, sum(CASE WHEN earlier OR fails THEN 0 ELSE n END) AS kept, sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS redundant, sum(CASE WHEN bad = [x] THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT earlier THEN n_good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT earlier THEN n_toxic ELSE 0 END) AS toxic_lost
      FROM m GROUP BY part, o, s, x)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, x AS "filter", CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

QUERIES = {
    "op1_gam_quality": op1_gam_quality,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_token_store": op6_token_store,
    "op7_pii": op7_pii,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_centroids": op11_centroids,
    "op12_filter_audit": op12_filter_audit,
    "op13_chosen_path": op13_chosen_path,
}
SQL: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op11_centroids": _op11_sql(),
    "op12_filter_audit": OP12_SQL,
}
