"""The operators as queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstrata.llm import (
    centroids,
    decontamination,
    fill_in_middle,
    jaccard,
    language_id,
    line_dedup,
    packing,
    quality,
    sharding,
    simhash,
    token_files,
    vector_search,
    warc,
)
from matchstrata.llm.common import scan
from matchstrata.session import scratch_path


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(scan(spark, sf_dir, "documents"), path)
    return token_files.with_crc(token_files.read_tokens(spark, path))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(scan(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.minimax_shards(scan(spark, sf_dir, "documents"), shards=8)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(scan(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_equal", "n_near", "text")


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.quantized(scan(spark, sf_dir, "embeddings"))
    found = vector_search.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(scan(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(scan(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(scan(spark, sf_dir, "documents"), keep_ids=False)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(scan(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(scan(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(scan(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality,
            op2_token_files,
            op3_language_id,
            op4_sharding,
            op5_line_dedup,
            op6_vector_search,
            op7_decontamination,
            op8_warc,
            op9_jaccard,
            op10_packing,
            op11_simhash,
            op12_fill_in_middle,
            op13_centroids,
        )
    }


_OP6 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL
), classes AS (
  SELECT line, length(line) AS n, min((doc_id, line_no)) AS first FROM lines
  WHERE ltrim(line, chr(32) || chr(9) || chr(13) || chr(12) || chr(11)) <> '' GROUP BY line
), long AS (
  SELECT * FROM classes WHERE n >= 50
), near AS (
  SELECT DISTINCT a.line FROM long a
  JOIN (SELECT *, unnest(range(n - 2, n + 3)) AS m FROM long) b ON a.n = b.m AND b.first < a.first
  WHERE levenshtein(a.line, b.line) <= 2
), judged AS (
  SELECT l.doc_id, l.line_no, l.line,
         coalesce(c.line IS NOT NULL AND x.line IS NOT NULL, false) AS near,
         coalesce(c.first <> (l.doc_id, l.line_no), false) AS again
  FROM lines l LEFT JOIN classes c ON c.line = l.line LEFT JOIN near x ON x.line = l.line
)
SELECT doc_id, count(*)::INTEGER AS n_lines,
       count(*) FILTER (WHERE again AND NOT near)::INTEGER AS n_equal,
       count(*) FILTER (WHERE near)::INTEGER AS n_near,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT again AND NOT near), '') AS text
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, 0, text FROM documents WHERE text IS NULL
"""

_OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s, w
  FROM i WHERE len(w) > 0
), ig AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM iw
), dw AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM ig) WHERE len(w) >= n
), occ AS (
  SELECT DISTINCT x.r, x.s, x.n, ig.item_id
  FROM (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM dw) x JOIN ig ON ig.n = x.n AND ig.g = x.g
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM occ) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT r, item_id FROM occ WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

_OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(w[k:k + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), n AS (SELECT r, count(*) AS n FROM s GROUP BY r
), links AS (
  SELECT x.a, x.b FROM (
    SELECT p.r AS a, q.r AS b, count(*) AS i FROM s p JOIN s q ON p.g = q.g AND p.r <> q.r GROUP BY ALL
  ) x JOIN n na ON na.r = x.a JOIN n nb ON nb.r = x.b
  WHERE 100 * x.i >= 90 * (na.n + nb.n - x.i)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, min(o.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN reach ON reach.a = d.r LEFT JOIN d o ON o.r = reach.b
GROUP BY d.r, d.doc_id
"""


_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle,
         array_to_string(l[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                        ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def _op13(k: int, rounds: int) -> str:
    """Each round as two steps: who wins each vector, and where the centroids go."""
    steps = [
        """v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS cluster, q AS c
  FROM (SELECT q, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v)
  QUALIFY row_number() OVER (ORDER BY h, q) <= """
        + f"{k}\n)"
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q,
         arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (SELECT r, vec_id, q, cluster,
               list_dot_product(q, q) - 2 * list_dot_product(q, c) + list_dot_product(c, c) AS d FROM v, c{n})
  GROUP BY r
)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT cluster, list(m ORDER BY i) AS c FROM (
    SELECT cluster, i, floor(sum(x::HUGEINT) / count(*)) AS m FROM (
      SELECT cluster, unnest(q) AS x, unnest(range(64)) AS i FROM a{n}
    ) GROUP BY cluster, i
  ) GROUP BY cluster
), c{n + 1} AS (
  SELECT cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster)
)""")
    return (
        "WITH " + ", ".join(steps) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""
    )


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": _OP5,
        "op6_vector_search": _OP6,
        "op7_decontamination": _OP7,
        "op8_warc": _OP8,
        "op9_jaccard": _OP9,
        "op12_fill_in_middle": _OP12,
        "op13_centroids": _op13(centroids.CENTROIDS, centroids.ROUNDS),
    }
