"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    archives,
    clusters,
    exact_dedup,
    fingerprints,
    grading,
    infilling,
    jaccard,
    licenses,
    mixing,
    pages,
    pieces,
    private,
    topk,
)
from tallyspark.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return add


_SPACES = r"[\x20\x09-\x0D]+"
_WORD_COUNT = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"


# WARC: payloads and digests come from SQL; writing and reading the archives does not change them
@query(
    "op1_warc_packages",
    f"""WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, url, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS h FROM p),
w AS (SELECT h, max(page_id) AS newest FROM d WHERE n >= {archives.DEDUP_BYTES} GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN page_id < newest THEN newest END AS refers_to, url
FROM d LEFT JOIN w USING (h)""",
)
def op1(spark, sf):
    return archives.round_trip(read(spark, sf, "pages"))


@query(
    "op2_ngram_jaccard_join",
    rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {jaccard.K} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {jaccard.K - 2}), lambda i: array_to_string(w[i:i + {jaccard.K - 1}], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= {jaccard.PERCENT} * (nx.n + ny.n - c)),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
)
def op2(spark, sf):
    return jaccard.components(read(spark, sf, "documents"))


@query("op3_html_main_text")
def op3(spark, sf):
    return pages.main_text(read(spark, sf, "pages"))


@query("op4_private_data")
def op4(spark, sf):
    return private.find_personal_data(read(spark, sf, "documents"))


@query("op5_license_scan")
def op5(spark, sf):
    return licenses.scan(read(spark, sf, "documents"))


@query(
    "op6_source_mixing",
    f"""WITH RECURSIVE d AS (
  SELECT doc_id, source, {_WORD_COUNT} AS size,
  md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST({mixing.MAX_EPOCHS} * sum(size) AS BIGINT) AS cap,
  list_value(5, 2, 1)[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight
  FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS i FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
  sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
l AS (SELECT *, ({mixing.BUDGET} * (SELECT CAST(sum(size) AS DOUBLE) FROM d) - CAST(caps AS DOUBLE)) / CAST(free AS DOUBLE) AS level FROM c),
f AS (SELECT min_by(level, i) AS level FROM l WHERE level * weight < cap),
t AS (SELECT source, source_size, CASE WHEN f.level * weight >= cap THEN CAST(cap AS DOUBLE) ELSE f.level * weight END AS target FROM s, f),
r AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS repeats FROM t),
q AS (SELECT *, CAST(floor(target - repeats * source_size + 0.5) AS BIGINT) AS rest FROM r),
x AS (SELECT doc_id, d.source, size, source_size, target, repeats, rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY hash, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
CAST(repeats * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken, source, repeats,
CAST(greatest(0, least(size, rest - before)) AS BIGINT) AS extra FROM x""",
)
def op6(spark, sf):
    return mixing.mix(read(spark, sf, "documents"))


@query(
    "op7_exact_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
  CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""",
)
def op7(spark, sf):
    return topk.top_k(read(spark, sf, "embeddings"), F.expr("vec_id % 50 = 0"))


@query("op8_quality_grades")
def op8(spark, sf):
    docs = read(spark, sf, "documents")
    return grading.grade(docs, grading.train(docs, read(spark, sf, "labels")))


@query("op9_sentencepiece")
def op9(spark, sf):
    return pieces.token_digests(read(spark, sf, "documents"))


@query(
    "op10_exact_dedup",
    f"""WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS h FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER (PARTITION BY h, doc_id) AS copy FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND copy = 1 AS kept, h AS text_sha256 FROM g""",
)
def op10(spark, sf):
    return exact_dedup.duplicate_groups(read(spark, sf, "documents"))


_FORM = f"""CASE WHEN t = '' OR contains(t, '{infilling.PREFIX}') OR contains(t, '{infilling.SUFFIX}') OR contains(t, '{infilling.MIDDLE}')
  OR h3 % 100 >= {infilling.TRANSFORMED_PERCENT} THEN 'plain' WHEN h4 % 100 < {infilling.SPM_PERCENT} THEN 'spm' ELSE 'psm' END"""


def _group(number: int) -> str:
    return f"CAST('0x' || substr(h, {8 * number + 1}, 8) AS BIGINT) AS h{number + 1}"


@query(
    "op11_fill_in_middle",
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{infilling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {", ".join(_group(i) for i in range(4))} FROM d),
c AS (SELECT doc_id, t, n, {_FORM} AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM g),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t
  WHEN 'psm' THEN '{infilling.PREFIX}' || prefix || '{infilling.SUFFIX}' || suffix || '{infilling.MIDDLE}' || middle
  ELSE '{infilling.SUFFIX}' || suffix || '{infilling.PREFIX}' || prefix || '{infilling.MIDDLE}' || middle END) AS output_sha256,
sha256(t) AS restored_sha256 FROM p""",
)
def op11(spark, sf):
    return infilling.digests(read(spark, sf, "documents"))


@query("op12_simhash_fingerprints")
def op12(spark, sf):
    return fingerprints.report(read(spark, sf, "documents"), F.expr("doc_id % 20 = 0"))


def _lloyd() -> str:
    """The rounds written out: c<i> are the centroids, a<i> the assignment to them."""
    square = "CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"""v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {clusters.DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {clusters.DIM})""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v FROM
  (SELECT v, sha256('{clusters.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v) QUALIFY cluster < {clusters.K})""",
    ]
    for i in range(clusters.ROUNDS + 1):
        steps.append(
            f"""a{i} AS (SELECT row, vec_id, v, cluster, distance FROM (SELECT v.row, v.vec_id, v.v, c.cluster, {square} AS distance FROM v, c{i} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""
        )
        if i < clusters.ROUNDS:
            steps.append(
                f"""s{i} AS (SELECT cluster, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i})
  GROUP BY cluster, pos),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT c{i}.cluster, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (cluster))"""
            )
    last = clusters.ROUNDS
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c USING (cluster)"""


@query("op13_centroid_clusters", _lloyd())
def op13(spark, sf):
    return clusters.cluster(read(spark, sf, "embeddings"))
