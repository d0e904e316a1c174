"""The registered queries of this subpackage and their SQL.

Each takes (spark, folder of the tables) and applies one operator, with production
parameters, to its whole table.
"""

from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import (
    bpe, collocations, decontamination, language_net, licenses, line_dedup, ngram_join, quality_ranker, quality_rules,
    token_planes, top_k, url_filter, vector_codes,
)
from starloom.llm.shipping import ship
from starloom.operators.sizing import small
from starloom.session import staging_path

QUERIES, ORACLE = {}, {}


def query(fn):
    @wraps(fn)
    def run(spark, folder):
        ship(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_bpe_round_trip(spark, folder):
    """Ids of all documents and the text that they decode to."""
    done = bpe.encoded(table(spark, folder, "documents").select("doc_id", "text"), tokenizer(), decode=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op3_token_planes(spark, folder):
    """Ids of all documents, written as bit planes and read back."""
    path = staging_path(spark, "planes")
    token_planes.written(table(spark, folder, "documents"), path, tokenizer(), end_id=2)
    return token_planes.digests(spark, path).withColumnRenamed("key", "doc_id")


@query
def op5_license_scan(spark, folder):
    """License rules over all documents."""
    return licenses.scan(table(spark, folder, "documents")).select("doc_id", *licenses.RESULT)


# The rules of the check, and hosts that are blocked wherever no rule fits.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = tuple(f"{name}.example.{end}" for name in BLOCKED_NAMES for end in ("com", "net", "org"))


@query
def op8_url_filter(spark, folder):
    """Rules and a list of blocked hosts over the urls of all pages."""
    rules = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    listed = spark.createDataFrame([(f"{h}/", "block") for h in BLOCKED_HOSTS], "entry string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judged(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(rule, verdict) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)}),
cut AS (SELECT rule, verdict, substr(rule, 1, strpos(rule, '/') - 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath FROM rules),
keyed AS (SELECT *, row_number() OVER () AS k FROM split),
fit AS (
  SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM keyed JOIN cut ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY k),
blocked(name) AS (VALUES {", ".join(f"('{h}')" for h in BLOCKED_HOSTS)}),
listed AS (
  SELECT DISTINCT k FROM keyed JOIN blocked ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, '/'))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, fit.rule AS rule,
       CASE WHEN fit.verdict IS NOT NULL THEN fit.verdict WHEN listed.k IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM keyed LEFT JOIN fit USING (k) LEFT JOIN listed USING (k)
"""


@query
def op7_top_k(spark, folder):
    """The ten best inner products of every hundredth vector among all others."""
    vectors = top_k.finite_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return top_k.top_k(vectors, vectors.filter("id % 100 = 0"))


ORACLE["op7_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def held_out(key="doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


@query
def op1_quality_ranker(spark, folder):
    """Quality of all documents, learned from the labels that aren't held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(~held_out())
    ranker = quality_ranker.fit(documents, labels)
    return quality_ranker.scored(documents, ranker).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_language_net(spark, folder):
    """Language of all documents, learned from those that aren't held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    net = language_net.fit(documents.filter(~held_out()))
    return language_net.predicted(documents.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op10_line_dedup(spark, folder):
    """All documents without the blocks of lines that an earlier document has."""
    rows = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(rows).select("doc_id", "text", "n_lines", "n_deleted", "sources")


@query
def op6_decontamination(spark, folder):
    """The benchmark items that all documents hold, with word edits."""
    return decontamination.passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_ngram_join(spark, folder):
    """Groups of near-duplicate documents."""
    found = ngram_join.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op12_ball_codes(spark, folder):
    """Product codes of all vectors by ball k-means."""
    vectors = table(spark, folder, "embeddings")
    return vector_codes.quantised(vectors).withColumnRenamed("id", "vec_id").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts=vector_codes.PARTS, entries=vector_codes.ENTRIES, rounds=vector_codes.ROUNDS, scale=vector_codes.SCALE):
    """The same by trying all entries: one pair of steps per round."""
    steps = [f"""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding, label) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
  FROM kept, (SELECT unnest(range({parts})) AS p) q),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries})"""]
    nearest = """
near{n} AS (
  SELECT r, vec_id, label, p, x, min(struct_pack(d := d, e := e)) AS m FROM (
    SELECT r, vec_id, label, a.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts a JOIN book{n} b ON a.p = b.p) t
  GROUP BY r, vec_id, label, p, x)"""
    for n in range(rounds):
        steps.append(nearest.format(n=n))
        steps.append(f"""
means{n} AS (
  SELECT p, e, list((s - ((s % k) + k) % k) // k ORDER BY i) AS c FROM (
    SELECT p, m.e AS e, i, sum(x[i + 1])::BIGINT AS s, count(*) AS k
    FROM near{n}, (SELECT unnest(range((SELECT max(len(x)) FROM parts))) AS i) q GROUP BY ALL) t
  GROUP BY p, e),
book{n + 1} AS (SELECT b.p, b.e, coalesce(f.c, b.c) AS c FROM book{n} b LEFT JOIN means{n} f ON b.p = f.p AND b.e = f.e)""")
    steps.append(nearest.format(n=rounds))
    return "WITH " + ",".join(steps) + f""",
coded AS (
  SELECT r, vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
  FROM near{rounds} GROUP BY r, vec_id, label),
spelled AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded, spelled
"""


ORACLE["op12_ball_codes"] = _codes_sql()


@query
def op11_quality_rules(spark, folder):
    """Counts and the n-gram likelihood ratio of all documents.

    The target are the documents that are labelled good and not toxic and aren't held out.
    """
    documents = table(spark, folder, "documents").select("doc_id", "text")
    trusted = table(spark, folder, "labels").filter(~held_out() & (F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id").distinct()
    ratios = quality_rules.fit(documents, documents.join(small(trusted), "doc_id", "left_semi"))
    return quality_rules.judged(documents, ratios).select("doc_id", *quality_rules.RESULT)


@query
def op13_collocations(spark, folder):
    """The best phrases of two and three words of each language, over all documents."""
    return collocations.collocations(table(spark, folder, "documents"))


ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
ones AS (SELECT lang, w[i] AS w1, count(*) AS f FROM places GROUP BY ALL),
twos AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS a FROM places WHERE i < len(w) GROUP BY ALL HAVING a >= 10),
threes AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS a FROM places WHERE i < len(w) - 1 GROUP BY ALL HAVING a >= 10),
longer AS (
  SELECT lang, w1, w2, max(a) AS m FROM (
    SELECT lang, w1, w2, a FROM threes UNION ALL SELECT lang, w2, w3, a FROM threes) t GROUP BY ALL),
cut AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, x.f AS l1, y.f AS r1, x.f AS l2, y.f AS r2
  FROM twos t JOIN ones x ON t.lang = x.lang AND t.w1 = x.w1 JOIN ones y ON t.lang = y.lang AND t.w2 = y.w1
  LEFT JOIN longer m ON t.lang = m.lang AND t.w1 = m.w1 AND t.w2 = m.w2
  WHERE m.m IS NULL OR 100 * m.m < 50 * t.a
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, x.f, q.a, p.a, z.f
  FROM threes t JOIN ones x ON t.lang = x.lang AND t.w1 = x.w1 JOIN ones z ON t.lang = z.lang AND t.w3 = z.w1
  JOIN twos p ON t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2 JOIN twos q ON t.lang = q.lang AND t.w2 = q.w1 AND t.w3 = q.w2),
scored AS (
  SELECT *, (1000000 * a::HUGEINT * a) // (l1::HUGEINT * r1) AS s1, (1000000 * a::HUGEINT * a) // (l2::HUGEINT * r2) AS s2 FROM cut),
best AS (
  SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END AS l, CASE WHEN s2 < s1 THEN r2 ELSE r1 END AS r,
         least(s1, s2)::BIGINT AS score FROM scored),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM ranked k JOIN totals t ON k.lang = t.lang WHERE rank <= 2000
"""
