"""One query for each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import audit, bpe, centroids, fingerprints, html_text, language, lines, mixing, neardup, quality, token_counts, urls, warc
from tidemark.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

WORD_SQL = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet").select(*columns)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query("op1_bpe_codec")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """SQL can't express it; tests compare ids and decoded texts with the tokenizers library."""
    docs = read(spark, sf, "documents", "doc_id", "text")
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=made).select("doc_id", *made)


_REPEATS = """
, hits_{k} AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM (
    SELECT doc_id, i, list_slice(w, i, i + {k} - 1) AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM split_words))) WHERE c > 1),
cover_{k} AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS chars FROM (
    SELECT DISTINCT h.doc_id, h.i + d.d AS at, s.w[h.i + d.d] AS word
    FROM hits_{k} h CROSS JOIN range(0, {k}) d(d) JOIN split_words s USING (doc_id)) GROUP BY doc_id)
"""

OP2_SQL = (
    rf"""
WITH split_words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w FROM documents),
worded_lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS nth
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split_words)
  WHERE regexp_matches(line, '{WORD_SQL}')),
again AS (
  SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars
  FROM worded_lines WHERE nth > 1 GROUP BY doc_id)
"""
    + "".join(_REPEATS.format(k=k) for k in sorted(quality.COVERAGE))
    + rf"""
, counted AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(a.n, 0)::BIGINT AS n_dup_lines, coalesce(c5.n_words, 0)::BIGINT AS n_repeat_words,
    coalesce(a.chars, 0)::BIGINT AS dup_line_chars,
    {", ".join(f"coalesce(c{k}.chars, 0)::BIGINT AS repeat_chars_{k}" for k in sorted(quality.COVERAGE))}
  FROM split_words s LEFT JOIN again a USING (doc_id)
  {" ".join(f"LEFT JOIN cover_{k} c{k} USING (doc_id)" for k in sorted(quality.COVERAGE))})
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND dup_line_chars <= {quality.LINES} * word_chars
  AND {" AND ".join(f"repeat_chars_{k} <= {s} * word_chars" for k, s in quality.COVERAGE.items())} AS kept
FROM counted
"""
)


@query("op2_quality_rules", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(read(spark, sf, "documents", "doc_id", "text")).drop("text")


def _apportion_sql(name: str, claims: str, by: str, seats: str, weight: str, tie: str) -> str:
    """SQL of highest quotients by ranking all of them: ``seats`` quotients of every claim."""
    return f"""
{name} AS (
  SELECT c.*, CASE WHEN {weight} > 0 THEN coalesce(won, 0) ELSE 0 END AS quota FROM {claims} c LEFT JOIN (
    SELECT {by}, {tie}, count(*) AS won FROM (
      SELECT {by}, {tie}, {seats} AS seats, row_number() OVER (PARTITION BY {by} ORDER BY {weight} / (2 * k + 1) DESC, {tie}, k) AS r
      FROM (SELECT *, unnest(range(0, {seats} + 1)) AS k FROM {claims} WHERE {weight} > 0))
    WHERE r <= seats GROUP BY ALL) w USING ({by}, {tie}))"""


def _draw_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


OP3_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD_SQL}')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT *, sum(source_size) OVER () AS total, count(*) OVER () AS n, [1.0, 2.0, 3.0][(place - 1) % 3 + 1]::DOUBLE AS weight,
    3.0::DOUBLE * source_size AS most FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
    FROM sized GROUP BY source)),
filling AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sources),
level AS (
  SELECT arg_min(level, place) AS level FROM filling WHERE most / weight =
    (SELECT min(most / weight) FROM filling WHERE level <= most / weight) AND level <= most / weight),
targeted AS (
  SELECT source, place, source_size, 1 AS everything, least(most, coalesce((SELECT level FROM level) * weight, most)) AS target,
    total FROM sources),
blocked AS (
  SELECT *, floor(total / per_block)::BIGINT AS blocks FROM (
    SELECT *, greatest(1, least({mixing.BLOCK}, floor(coalesce(min(target) FILTER (target > 0) OVER (), 0) / {mixing.FINE})))::BIGINT AS per_block FROM targeted)),
{_apportion_sql("granted", "blocked", "everything", "blocks", "target", "place")},
sharded AS (
  SELECT *, least({mixing.SHARDS}, greatest(1, floor(source_size / {mixing.LONG * mixing.BLOCK})))::BIGINT AS shards FROM granted),
placed AS (
  SELECT d.*, place, source_size, target, quota, per_block,
    {_draw_sql("'7:' || doc_id")} % shards AS shard, md5('7+:' || doc_id) AS draw
  FROM sized d JOIN sharded s ON d.source IS NOT DISTINCT FROM s.source),
parts AS (SELECT place, shard, sum(size)::BIGINT AS words, max(quota)::BIGINT AS seats, max(per_block) AS per_block FROM placed GROUP BY ALL),
{_apportion_sql("dealt", "parts", "place", "seats", "words", "shard")},
cut AS (SELECT * EXCLUDE (quota), least(quota, 3 * n) AS quota FROM (SELECT *, greatest(1, round(words / per_block))::BIGINT AS n FROM dealt)),
runs AS (
  SELECT place, shard, words, n, quota // n AS rounds, quota % n AS rest,
    {_draw_sql("'7:' || place || ':' || shard || ':start'")} % n AS start FROM cut),
edges AS (
  SELECT place, shard, rounds, floor(start * (words / n))::BIGINT AS from_1, floor(least(start + rest, n) * (words / n))::BIGINT AS to_1,
    floor(greatest(0, start + rest - n) * (words / n))::BIGINT AS to_2 FROM runs),
laid AS (
  SELECT *, sum(size) OVER (PARTITION BY place, shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM placed)
SELECT doc_id, source, size, source_size, target, (rounds * size + greatest(0, least(stop, to_1) - greatest(stop - size, from_1))
  + greatest(0, least(stop, to_2) - greatest(stop - size, 0)))::BIGINT AS taken
FROM laid JOIN edges USING (place, shard)
"""


@query("op3_mix_sources", OP3_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(read(spark, sf, "documents", "doc_id", "source", "text"))


OP4_SQL = rf"""
WITH RECURSIVE split_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_SQL}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS cls FROM shingles GROUP BY doc_id),
firsts AS (SELECT cls, min(doc_id) AS doc_id, max(n) AS n FROM sizes GROUP BY cls),
near AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id AND a.doc_id IN (SELECT doc_id FROM firsts) AND b.doc_id IN (SELECT doc_id FROM firsts) GROUP BY ALL),
links AS (
  SELECT a, b FROM near JOIN firsts x ON x.doc_id = a JOIN firsts y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM firsts UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(r.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN firsts f USING (cls) LEFT JOIN roots r ON r.doc_id = f.doc_id
"""


@query("op4_near_dedup", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.components_of(read(spark, sf, "documents", "doc_id", "text"), percent=85)


RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _term_sql(terms: tuple[str, ...]) -> str:
    edge = r"[^\p{L}\p{N}]"
    return " + ".join(f"regexp_matches(known, '(^|{edge}){t}({edge}|$)')::INT" for t in terms)


def _rules_sql(pick: Callable[[tuple[str, str, str]], str]) -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    cases = (f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick((v, h, p))}'" for v, h, p in ordered)
    return "CASE " + " ".join(cases) + " END"


OP5_SQL = rf"""
WITH cut AS (
  SELECT page_id, lower(coalesce(url, '')) AS known, coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM pages),
judged AS (
  SELECT page_id, host, path, {_rules_sql(lambda r: r[1] + r[2])} AS rule, {_rules_sql(lambda r: r[0])} AS by_rule,
    ({urls.SOFT_LIMIT} * ({_term_sql(urls.STRICT)}) + {_term_sql(urls.SOFT)})::INT AS weight FROM cut)
SELECT page_id, host, path, rule, weight, coalesce(by_rule, CASE WHEN weight >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    judged = urls.judge(read(spark, sf, "pages", "page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "weight", "verdict")


@query("op6_main_text")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """SQL can't express it; tests compare with the text of the articles, and on held-out layouts."""
    found = html_text.extract(read(spark, sf, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


_BASE32 = " || ".join(
    f"substr('{warc.ALPHABET}', ((('0x' || substr(digest, {5 * k + 1}, 5))::INT >> {shift}) & 31) + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0)
)
OP7_SQL = f"""
WITH paid AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM paid)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts
"""


@query("op7_warc_archives", OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, f"warc-{uuid.uuid4().hex}")
    warc.write(read(spark, sf, "pages", "page_id", "url", "html"), path)
    found = warc.records(warc.read(spark, path))
    page = F.expr("try_cast(record_id AS bigint)").alias("page_id")
    refers = F.col("refers_to").cast("bigint").alias("refers_to")
    return found.select(page, "payload_bytes", "payload_digest", "record_type", refers)


@query("op8_token_counts")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """SQL can't express it; tests compare the counts with the tokenizers library."""
    docs = read(spark, sf, "documents", "doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line, len(parts) AS n_lines,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
often AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (o.key IS NOT NULL)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN often o USING (key) GROUP BY doc_id
"""


@query("op9_drop_lines", OP9_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    out = lines.drop_lines(read(spark, sf, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256"))


@query("op10_fingerprints")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """SQL has no such hash; tests recompute the sketches and check the estimates against whole sets."""
    docs = read(spark, sf, "documents", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    beside = fingerprints.with_next(docs, "doc_id", ["text"])
    n = F.char_length("text").cast("bigint")
    cut = F.floor(n / 4)
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    made = beside.select(
        "doc_id",
        n.alias("n_chars"),
        edited.alias("edited"),
        fingerprints.sketch(F.col("text")).alias("sketch"),
        fingerprints.sketch(F.col("next_text")).alias("next_sketch"),
    )
    made = made.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    return made.select(
        "doc_id",
        "n_chars",
        sha256(F.col("edited")).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("sketch")).alias("est_shingles"),
    )


_A = r"'[^\x20\x09-\x0D]+'"
OP11_SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, {_A}) AS w FROM texts),
said AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, [(len(w) < 50)::INT, (100 * len(list_distinct(w)) < 65 * len(w))::INT,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT, regexp_matches(text, '[#$%&*|]')::INT,
    coalesce(min(worded.doc_id) OVER (PARTITION BY text) < worded.doc_id, false)::INT] AS bits,
    coalesce(good, 0) AS good, coalesce(said.toxic, 0) AS toxic FROM worded LEFT JOIN said USING (doc_id)),
cells AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
orders AS (
  SELECT [a, b, c, d, e] AS axes, chr((65 + a)::INT) || chr((65 + b)::INT) || chr((65 + c)::INT) || chr((65 + d)::INT) || chr((65 + e)::INT) AS filter_order
  FROM range(5) x(a), range(5) y(b), range(5) z(c), range(5) u(d), range(5) v(e) WHERE len(list_distinct([a, b, c, d, e])) = 5),
walked AS (
  SELECT part, filter_order, step::INT AS step, axes[step] AS f, n, good, toxic, bits[axes[step] + 1] AS fails, list_sum(bits) AS all_fails,
    coalesce(list_sum([bits[x + 1] FOR x IN axes[1:step - 1]]), 0) AS before
  FROM cells, orders, range(1, 6) s(step)),
steps AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (before + fails = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (before = 0 AND fails = 1), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (before > 0 AND fails = 1), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (all_fails = 1 AND fails = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (before = 0 AND fails = 1), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (before = 0 AND fails = 1), 0)::BIGINT AS toxic_lost
  FROM walked GROUP BY ALL)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM steps
"""


@query("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents", "doc_id", "source", "text")
    return audit.audit(docs, read(spark, sf, "labels", "doc_id", "quality", "toxic"))


def _rounds_sql() -> str:
    near = """
  SELECT vec_id, v, arg_min(num, d * 64 + num) AS num, min(d) AS d FROM (
    SELECT vec_id, v, num, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept, centroids_{r}) GROUP BY vec_id, v"""
    out = ""
    for r in range(centroids.ROUNDS):
        out += f""",
near_{r} AS MATERIALIZED ({near.format(r=r)}),
centroids_{r + 1} AS MATERIALIZED (
  SELECT c.num, coalesce(m.c, c.c) AS c FROM centroids_{r} c LEFT JOIN (
    SELECT num, list(x ORDER BY i) AS c FROM (
      SELECT num, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
      FROM (SELECT num, unnest(v) AS x, unnest(range({centroids.SIZE})) AS i FROM near_{r}) GROUP BY num, i) GROUP BY num) m USING (num))"""
    return out + f",\nfound AS MATERIALIZED ({near.format(r=centroids.ROUNDS)})"


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {centroids.SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.SIZE}),
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY draw) - 1 AS num, v AS c FROM (
    SELECT v, sha256('{centroids.SEED}:' || vec_id) AS draw FROM kept ORDER BY draw LIMIT {centroids.CLUSTERS})){_rounds_sql()}
SELECT vec_id, num::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY num)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN centroids_{centroids.ROUNDS} USING (num)
"""


@query("op12_centroid_clusters", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(read(spark, sf, "embeddings", "vec_id", "embedding"))


@query("op13_language_id")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """SQL can't express it; tests measure the accuracy on the rows that are held out."""
    docs = read(spark, sf, "documents", "doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")
