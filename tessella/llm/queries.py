"""One query per operator over its whole table, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessella.llm import (fertility, langid, lexical, negatives, ngramjoin, packing, pieces, quality, repeats,
                          tokencounts, topk, urlfilter, warc)
from tessella.llm.common import forget, materialize, remainder, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_SPECIAL = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_top_k", """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", 256.0)
    return topk.top_k(vectors, F.col("id") % 50 == 0, 5).withColumnRenamed("id", "vec_id")


@query("op2_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rest = remainder(F.col("doc_id"), 5)
    model = langid.fit_language_model(docs.where(rest > 0), F.col("text"), F.col("lang"), F.col("doc_id"))
    found = langid.predict_language(F.col("text"), model, spark)
    return (docs.select("doc_id", (rest == 0).alias("held_out"), found.alias("_l"))
            .select("doc_id", "held_out", "_l.lang_pred", "_l.score"))


@query("op3_token_counts")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf, "documents"), BYTE_RANKS)


def _drawn(of: Column, salt: str, below: int) -> Column:
    """A number drawn from a text: the same in SQL."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(salt), of)), 1, 8), 16, 10).cast("long"), F.lit(below))


#: salt of the draw of domains of three, two and one labels, and of how many one is listed
_DOMAIN_DRAWS = (("domain", 5), ("pair", 7), ("top", 2))


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the fetch time within 2024 is drawn from the URL."""
    return pages.select("page_id", "url", (F.lit(1704067200) + _drawn(F.col("url"), "fetch", 31536000)).alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries on the hosts of the pages and on domains of one to three labels, a share of each drawn:
    added once, removed later and added again, at times drawn from the name."""
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    domains = [F.regexp_extract("host", r"[^.]+" + r"\.[^.]+" * (n - 1) + "$", 0) for n in (3, 2, 1)]
    names = (hosts.select(F.lit("hosts").alias("list"), F.lit("host").alias("kind"), F.col("host").alias("pattern"))
             .where(_drawn(F.col("pattern"), "host", 3) == 0))
    for domain, (salt, below) in zip(domains, _DOMAIN_DRAWS):
        names = names.union(hosts.select(F.lit("domains"), F.lit("domain"), domain.alias("pattern")).distinct()
                            .where("pattern <> ''").where(_drawn(F.col("pattern"), salt, below) == 0))
    start = F.lit(1704067200) + _drawn(F.col("pattern"), "start", 15768000)
    stop = start + 86400 + _drawn(F.col("pattern"), "stop", 7884000)
    again = stop + 86400 + _drawn(F.col("pattern"), "again", 7884000)
    return names.select("list", "kind", "pattern", F.explode(F.array(
        F.struct(F.lit("add").alias("action"), start.alias("at")), F.struct(F.lit("remove").alias("action"), stop.alias("at")),
        F.struct(F.lit("add").alias("action"), again.alias("at")))).alias("e")).select("list", "kind", "pattern", "e.*")


_DRAWN = "(CAST('0x' || substr(md5('{}' || {}), 1, 8) AS BIGINT) % {})"
_HOST = r"rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.')"


@query("op4_url_filters", rf"""WITH c AS (SELECT page_id, nullif({_HOST}, '') AS host,
    1704067200 + {_DRAWN.format('fetch', 'url', 31536000)} AS fetched_at FROM pages),
h AS (SELECT DISTINCT host FROM c WHERE host IS NOT NULL),
n AS (SELECT 'hosts' AS list, 'host' AS kind, host AS pattern FROM h WHERE {_DRAWN.format('host', 'host', 3)} = 0
  UNION ALL SELECT 'domains', 'domain', d FROM (SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$', 0) AS d FROM h)
  WHERE d <> '' AND {_DRAWN.format('domain', 'd', 5)} = 0
  UNION ALL SELECT 'domains', 'domain', d FROM (SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+$', 0) AS d FROM h)
  WHERE d <> '' AND {_DRAWN.format('pair', 'd', 7)} = 0
  UNION ALL SELECT 'domains', 'domain', d FROM (SELECT DISTINCT regexp_extract(host, '[^.]+$', 0) AS d FROM h)
  WHERE d <> '' AND {_DRAWN.format('top', 'd', 2)} = 0),
s AS (SELECT *, 1704067200 + {_DRAWN.format('start', 'pattern', 15768000)} AS a FROM n),
t AS (SELECT *, a + 86400 + {_DRAWN.format('stop', 'pattern', 7884000)} AS b FROM s),
i AS (SELECT list, kind, pattern, a AS f, b AS u FROM t
  UNION ALL SELECT list, kind, pattern, b + 86400 + {_DRAWN.format('again', 'pattern', 7884000)}, 4611686018427387903 FROM t),
m AS (SELECT page_id, count(*) AS n_active, min(i.list || ' ' || i.pattern) AS first_match FROM c JOIN i
  ON (i.pattern = c.host OR (i.kind = 'domain' AND ends_with(c.host, '.' || i.pattern)))
  AND i.f <= c.fetched_at AND c.fetched_at < i.u GROUP BY page_id)
SELECT c.page_id, c.host, c.fetched_at, coalesce(m.n_active, 0) > 0 AS blocked, coalesce(m.n_active, 0) AS n_active,
  m.first_match FROM c LEFT JOIN m USING (page_id)""")
def url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    found = urlfilter.filter_urls(dated_captures(pages), dated_entries(pages))
    names = F.transform("matches", lambda m: F.concat_ws(" ", m["list"], m["pattern"]))
    return found.select("page_id", urlfilter.host_of(F.col("url")).alias("host"), "fetched_at",
                        (F.size("matches") > 0).alias("blocked"), F.size("matches").cast("long").alias("n_active"),
                        F.array_min(names).alias("first_match"))


@query("op5_sentencepiece")
def sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.round_trip_digests(table(spark, sf, "documents"), PIECES)


@query("op6_ngram_join")
def ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return (ngramjoin.jaccard_components(table(spark, sf, "documents"), words=3, percent=90)
            .select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")))


def trained_quality(docs: DataFrame, labels: DataFrame) -> tuple[quality.QualityModel, DataFrame]:
    """The model and ``doc_id, x``: statistics of all documents, written once.

    Remainder 2 of the id's crc32 modulo 4 is held out, 3 calibrates, 0 and 1 fit the ridge.
    """
    stats = materialize(docs.select("doc_id", quality.statistics_of(F.col("text")).alias("x")), "statistics")
    rest = remainder(F.col("doc_id"), 4)
    # few rows, read several times: to count, for moments, sums and bins
    learned = materialize(
        stats.where(~rest.isin(2, -1))
        .join(labels.where("quality is not null").select("doc_id", F.col("quality").alias("y")), "doc_id")
        .select(F.col("doc_id").alias("key"), "x", "y", (rest == 3).alias("calibrate")), "learned")
    return quality.fit_quality_model(learned), stats


@query("op7_quality")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    model, stats = trained_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return (stats.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                         quality.quality_score(F.col("x"), model, spark).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


@query("op8_packing")
def packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), BYTE_RANKS, special=BYTE_SPECIAL).withColumnRenamed("id", "doc_id")


@query("op9_fertility_rules")
def fertility_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = fertility.judge(table(spark, sf, "documents"), PIECES, carry=["doc_id"])
    return judged.select("doc_id", *[f"_verdict.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", *fertility.MEASURES)])


RECORDS_PER_ARCHIVE = 1000


def archived(pages: DataFrame) -> DataFrame:
    """Pages as WARC records: a thousand to an archive, in the order of their file."""
    place = F.col("_metadata.row_index")
    return pages.select(
        F.concat_ws("-", F.regexp_extract("_metadata.file_path", r"[^/]+$", 0),
                    F.floor(place / RECORDS_PER_ARCHIVE)).alias("archive"),
        F.pmod(place, F.lit(RECORDS_PER_ARCHIVE)).alias("seq"), "page_id",
        warc.warc_record(F.col("url"), F.col("html")).alias("record"))


def replica_of(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A replica and its index, with damage drawn from the record's id: flipped, cut and lost records, and
    index entries that are off."""
    kind = _drawn(F.coalesce(F.col("page_id").cast("string"), F.lit("")), "damage", 300)
    n = F.octet_length("record")
    damaged = (F.when(kind == 0, F.concat(F.substring("record", 1, n - 5), F.lit("#").cast("binary"),
                                          F.substring("record", n - 3, 4)))
               .when(kind == 1, F.substring("record", 1, n - 7)).otherwise(F.col("record")))
    replica = records.where(kind != 2).withColumn("off", F.when(kind == 3, 7).otherwise(0)).withColumn("record", damaged)
    places = materialize(replica.select("archive", "seq", "off", F.octet_length("record").cast("long").alias("length")), "places")
    index = warc.placed(places).select("archive", "seq", (F.col("expected") + F.col("off")).alias("record_offset"))
    return replica, index


@query("op10_warc_fixity", f"""WITH p AS (SELECT *, row_number() OVER () - 1 AS place FROM pages),
r AS (SELECT page_id, place // {RECORDS_PER_ARCHIVE} AS part, place % {RECORDS_PER_ARCHIVE} AS seq,
  CAST(strlen('WARC/1.0  WARC-Type: response  WARC-Target-URI: ' || coalesce(url, '') || '  Content-Length: ' ||
    CAST(strlen(coalesce(html, '')) AS VARCHAR) || '    ' || coalesce(html, '') || '    ') AS BIGINT) AS length,
  {_DRAWN.format('damage', "coalesce(CAST(page_id AS VARCHAR), '')", 300)} AS kind FROM p),
o AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM r)
SELECT page_id, CAST(seq AS BIGINT) AS seq, CAST(off AS BIGINT) AS record_offset, length,
  CASE kind WHEN 0 THEN 'changed' WHEN 1 THEN 'resized' WHEN 2 THEN 'missing' ELSE 'misplaced' END AS problem
FROM o WHERE kind < 4""")
def warc_fixity(spark: SparkSession, sf: str) -> DataFrame:
    ours = archived(table(spark, sf, "pages"))
    replica, index = replica_of(ours)
    found = warc.audit(ours, replica, replica_index=index)
    return (found.join(ours.select("archive", "seq", "page_id"), ["archive", "seq"])
            .select("page_id", "seq", "record_offset", "length", "problem"))


_TERMS = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")


@query("op11_ranked_search", f"""WITH i AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
f AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {_TERMS} AS term FROM d) GROUP BY ALL),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY r),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, docs),
m AS (SELECT r, 50 + (50 * n * docs) // len AS m FROM n, g),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50""")
def ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return (lexical.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
            .withColumnsRenamed({"item": "item_id", "id": "doc_id"}))


@query("op12_hard_negatives", """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
q AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM p WHERE same),
r AS (SELECT q.anchor_id, q.vec_id AS positive_id, p.vec_id AS negative_id, q.score AS positive_score, p.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY q.anchor_id, q.vec_id ORDER BY p.score DESC, p.vec_id) AS INTEGER) AS rank
  FROM q JOIN p ON p.anchor_id = q.anchor_id AND NOT p.same AND 50 * q.score <= 100 * p.score AND 100 * p.score <= 95 * q.score
  WHERE q.n <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3""")
def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0, "vec_id", "embedding", "label", scale=256.0)


@query("op13_suffix_dedup", """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents),
w AS (SELECT r, unnest(range(0, len(h) // 2 - 199)) AS p, h FROM d),
k AS (SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS k FROM w),
s AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY k) AS c FROM k) WHERE c > 1),
n AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM s),
g AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS g FROM n),
i AS (SELECT r, min(p) AS a, max(p) + 200 AS b FROM g GROUP BY r, g),
j AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS e FROM i),
t AS (SELECT r, sum(b - a) AS removed, count(*) AS spans, max(b) AS z,
  string_agg(substr(h, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS front FROM j JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(front || substr(h, 2 * z + 1), h))) AS kept_sha256 FROM d LEFT JOIN t USING (r)""")
def suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
