"""The operators over their whole tables, for the checker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import common, extraction, licences, mixing, neardup, negatives, packing, personal, quality, search, sharding, tokens, toxicity, vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cycled_weights(docs: DataFrame) -> DataFrame:
    """The sources by code point, NULL last, with the weights 3, 1, 2, repeating."""
    sources = docs.select("source").distinct()
    rank = common.numbered_in_order(sources, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0)), (F.col("rank") % 3 + 1).cast("int"))
    return rank.select("source", weight.alias("weight"))


@_query
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, cycled_weights(docs), share=1.5, max_epochs=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats", "extra")


SQL["op1_mix"] = r"""
WITH base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source
), weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM sums
), steps AS (  -- the sources in the order in which a rising level clamps them
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         1.5::DOUBLE * (SELECT sum(source_size) FROM sums) AS total
  FROM weighed
), level AS (
  SELECT max((total - clamped) / free) AS level FROM steps
), plan AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM level), 1e300) * weight) AS target FROM weighed
), needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM plan
), rows_ AS (
  SELECT b.doc_id, b.source, b.size, n.source_size, n.target, n.repeats,
         CAST(floor(n.target - n.repeats * n.source_size + 0.5) AS BIGINT) AS need,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key, b.doc_id, b.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - b.size AS before
  FROM base b JOIN needs n ON b.source IS NOT DISTINCT FROM n.source
), taken AS (
  SELECT *, CAST(greatest(0, least(size, need - before)) AS BIGINT) AS extra FROM rows_
)
SELECT doc_id, size, source_size, target, CAST(repeats * size + extra AS BIGINT) AS taken, source, repeats, extra FROM taken
"""


@_query
def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.Tree.even(regions=4, racks=2, shards=2)
    placed = sharding.shard(_table(spark, sf_dir, "documents"), tree, tree.grown())
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")


@_query
def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), path, limit=1024)


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


@_query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_key")


@_query
def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("n_passages", F.size("passages")).drop("passages")


@_query
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"), extraction.train(spark))


@_query
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), budget=16_384, buckets=16)


@_query
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/lang/id; every one with a notice speaks for its directory."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.scan(_table(spark, sf_dir, "documents"), path=path, declares=F.lit(True))


def _templates() -> str:
    rows = (f"({i}, '{code}', '{text}')" for i, (code, text) in enumerate(licences.TEMPLATES))
    return ", ".join(rows)


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda w: w <> '')"


#: The words of the longest template.
_LONGEST = max(len(licences._words(text)) for _, text in licences.TEMPLATES)

SQL["op10_licences"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, coalesce(text, '') AS text
  FROM documents
), counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct({_words('text')})) AS word FROM docs) GROUP BY word
), template_words AS (
  SELECT id, code, word, count(*) AS times
  FROM (SELECT id, code, unnest({_words('text')}) AS word FROM (VALUES {_templates()}) AS t(id, code, text)) GROUP BY ALL
), template_weights AS (
  SELECT id, code, word, times * (ln((1 + (SELECT count(*) FROM docs)) / (1 + coalesce(n, 0))) + 1) AS weight
  FROM template_words LEFT JOIN counts USING (word)
), template_units AS (
  SELECT id, code, word, weight / sqrt(sum(weight * weight) OVER (PARTITION BY id)) AS part FROM template_weights
), split AS (
  SELECT rid, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {{'line': i - 1, 'text': x}}), recursive := true) FROM docs
), lines AS (
  SELECT rid, line, {_words('text')} AS words FROM split
), placed AS (
  SELECT rid, line, words, len(words) AS n, sum(len(words)) OVER so_far - len(words) AS before,
         count(CASE WHEN len(words) = 0 THEN 1 END) OVER so_far AS blanks
  FROM lines WINDOW so_far AS (PARTITION BY rid ORDER BY line)
), windows AS (  -- runs of lines with words; without its last line a run is shorter than the longest template
  SELECT a.rid, a.line, b.line - a.line + 1 AS size FROM placed a JOIN placed b
    ON a.rid = b.rid AND a.blanks = b.blanks AND b.line BETWEEN a.line AND a.line + {_LONGEST} AND a.n > 0 AND b.n > 0
       AND (b.line = a.line OR b.before - a.before < {_LONGEST})
), weighed AS (
  SELECT rid, line, size, word, times * (ln((1 + (SELECT count(*) FROM docs)) / (1 + n)) + 1) AS weight
  FROM (SELECT rid, line, size, word, count(*) AS times
        FROM (SELECT w.rid, w.line, size, unnest(words) AS word FROM windows w
              JOIN placed p ON p.rid = w.rid AND p.line BETWEEN w.line AND w.line + size - 1) GROUP BY ALL)
  JOIN counts USING (word)
), norms AS (
  SELECT rid, line, size, sqrt(sum(weight * weight)) AS norm FROM weighed GROUP BY ALL
), dots AS (
  SELECT rid, line, size, id, code, sum(weight * part) AS dot FROM weighed JOIN template_units USING (word) GROUP BY ALL
), scored AS (
  SELECT rid, line, size, code, round(dot / norm, 9) AS score FROM dots JOIN norms USING (rid, line, size)
), best AS (
  SELECT * FROM scored WHERE score >= 0.6
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, size, line, code) = 1
), own AS (
  SELECT docs.rid, doc_id, path, code, score, line,
         CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS directory
  FROM docs LEFT JOIN best USING (rid)
), stated AS (
  SELECT directory AS ancestor, code AS licence FROM own WHERE code IS NOT NULL GROUP BY directory, code
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY count(*) DESC, code) = 1
), above AS (
  SELECT DISTINCT directory, unnest(list_transform(range(0, len(string_split(directory, '/')) + 1),
         lambda i: array_to_string(string_split(directory, '/')[1:i], '/'))) AS ancestor
  FROM own
), nearest AS (
  SELECT directory, arg_max(licence, length(ancestor)) AS licence, arg_max(ancestor, length(ancestor)) AS ancestor
  FROM above JOIN stated USING (ancestor) GROUP BY directory
)
SELECT doc_id, path, coalesce(code, licence) AS licence, score, CAST(line AS INTEGER) AS line,
       CASE WHEN code IS NULL THEN ancestor END AS inherited_from
FROM own LEFT JOIN nearest USING (directory)
"""


@_query
def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(_table(spark, sf_dir, "documents"))


@_query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op13_search"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT rid, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), stats AS (
  SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized
), postings AS (
  SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), asked AS (
  SELECT item, item_id, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark WHERE text IS NOT NULL)
  GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, stats WHERE term IN (SELECT term FROM asked) GROUP BY term, all_docs
), scored AS (
  SELECT item, item_id, rid, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * all_docs) // all_terms))))) AS BIGINT) AS score
  FROM postings JOIN asked USING (term) JOIN weighed USING (term), stats GROUP BY item, item_id, rid, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@_query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 50 == 0, relabel=label)


SQL["op11_negatives"] = """
WITH rows_ AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.rid <> b.rid AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT rid, anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id, other) AS slot
  FROM scored WHERE same QUALIFY slot <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.rid, slot ORDER BY score DESC, other_id, other) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.rid = s.rid AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
