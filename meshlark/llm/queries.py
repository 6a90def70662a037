"""Registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meshlark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_jaccard_join", f"""
WITH RECURSIVE texts AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first_id, count(*) AS n_copies
  FROM documents GROUP BY 1),
words AS (SELECT first_id, list_filter(string_split_regex({ASCII_LOWER.format('text')}, '[\\x09-\\x0D ]+'),
  lambda x: x <> '') AS w FROM texts),
shingles AS (SELECT DISTINCT first_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT first_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT first_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT x.first_id AS a, y.first_id AS b, count(*) AS n_both FROM shingles x JOIN shingles y USING (s)
  WHERE x.first_id <> y.first_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.first_id = a JOIN sizes y ON y.first_id = b
  WHERE 5 * n_both >= 4 * (x.n + y.n - n_both)),
reach(a, b) AS (SELECT first_id, first_id FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, t.first_id, t.n_copies, (SELECT count(*) FROM links l WHERE l.a = t.first_id) AS n_links, c.class_id
FROM documents d JOIN texts t ON t.text = coalesce(d.text, '')
JOIN (SELECT a, min(b) AS class_id FROM reach GROUP BY a) c ON c.a = t.first_id""")
def op1_jaccard_join(spark, d):
    from meshlark.llm.jaccard_join import jaccard_links

    return jaccard_links(documents(spark, d), width=5, threshold=0.8).drop("digest")


@query("op2_packing")
def op2_packing(spark, d):
    import public_tokenizers

    from meshlark.llm.packing import BATCH_BYTES, BATCH_ROWS, READ_ROWS, pack, piece_digest

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    pieces = pack(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=1)
    return pieces.select("doc_id", "start", *piece_digest(), "doc_tokens", "sequence_id", "offset", "padded_length")


@query("op3_topk_search", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10""")
def op3_topk_search(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.topk_search import largest_products, scaled

    vectors = scaled(spark.read.parquet(f"{d}/embeddings.parquet"))
    return largest_products(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query("op4_language_id")
def op4_language_id(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.language_id import fit_language_model, identify

    docs = documents(spark, d).select("doc_id", "text", "lang", "source")
    found = identify(docs, fit_language_model(docs), declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "language", "language_posterior", F.col("lang").alias("declared"), "language_kept")


@query("language_of_pages")
def language_of_pages(spark, d):
    from meshlark.llm.language_id import fit_language_model, identify, page_evidence, page_text

    pages = spark.read.parquet(f"{d}/pages.parquet").withColumn("text", page_text())
    found = identify(pages, fit_language_model(documents(spark, d)), **page_evidence())
    return found.select("page_id", "url", "language", "language_posterior", "language_kept")


@query("op5_suffix_tree_lm")
def op5_suffix_tree_lm(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.suffix_tree_lm import BATCH_BYTES, BATCH_ROWS, score_texts

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return score_texts(documents(spark, d), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query("op6_suffix_repeats")
def op6_suffix_repeats(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.repeats import remove_repeats

    cut = remove_repeats(documents(spark, d), length=400)
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_source_mixing", """
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('=' || source, '') AS s,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D ]+')) AS tokens FROM documents),
src AS (SELECT s, CAST(sum(tokens) AS BIGINT) AS t FROM d GROUP BY s),
every AS (SELECT sum(t)::BIGINT AS total, max(t)::DOUBLE AS top FROM src),
search(low, high) AS (SELECT 0, 1000000 UNION ALL
  SELECT CASE WHEN fits THEN low ELSE m + 1 END, CASE WHEN fits THEN m ELSE high END FROM (
    SELECT low, high, m, (SELECT any_value(total) * pow(min(t / top), m / 1000000.0::DOUBLE - 1)
        / (sum(pow(t / top, m / 1000000.0::DOUBLE)) * any_value(top)) <= 2.0::DOUBLE * (1 + 1e-12)
      FROM src, every WHERE t > 0) AS fits
    FROM (SELECT low, high, (low + high) // 2 AS m FROM search WHERE low < high))),
alpha AS (SELECT low / 1000000.0::DOUBLE AS a FROM search WHERE low = high),
power AS (SELECT sum(pow(t / top, a)) AS z FROM src, every, alpha WHERE t > 0),
plan AS (SELECT s, t, CASE WHEN t > 0 THEN floor(total::DOUBLE * (pow(t / top, a) / z))::BIGINT ELSE 0 END AS budget,
    greatest(ceil(t / 1000000.0::DOUBLE), 1)::BIGINT AS blocks FROM src, every, alpha, power),
placed AS (SELECT d.*, t, budget, ('0x' || substr(md5('0:block:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % blocks AS block
  FROM d JOIN plan USING (s)),
held AS (SELECT s, block, sum(tokens)::BIGINT AS h, (any_value(budget)::HUGEINT * sum(tokens)::HUGEINT // nullif(any_value(t)::HUGEINT, 0))::BIGINT AS own
  FROM placed GROUP BY s, block),
parts AS (SELECT s, block, CASE WHEN h > 0 THEN own // h ELSE 1 END AS whole, CASE WHEN h > 0 THEN own % h ELSE 0 END AS rest
  FROM held),
runs AS (SELECT p.*, whole, rest, sum(tokens) OVER (PARTITION BY p.s, p.block
    ORDER BY md5('0:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed p JOIN parts b ON b.s = p.s AND b.block = p.block)
SELECT doc_id, source, e AS mix_epoch, block AS mix_block, tokens AS mix_tokens,
  row_number() OVER (PARTITION BY s, block, e ORDER BY md5('0:' || e || ':' || coalesce(doc_id::VARCHAR, ''))) AS place
FROM (SELECT *, unnest(range(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS e FROM runs)""")
def op7_source_mixing(spark, d):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from meshlark.llm.mixing import mix, word_count

    counted = documents(spark, d).select("doc_id", "source", word_count().alias("tokens"))
    mixed = mix(counted, most_repeats=2.0, tokens=F.col("tokens"))
    order = Window.partitionBy("source", "mix_block", "mix_epoch").orderBy("mix_key")
    return mixed.select("doc_id", "source", "mix_epoch", "mix_block", "mix_tokens",
                        F.row_number().over(order).cast("long").alias("place"))


@query("op8_fingerprints")
def op8_fingerprints(spark, d):
    from meshlark.llm.fingerprints import edited_likeness

    return edited_likeness(documents(spark, d))


@query("op9_quality")
def op9_quality(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.quality import fit_quality, score_quality

    docs, labels = documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit_quality(docs, labels, ~held_out)
    scored = score_quality(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op10_personal_data")
def op10_personal_data(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.personal_data import KINDS, find_personal_data, joined

    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return find_personal_data(documents(spark, d)).select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added)


@query("op11_token_alignment")
def op11_token_alignment(spark, d):
    import public_tokenizers
    from pyspark.sql import functions as F

    from meshlark.llm.token_alignment import align

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(documents(spark, d), *paths, digest=True).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def _vector_codes_sql(parts: int = 16, entries: int = 64, width: int = 4, rounds: int = 2) -> str:
    """Codebooks as rows (p, e, c: list of components), round by round."""
    near = """n{r} AS MATERIALIZED (SELECT row, p, x, unnest(best, recursive := true) FROM (SELECT v.row, v.p, v.x,
      min({{'d': list_sum(list_transform(list_zip(v.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': b.e}}) AS best
      FROM v JOIN b{r} b USING (p) GROUP BY ALL)),
"""
    moved = """b{s} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (SELECT p, e,
      list(floor(t / n)::BIGINT ORDER BY i) AS c FROM (SELECT p, e, i, sum(x[i])::DOUBLE AS t, count(*) AS n
        FROM (SELECT *, unnest(range(1, {width} + 1)) AS i FROM n{r}) GROUP BY ALL) GROUP BY ALL) m USING (p, e)),
"""
    steps = "".join(near.format(r=r) + moved.format(r=r, s=r + 1, width=width) for r in range(rounds))
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT row, p, x[{width} * p + 1:{width} * p + {width}] AS x FROM (SELECT *, unnest(range({parts})) AS p FROM k)),
b0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM v WHERE row <= {entries}),
{steps}{near.format(r=rounds)}
coded AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY row),
named AS (SELECT k.vec_id, k.label, code, error FROM coded JOIN k USING (row))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM named"""


@query("op12_vector_codes", _vector_codes_sql())
def op12_vector_codes(spark, d):
    from pyspark.sql import functions as F

    from meshlark.llm.vector_codes import codebooks_digest, encode, fit_codebooks

    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    books = fit_codebooks(vectors, parts=16, entries=64, rounds=2, scale=256.0)
    return encode(vectors, books, scale=256.0).select("vec_id", "code", "error", "label_error",
                                                      F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


#: What is known of hosts and paths without a classifier.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op13_url_filter")
def op13_url_filter(spark, d):
    from meshlark.llm.url_filter import apply_rules, fit_url_model, judge_urls

    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    model = fit_url_model(apply_rules(pages, URL_RULES))
    return judge_urls(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")
