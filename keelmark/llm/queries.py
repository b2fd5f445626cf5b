"""The registered queries of the operators, with production parameters, and SQL where it can say the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelmark.llm import bpe, decontamination, html, kmeans, ledger, mixing, ngrams, ranking, search, secrets, sharding, simhash, tokens


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(spark.read.parquet(f"{folder}/pages.parquet")).withColumn("n_chars", F.length("text").cast("bigint"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.round_trip(documents(spark, folder), vocabulary())


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scanned(documents(spark, folder))


def op5_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.judged(ledger.ledger(documents(spark, folder)))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(documents(spark, folder))


def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.scores(documents(spark, folder), min_count=1)


def op9_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_documents(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.clusters(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoded(documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_decontamination, op3_token_files, op4_secret_scan, op5_quality_ledger, op6_simhash, op7_shards,
    op8_lm_scores, op9_quality_scores, op10_mix, op11_lexical_search, op12_kmeans, op13_bpe_codec)}


def _kmeans_sql(k: int = kmeans.K, rounds: int = kmeans.ROUNDS, seed: int = kmeans.SEED, dim: int = kmeans.DIM) -> str:
    """k-means unrolled: one assignment and one move per round, in long form (vector, component)."""
    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
comps AS (SELECT rid, i, v[i] AS x FROM kept, range(1, {dim + 1}) t(i)),
firsts AS (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INT AS c, v
  FROM kept ORDER BY c LIMIT {k}),
c0 AS (SELECT c, i, v[i] AS y FROM firsts, range(1, {dim + 1}) t(i))"""]
    for r in range(rounds + 1):
        parts.append(f"""
d{r} AS (SELECT x.rid, y.c, sum((x.x - y.y) * (x.x - y.y)) AS dist FROM comps x JOIN c{r} y USING (i) GROUP BY x.rid, y.c),
a{r} AS (SELECT rid, arg_min(c, dist * 1000 + c) AS c, min(dist)::BIGINT AS distance FROM d{r} GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (SELECT a.c, x.i, sum(x.x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM comps x JOIN a{r} a USING (rid) GROUP BY a.c, x.i),
c{r + 1} AS (
  SELECT o.c, o.i, coalesce(((s.s - ((s.s % s.n) + s.n) % s.n) // s.n)::BIGINT, o.y) AS y
  FROM c{r} o LEFT JOIN s{r} s ON o.c = s.c AND o.i = s.i)""")
    parts.append(f""",
digests AS (SELECT c, sha256(array_to_string(list(y ORDER BY i), ',')) AS centroid_sha256 FROM c{rounds} GROUP BY c),
final AS (SELECT kept.vec_id, a.c AS cluster, a.distance FROM a{rounds} a JOIN kept USING (rid))
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM final JOIN digests ON cluster = digests.c""")
    return ",".join(parts).replace(",,", ",").replace("),\n,", "),")

_TERMS = "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL = {
    "op11_lexical_search": f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format('text')} AS terms FROM documents),
stats AS (SELECT count(*) FILTER (WHERE len(terms) > 0)::BIGINT AS big_n, coalesce(sum(len(terms)), 0)::BIGINT AS big_l FROM docs),
occ AS (SELECT rid, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs),
tf AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM occ GROUP BY ALL),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
qterms AS (SELECT item_id, text, unnest({_TERMS.format('text')}) AS term FROM items),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf WHERE term IN (SELECT term FROM qterms) GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, stats),
scored AS (
  SELECT q.item_id, q.text, t.doc_id, t.rid,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * t.n * big_n) // big_l))))::BIGINT AS score
  FROM qterms q JOIN tf t USING (term) JOIN w USING (term), stats
  GROUP BY q.item_id, q.text, t.doc_id, t.rid),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST))::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_kmeans": _kmeans_sql(),
    "op5_quality_ledger": """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS place FROM texts),
windows AS (SELECT doc_id, place, array_to_string(words[place:place + 4], ' ') AS five FROM places),
counted AS (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows),
gaps AS (
  SELECT doc_id, least(5, coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY place) - place, 5)) AS covered
  FROM counted WHERE times >= 2),
repeats AS (SELECT doc_id, sum(covered)::BIGINT AS n FROM gaps GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, length(regexp_replace(body, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM texts LEFT JOIN repeats USING (doc_id)),
failed AS (
  SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (100 * n_dup_lines > 30 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
    + 32 * (word_chars > 25 * n_words)::INT + 64 * (2 * n_capitals > word_chars)::INT)::BIGINT AS failures
  FROM measured)
SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM failed""",
    "op7_shards": """
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
buckets AS (
  SELECT d AS depth, substr(bits, 1, d) AS shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM hashed, range(0, 25) t(d) GROUP BY ALL),
fitting AS (
  SELECT h.doc_id, h.n_bytes, b.*, row_number() OVER (PARTITION BY h.doc_id ORDER BY b.depth) AS nth
  FROM hashed h JOIN buckets b ON substr(h.bits, 1, b.depth::INT) = b.shard
  WHERE b.shard_bytes <= 16777216 OR b.shard_docs = 1)
SELECT doc_id, n_bytes, shard, depth::INT AS depth, shard_bytes, shard_docs FROM fitting WHERE nth = 1""",
    "op10_mix": """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM per_source),
filling AS (
  SELECT *, (3 * source_size)::DOUBLE / w AS ratio FROM weighed),
levels AS (
  SELECT *, row_number() OVER f AS nth,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM filling
  WINDOW f AS (ORDER BY ratio, source ASC NULLS LAST),
         b AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (
  SELECT source AS of_source, source_size,
    least((3 * source_size)::DOUBLE, (SELECT arg_min(level, nth) FROM levels WHERE level <= ratio) * w) AS target FROM levels),
ranked AS (
  SELECT sized.*, source_size, target,
    row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS rank,
    ('0x' || substr(md5('7:' || coalesce(source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END::DOUBLE AS rate
  FROM sized JOIN held ON source IS NOT DISTINCT FROM of_source)
SELECT doc_id, size, source_size, target,
  ((floor(rate * rank + start) - floor(rate * (rank - 1) + start)) * size)::BIGINT AS taken FROM ranked""",
}
