"""The queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from termloom.llm import centroids, dual_tree, language, link_graph, minhash, mixing, piece_codec, quality, repeats
from termloom.llm import secret_scan, simhash, topk, warc
from termloom.llm.tables import table, word_count
from termloom.session import scratch_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, budget=2)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


# The public vocabulary that texts are encoded with; a copy of it must be where the query is planned.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they, decoded as a whole, are the text."""
    model = piece_codec.read_model(MODEL_PATH)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = piece_codec.decode(piece_codec.encode(docs, model), model)
    # The model's own mark is the one character that comes back as another.
    same = F.col("decoded").eqNullSafe(F.replace("text", F.lit(piece_codec.MARK), F.lit(" ")))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", same.alias("round_trip"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in secret_scan.BASE]
    return scanned.select(
        "doc_id",
        *(secret_scan.count_of(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined().alias("spans"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(f"quality.{name}" for name in names))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = link_graph.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    merged = warc.capture_histories(warc.read_captures(spark, path))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("words"))
    mixed = mixing.mix(sizes, size="words")
    columns = ("size", "source_size", "target", "taken", F.round("mix.position", 6).alias("position"))
    return mixed.select("doc_id", *(f"mix.{c}" if isinstance(c, str) else c for c in columns))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select(
        "doc_id", language.held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"), least=100)
    zero = F.lit(0).cast("long")
    return cut.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", zero, lambda total, s: total + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = centroids.whole_vectors(table(spark, sf_dir, "embeddings"), dimensions=64, scale=64)
    found = centroids.cluster(whole, k=16, rounds=3)
    sums = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    texts = [(i, ",".join(map(str, center.tolist()))) for i, center in enumerate(found.centroids)]
    named = spark.createDataFrame(texts, "cluster int, centroid string")
    per = sums.join(named, "cluster").select("cluster", "cluster_inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row for each centroid, and one row.
    rows = found.rows.join(F.broadcast(per), "cluster").withColumn("inertia", total.scalar())
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_simhash, op2_pieces, op3_secrets, op4_quality, op5_urls, op6_topk, op7_warc, op8_mixing, op9_language,
        op10_repeats, op11_minhash, op12_centroids, op13_ranked,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secrets": _secrets_sql(), "op4_quality": _quality_sql(), "op6_topk": _TOP_K, "op7_warc": _WARC,
        "op8_mixing": _MIXING, "op10_repeats": _REPEATS, "op11_minhash": _MINHASH, "op12_centroids": _centroids_sql(),
        "op13_ranked": _RANKED,
    }


def _secrets_sql() -> str:
    """Matches lie between the pieces that splitting by the same pattern leaves."""
    kinds = []
    for number, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(
            f"SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, {rule.least} AS least, "
            f"string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS whole, "
            f"regexp_extract_all(text, '{pattern}', {rule.group}) AS part FROM texts"
        )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matched AS ({" UNION ALL ".join(kinds)}),
numbered AS (
  SELECT *, generate_subscripts(whole, 1) AS i FROM matched),
placed AS (
  SELECT doc_id, number, kind, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start, length(whole[i]) AS width
  FROM numbered WHERE length(part[i]) >= least),
spans AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || (start + width), ',' ORDER BY start, number)
           FILTER (kind IN ('assign', 'access', 'hex')) AS base,
         string_agg(kind || ':' || start || ':' || (start + width), ',' ORDER BY start, number) AS spans
  FROM placed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN spans USING (doc_id)
"""


def _quality_sql() -> str:
    common = list(dict.fromkeys(quality.COMMON))
    listed = ", ".join(f"('{word}')" for word in common)
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS key, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
counted AS (
  SELECT key, doc_id, lang, len(words) AS n_words, length(text) AS n_chars,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         length(text) - length(regexp_replace(text, '\\p{{Ll}}+', '', 'g')) AS lower,
         length(text) - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g')) AS upper,
         length(text) - length(regexp_replace(text, '[0-9]+', '', 'g')) AS digit
  FROM split),
placed AS (SELECT key, words, unnest(range(1, len(words) - 1)) AS i FROM split),
windows AS (
  SELECT key, i, count(*) OVER (PARTITION BY key, words[i], words[i + 1], words[i + 2]) AS times FROM placed),
repeated AS (
  SELECT key, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT key, i + unnest([0, 1, 2]) AS place FROM windows WHERE times > 1) GROUP BY key),
classes AS (
  UNPIVOT (SELECT key, lang, n_chars, lower, upper, digit, n_chars - word_chars AS space, n_symbols AS symbol,
                  word_chars - lower - upper - digit - n_symbols AS other FROM counted)
  ON lower, upper, digit, space, symbol, other INTO NAME bin VALUE n),
common AS (SELECT * FROM (VALUES {listed}) AS c(bin)),
found AS (
  SELECT key, word AS bin, count(*) AS n FROM (SELECT key, lower(unnest(words)) AS word FROM split)
  WHERE word IN (SELECT bin FROM common) GROUP BY key, word),
words AS (
  SELECT key, lang, n_words AS n_chars, common.bin, coalesce(n, 0) AS n FROM counted CROSS JOIN common LEFT JOIN found USING (key, bin)
  UNION ALL
  SELECT key, lang, n_words, '', n_words - coalesce((SELECT sum(n) FROM found WHERE found.key = counted.key), 0) FROM counted),
bins AS (SELECT 'class' AS kind, * FROM classes UNION ALL BY NAME SELECT 'word' AS kind, * FROM words),
shares AS (
  SELECT *, n / CAST(n_chars AS DOUBLE) AS p,
         sum(n) OVER (PARTITION BY kind, lang, bin) / CAST(sum(n) OVER (PARTITION BY kind, lang) AS DOUBLE) AS q
  FROM bins WHERE n_chars > 0),
distances AS (
  SELECT key, sqrt(sum(part) FILTER (kind = 'class') / 2) AS by_class, sqrt(sum(part) FILTER (kind = 'word') / 2) AS by_word
  FROM (SELECT key, kind, CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END AS part FROM shares)
  GROUP BY key),
judged AS (
  SELECT *, n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
         n_chars >= {quality.LEAST_CHARS} AND by_class > {quality.MOST_CLASS_DISTANCE}
         OR n_words >= {quality.LEAST_WORDS} AND by_word > {quality.MOST_WORD_DISTANCE} AS unlike
  FROM counted LEFT JOIN repeated USING (key) LEFT JOIN distances USING (key))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
       base_failed, NOT base_failed AND NOT coalesce(unlike, false) AS kept
FROM judged
"""


_WARC = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS body, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages),
groups AS (SELECT body, max(page_id) AS first, count(*) AS copies FROM payloads GROUP BY body),
parts AS (
  SELECT *, CASE WHEN copies > 1 AND first IS DISTINCT FROM page_id THEN first END AS refers_to,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE coalesce(url, '') END AS rest
  FROM payloads JOIN groups USING (body)),
keyed AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS host FROM parts)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
         + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
         + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || coalesce(nullif(lower(substr(rest, length(host) + 1)), ''), '/')
         AS url_key,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM keyed
"""

_REPEATS = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
placed AS (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM texts WHERE n >= 100),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS string FROM placed),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY string ORDER BY doc_id, i) AS place FROM strings)
  WHERE place > 1),
opened AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS opens FROM later)),
spans AS (SELECT doc_id, run, min(i) AS start, max(i) + 100 AS stop FROM opened GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, start, stop, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS since FROM spans),
cut AS (
  SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans, max(stop) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' ORDER BY start) AS kept
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

_TOP_K = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(q.v, lambda x, i: x * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_MIXING = """
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(coalesce(len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT key, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY key),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sources),
filled AS (
  SELECT *, sum(2 * source_size) OVER fullest AS spent, sum(weight) OVER fullest AS gone
  FROM weighed WINDOW fullest AS (ORDER BY 2.0 * source_size / weight, key)),
level AS (
  SELECT max(level) AS level FROM (
    SELECT (1.5 * (SELECT sum(size) FROM sized) - CAST(spent AS DOUBLE)) / ((SELECT sum(weight) FROM weighed) - gone) AS level
    FROM filled WHERE gone < (SELECT sum(weight) FROM weighed)
    UNION ALL SELECT 1.5 * (SELECT sum(size) FROM sized) / (SELECT sum(weight) FROM weighed))),
wanted AS (
  SELECT key, source_size, kind, least(CAST(2 * source_size AS DOUBLE), CAST(level AS DOUBLE) * weight) AS target
  FROM weighed, level),
begun AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY key ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS begins
  FROM sized),
passes AS (
  SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - begins)) AS first,
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - begins)) AS second
  FROM begun JOIN wanted USING (key)),
shares AS (
  SELECT *, CASE WHEN first > 0 THEN begins / target WHEN second > 0 THEN (source_size + begins) / target END AS share
  FROM passes)
SELECT doc_id, size, source_size, target, CAST(first + second AS BIGINT) AS taken,
       round(CASE kind WHEN 0 THEN sqrt(0.25 + 2.0 * share) - 0.5 WHEN 1 THEN share
             ELSE 1.5 - sqrt(2.25 - 2.0 * share) END, 6) AS position
FROM shares
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MINHASH = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
nodes AS MATERIALIZED (
  SELECT row_number() OVER () AS node, words, min(doc_id) AS least,
         CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
              ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM texts GROUP BY words),
held AS MATERIALIZED (SELECT node, unnest(shingles) AS shingle FROM nodes),
shared AS (
  SELECT a.node AS u, b.node AS v, count(*) AS n FROM held a JOIN held b ON a.shingle = b.shingle AND a.node < b.node GROUP BY a.node, b.node),
links AS MATERIALIZED (
  SELECT u, v FROM shared JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v
  WHERE 100 * n >= 85 * (len(a.shingles) + len(b.shingles) - n)),
sides AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached AS (
  SELECT node AS u, node AS v FROM nodes
  UNION SELECT reached.u, sides.v FROM reached JOIN sides ON sides.u = reached.v),
named AS (SELECT reached.u AS node, min(least) AS component_id FROM reached JOIN nodes ON nodes.node = reached.v GROUP BY reached.u)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
       CASE WHEN len(shingles) = 0 THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN len(shingles) = 0 THEN doc_id ELSE component_id END AS kept
FROM texts JOIN nodes USING (words) JOIN named USING (node)
"""


def _centroids_sql(k: int = 16, rounds: int = 3) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT key, vec_id, v, c, d FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY d, c) AS place FROM (
      SELECT key, vec_id, kept.v, c, CAST(list_sum(list_transform(kept.v, lambda x, i: (x - m.v[i]) * (x - m.v[i]))) AS BIGINT) AS d
      FROM kept CROSS JOIN c{i} m))
  WHERE place = 1)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, CASE WHEN moved IS NULL THEN v ELSE moved END AS v FROM c{i} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY place) AS moved FROM (
      SELECT c, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY c, place)
    GROUP BY c) USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS key, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY place NULLS LAST, v) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS place, v FROM kept ORDER BY place NULLS LAST, v LIMIT {k})),{",".join(steps)}
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} m USING (c)
"""


_RANKED = f"""
WITH pattern AS (SELECT '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+' AS p),
texts AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_LOWER}, p) AS terms FROM documents, pattern),
asked AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOWER}, p) AS terms FROM benchmark, pattern),
wanted AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM asked) GROUP BY item, term),
found AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM texts)
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc, term),
counted AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM texts WHERE len(terms) > 0),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM found GROUP BY term), counted),
impacts AS (
  SELECT doc, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(terms) * n_docs) // total)) AS impact
  FROM found JOIN texts USING (doc), counted),
scored AS (
  SELECT item, doc, CAST(sum(times * w * impact) AS BIGINT) AS score
  FROM wanted JOIN weighed USING (term) JOIN impacts USING (term) GROUP BY item, doc),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN texts USING (doc) JOIN asked USING (item) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
