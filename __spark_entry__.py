"""

The corpus is the ``documents`` table, whole: id ``doc_id``, a title and a url made from its columns, and the text.
Query texts are fixed strings or the rows of ``benchmark``. Floating-point results are rounded to 6 places.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import termloom
from termloom.functions import scoring, text, vectors
from termloom.operators import evaluation, querying, statistics
from termloom.plans.index import CorpusIndex, build_index, damaged_files, load_index
from termloom.plans.phrases import documents_containing, phrase_index, phrase_search, save_phrase_index
from termloom.plans.search import ranked_by_solver, result_listing, search, search_batch, write_results
from termloom.session import durable, scratch_path
from termloom.sources import corpus as corpus_source
from termloom.sources import text_index
from termloom.sources.corpus import as_corpus, read_corpus, spread



def _optional(name: str):
    """The module, or None if its file is not there; a fault inside it is raised."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name is None or not (name == missing.name or name.startswith(missing.name + ".")):
            raise
        return None


# The training-data operators can be left out together with their pipeline.
_llm = _optional("termloom.llm.registered")
_pipeline = _optional("corpus_pipeline") if _llm else None

# One query text with a repeated word, words of two languages, a rare word and one that no document has.
QUERY = "The thorreou of eauouon, and THE ouen qqqq"
TOP = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_corpus(
        spread(_table(spark, sf_dir, "documents")),
        id=F.col("doc_id"),
        title=F.concat(F.lit("document "), "doc_id", F.lit(" in "), "lang", F.lit(" from "), "source"),
        url=F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id"),
        text=F.col("text"),
    )


def _index(spark: SparkSession, sf_dir: str, idf_type: str = "log") -> CorpusIndex:
    # doc_id is the key of the table; tests cover the check for repeated ids.
    return build_index(_corpus(spark, sf_dir), idf_type=idf_type, validate=False)


def _saved(spark: SparkSession, sf_dir: str) -> termloom.StoredIndex:
    path = scratch_path(spark, "index")
    build_index(_corpus(spark, sf_dir)).save(path)
    return load_index(spark, path)


def _one_query(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, QUERY)], "query_id bigint, text string")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _round(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 6) for name in names})


# --- scans and tokens


def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json-lines")
    _corpus(spark, sf_dir).write.json(path)
    return read_corpus(spark, path)


def scan_corpus_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of JSON lines, read by one pattern."""
    path, corpus = scratch_path(spark, "json-lines"), _corpus(spark, sf_dir)
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for part in (0, 1):  # together all documents
        corpus.where(half == part).write.json(f"{path}/part={part}")
    return read_corpus(spark, f"{path}/part=*")


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_source.repeated_ids(_turns(spark, sf_dir))


def first_of_each_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_source.first_of_each_id(_turns(spark, sf_dir))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus whose ids repeat: one document per turn, with the conversation's id."""
    return as_corpus(
        _table(spark, sf_dir, "conversations"),
        id="conv_id",
        title="role",
        url=F.concat(F.lit("turn://"), "conv_id", F.lit("/"), "turn"),
    )


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir).select("id", F.array_join(text.tokens(F.col("text")), " ").alias("tokens"))


def token_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir).select("id", F.explode(text.tokens(F.col("text"))).alias("token"))


def doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.documents(_corpus(spark, sf_dir)).select("id", "doc_length")


# --- statistics


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.term_frequency(_corpus(spark, sf_dir)).select("id", "term", "tf")


def distinct_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.distinct_terms(_corpus(spark, sf_dir))


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.document_frequency(statistics.distinct_terms(_corpus(spark, sf_dir)))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).stats


def corpus_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(build_index(_corpus(spark, sf_dir), avgdl="exact", validate=False).stats, "avgdl")


def idf_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_index(spark, sf_dir, "log").vocab, "idf")


def idf_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_index(spark, sf_dir, "normal").vocab, "idf")


# --- index


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_index(spark, sf_dir).vocabulary(), "idf")


def tfidf_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_index(spark, sf_dir).tfidf_postings(), "tfidf")


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(_index(spark, sf_dir).vectors())


def _entries(docs: DataFrame) -> DataFrame:
    # No vector is empty. Before the inner form the optimizer filters by length, and works a decoded vector out twice.
    rows = docs.select("id", "title", "url", "doc_length", F.posexplode_outer("vector").alias("position", "e"))
    return _round(rows.select("id", "title", "url", "doc_length", "position", "e.word_id", "e.weight"), "weight")


def vector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = text_index.parse_vector_lines(text_index.vector_lines(_index(spark, sf_dir)))
    entries = F.inline(vectors.decode(F.col("vectorized")))
    return _round(parsed.select("id", "title", "url", "doc_length", entries), "weight")


def vector_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON text of every document holds, taken from it by path."""
    line = F.split_part("value", F.lit("\t"), F.lit(2))
    names = {"id": "$.id", "title": "$.title", "url": "$.url", "doc_length": "$.docLength", "vector": "$.vectorized"}
    fields = text_index.vector_lines(_index(spark, sf_dir)).select(
        *(F.get_json_object(line, path).alias(name) for name, path in names.items())
    )
    fields = fields.withColumn("entries", vectors.decode(F.col("vector")))  # a column, which is worked out once
    entries = F.col("entries")
    total = F.aggregate(entries, F.lit(0.0), lambda sum_, e: sum_ + e["weight"])
    return _round(
        fields.select(
            "id", "title", "url", F.col("doc_length").cast("long").alias("doc_length"),
            F.size(entries).cast("long").alias("n_entries"),
            F.array_join(F.transform(entries, lambda e: e["word_id"].cast("string")), ",").alias("word_ids"),
            total.alias("weights"),
        ),
        "weights",
    )


def _text_index(spark: SparkSession, sf_dir: str) -> text_index.TextIndex:
    path = scratch_path(spark, "text-index")
    text_index.export_text_index(_index(spark, sf_dir), path)
    return text_index.read_text_index(spark, path)


def text_index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_index(spark, sf_dir).postings.select("term", "id", "tf", "doc_length")


def text_index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_index(spark, sf_dir).summary()


def text_index_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_text_index(spark, sf_dir).vocabulary(), "idf")


def text_index_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(_text_index(spark, sf_dir).vectors())


def index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).summary()


def saved_index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir).summary()


def saved_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir).postings


def saved_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_saved(spark, sf_dir).vocabulary(), "idf")


def saved_document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(_saved(spark, sf_dir).vectors())


def saved_term_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a saved index knows of each term for early termination."""
    return _round(_saved(spark, sf_dir).vocab.select("term", "max_tf", "peak"), "peak")


def refused_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of an index and of a search, each written twice to one path: whether the second was refused."""
    corpus = _corpus(spark, sf_dir)
    index = build_index(corpus, validate=False)
    results = search(index, QUERY, TOP)
    writers = {
        "index": index.save,
        "results": lambda path: write_results(results, path),
        "text results": lambda path: text_index.export_results(results, path),
    }
    rows = []
    for name, write in writers.items():
        path = scratch_path(spark, name.replace(" ", "-"))
        write(path)
        try:
            write(path)
            rows.append((name, False))
        except FileExistsError:
            rows.append((name, True))
    return spark.createDataFrame(rows, "output string, refused boolean")


def index_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each part of a saved index that are missing or have another size than its list says."""
    path = scratch_path(spark, "index")
    build_index(_corpus(spark, sf_dir)).save(path)
    files = spark.read.parquet(f"{path}/files").select("file", F.lit(0).alias("bad"))
    damaged = damaged_files(spark, path).select("file", F.lit(1).alias("bad"))
    part = F.split_part("file", F.lit("/"), F.lit(1)).alias("part")
    return files.unionByName(damaged).groupBy(part).agg(F.sum("bad").alias("damaged"))


# --- queries


def query_vector_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = querying.query_terms(_benchmark(spark, sf_dir))
    return _round(querying.query_vector(terms, _index(spark, sf_dir).vocab, "Basic"), "q_weight")


def query_vector_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = querying.query_terms(_benchmark(spark, sf_dir))
    return _round(querying.query_vector(terms, _index(spark, sf_dir).vocab, "BM25"), "q_weight")


def _matched(spark: SparkSession, sf_dir: str) -> tuple[CorpusIndex, DataFrame]:
    """Postings that match the fixed query, with their weights."""
    index = _index(spark, sf_dir)
    terms = querying.query_terms(_one_query(spark))
    words = [row["term"] for row in terms.select("term").collect()]  # the words of one fixed text
    narrow = index.restricted(words)
    known = querying.known_terms(terms, narrow.vocab, small=True)
    return narrow, querying.matching_postings(narrow.postings, known, small=True)


def matching_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_matched(spark, sf_dir)[1], "idf")


def _term_scores(spark: SparkSession, sf_dir: str, solver: str) -> DataFrame:
    index, matched = _matched(spark, sf_dir)
    return querying.term_scores(matched, index.avgdl, {"score": solver})


def bm25_term_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_term_scores(spark, sf_dir, "BM25").select("query_id", "id", "term", "score"), "score")


def basic_term_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_term_scores(spark, sf_dir, "Basic").select("query_id", "id", "term", "score"), "score")


def bm25_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(querying.relevance(_term_scores(spark, sf_dir, "BM25")), "relevance")


def basic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(querying.relevance(_term_scores(spark, sf_dir, "Basic")), "relevance")


# --- results


def search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_index(spark, sf_dir), QUERY, TOP), "relevance")


def search_bm25_normal_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_index(spark, sf_dir, "normal"), QUERY, TOP), "relevance")


def search_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_index(spark, sf_dir), QUERY, TOP, "Basic"), "relevance")


def search_custom_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_index(spark, sf_dir), QUERY, TOP, scoring.bm25(k1=1.2, b=0.5)), "relevance")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_listing(search(_index(spark, sf_dir), QUERY, TOP))


def written_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "results")
    write_results(search(_index(spark, sf_dir), QUERY, TOP), path)
    schema = "rank int, id string, title string, url string, relevance double"
    return _round(spark.read.schema(schema).json(path), "relevance")


def text_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines, written and read: the JSON's fields, and the relevance behind it."""
    path = scratch_path(spark, "text-results")
    text_index.export_results(search(_index(spark, sf_dir), QUERY, TOP), path)
    json = F.from_json(F.split_part("value", F.lit("\t"), F.lit(1)), "title string, url string, relevance double")
    lines = spark.read.text(path).select(json.alias("j"), F.split_part("value", F.lit("\t"), F.lit(2)).alias("r"))
    return _round(lines.select("j.*", F.col("r").cast("double").alias("score")), "relevance", "score")


def search_all_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More results than a window keeps per task: the ranks come from a distributed sort."""
    return _round(search(_index(spark, sf_dir), QUERY, 1_000_000), "relevance")


def search_batch_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search_batch(_index(spark, sf_dir), _benchmark(spark, sf_dir), TOP), "relevance")


def search_batch_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search_batch(_index(spark, sf_dir), _benchmark(spark, sf_dir), TOP, "Basic"), "relevance")


def search_batch_bm25_exchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of query sides that are too large to broadcast."""
    found = search_batch(_index(spark, sf_dir), _benchmark(spark, sf_dir), TOP, broadcast=False)
    return _round(found, "relevance")


def saved_search_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_saved(spark, sf_dir), QUERY, TOP, "Basic"), "relevance")


def saved_search_batch_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search_batch(_saved(spark, sf_dir), _benchmark(spark, sf_dir), TOP, "Basic"), "relevance")


def saved_search_batch_bm25_exchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_batch(_saved(spark, sf_dir), _benchmark(spark, sf_dir), TOP, broadcast=False)
    return _round(found, "relevance")


def saved_search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search(_saved(spark, sf_dir), QUERY, TOP), "relevance")


def saved_search_batch_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(search_batch(_saved(spark, sf_dir), _benchmark(spark, sf_dir), TOP), "relevance")


def saved_search_batch_bm25_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With early termination whatever the size."""
    found = search_batch(_saved(spark, sf_dir), _benchmark(spark, sf_dir), TOP, early=True)
    return _round(found, "relevance")


def saved_search_batch_basic_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_batch(_saved(spark, sf_dir), _benchmark(spark, sf_dir), TOP, "Basic", early=True)
    return _round(found, "relevance")


# --- evaluation


def _judged(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Both solvers' results for the benchmark, and for each item the documents, of all, that contain its text."""
    items = _benchmark(spark, sf_dir)
    index = _index(spark, sf_dir).once()
    return ranked_by_solver(index, items, TOP), durable(_with_rel(documents_containing(_corpus(spark, sf_dir), index, items)))


def _with_rel(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("rel", F.lit(1))


def phrase_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_search(phrase_index(_corpus(spark, sf_dir)).once(), _benchmark(spark, sf_dir))


def saved_phrase_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = save_phrase_index(_corpus(spark, sf_dir), scratch_path(spark, "phrases"))
    return phrase_search(index, _benchmark(spark, sf_dir))


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a saved phrase index."""
    corpus = _corpus(spark, sf_dir)
    index = save_phrase_index(corpus, scratch_path(spark, "phrases"))
    return _with_rel(documents_containing(corpus, index, _benchmark(spark, sf_dir)))


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, qrels = _judged(spark, sf_dir)
    return _round(evaluation.average_precision(results["BM25"], qrels, TOP), "ap")


def map_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, qrels = _judged(spark, sf_dir)
    ap = evaluation.average_precision(results["BM25"], qrels, TOP, n_rel="corpus")
    return _round(evaluation.mean_average_precision(ap), "map")


def solver_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, qrels = _judged(spark, sf_dir)
    return _round(termloom.compare_results(results, qrels, TOP), "map")


def entry(spark: SparkSession) -> DataFrame:
    """The ten most relevant documents for one text, by BM25, on the smallest tables."""
    return search_bm25(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        scan_corpus, scan_corpus_glob, repeated_ids, first_of_each_id, json_extract, tokenize, token_explode, doc_length,
        term_frequency, distinct_terms, document_frequency, corpus_stats, corpus_stats_exact, idf_log, idf_normal,
        vocabulary, tfidf_postings, document_vectors, vector_parse, vector_json, text_index_postings, text_index_summary,
        text_index_vocabulary, text_index_vectors, index_summary,
        saved_index_summary, saved_postings, saved_vocabulary, saved_document_vectors,
        query_vector_basic, query_vector_bm25, matching_postings,
        bm25_term_scores, basic_term_scores, bm25_scores, basic_scores,
        search_bm25, search_bm25_normal_idf, search_basic, search_custom_bm25, search_all_matches,
        written_results, text_results,
        search_batch_bm25, search_batch_basic, search_batch_bm25_exchanged,
        saved_search_bm25, saved_search_basic, saved_search_batch_bm25, saved_search_batch_basic,
        saved_search_batch_bm25_exchanged, saved_search_batch_bm25_early, saved_search_batch_basic_early,
        saved_term_bounds, refused_outputs, index_completeness,
        phrase_occurrences, saved_phrase_occurrences, judgements, average_precision, map_score, solver_comparison,
    )
    more = _llm.queries() if _llm else {}
    if _pipeline:
        more["pipeline"] = _pipeline.run
    return {f.__name__: f for f in registered} | {"result_listing": listing} | more


# --- the same in SQL

_CORPUS = """
corpus AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         'document ' || doc_id || ' in ' || lang || ' from ' || source AS title,
         'doc://' || source || '/' || doc_id AS url, text
  FROM documents),
stripped AS (SELECT *, regexp_replace(text, '[^\\p{L}]+$', '') AS s FROM corpus),
tokenized AS (
  SELECT id, title, url,
         CASE WHEN text <> '' AND s = '' THEN []::VARCHAR[] ELSE string_split_regex(s, '[^\\p{L}]+') END AS words
  FROM stripped),
docs AS (SELECT id, title, url, CAST(len(words) AS BIGINT) AS doc_length FROM tokenized),
occurrences AS (SELECT id, lower(word) AS term FROM (SELECT id, unnest(words) AS word FROM tokenized)),
tf AS (SELECT id, term, count(*) AS tf FROM occurrences GROUP BY id, term),
stats AS (
  SELECT count(*) AS n_docs, CAST(sum(doc_length) AS BIGINT) AS total_tokens,
         CAST(sum(doc_length) // count(*) AS DOUBLE) AS avgdl
  FROM docs),
vocab AS (
  SELECT term, df, {idf} AS idf, row_number() OVER (ORDER BY term) - 1 AS word_id
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), stats),
"""
_LOG = "ln(CAST(n_docs AS DOUBLE) / CAST(df AS DOUBLE))"
_NORMAL = "CAST(1 AS DOUBLE) / CAST(df AS DOUBLE)"

_QUERY = f"""
queries AS (SELECT CAST(0 AS BIGINT) AS query_id, '{QUERY}' AS text),
"""
_BATCH = """
queries AS (SELECT item_id AS query_id, text FROM benchmark),
"""
_KNOWN = """
query_words AS (
  SELECT query_id, lower(unnest(string_split_regex(regexp_replace(text, '[^\\p{L}]+$', ''), '[^\\p{L}]+'))) AS term
  FROM queries),
query_terms AS (SELECT query_id, term, count(*) AS qtf FROM query_words GROUP BY query_id, term),
known AS (SELECT q.query_id, q.term, q.qtf, v.idf FROM query_terms q JOIN vocab v USING (term)),
matched AS (
  SELECT k.query_id, tf.id, k.term, tf.tf, d.doc_length, k.idf, k.qtf
  FROM known k JOIN tf USING (term) JOIN docs d ON d.id = tf.id),
"""
_BM25 = """tf * idf * (CAST({k1} AS DOUBLE) + 1)
  / (tf + CAST({k1} AS DOUBLE) * (1 + CAST({b} AS DOUBLE) * (doc_length / avgdl - 1)))"""
_BM25_DEFAULT = _BM25.format(k1=2, b=0.75)
_BASIC = "(qtf * idf) * (tf * idf)"


def _base(idf: str = _LOG) -> str:
    return "WITH " + _CORPUS.replace("{idf}", idf)


def _scored(score: str, queries: str = _QUERY, idf: str = _LOG) -> str:
    return (
        _base(idf) + queries + _KNOWN + f"term_scores AS (SELECT matched.*, {score} AS score FROM matched, stats),"
        "scored AS (SELECT query_id, id, sum(score) AS relevance FROM term_scores GROUP BY query_id, id"
        " HAVING sum(score) <> 0),"
    )


_RANKED = """
ranked AS (
  SELECT query_id, id, relevance,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(relevance, 9) DESC, id) AS INTEGER) AS rank
  FROM scored)
"""


def _top(score: str, queries: str = _QUERY, idf: str = _LOG, n: int = TOP, columns: str = "") -> str:
    return (
        _scored(score, queries, idf) + _RANKED + f"SELECT {columns} rank, id, title, url, round(relevance, 6) AS "
        f"relevance FROM ranked JOIN docs USING (id) WHERE rank <= {n}"
    )


def _evaluated() -> str:
    """Average precision of both solvers; a document is relevant if it contains the item's text."""
    return (
        _base()
        + _BATCH
        + _KNOWN
        + f"""
scored AS (
  SELECT query_id, id, sum({_BM25_DEFAULT}) AS bm25, sum({_BASIC}) AS basic
  FROM matched, stats GROUP BY query_id, id),
lists AS (
  SELECT 'BM25' AS solver, query_id, id, bm25 AS relevance FROM scored WHERE bm25 <> 0
  UNION ALL SELECT 'Basic', query_id, id, basic FROM scored WHERE basic <> 0),
ranked AS (
  SELECT * FROM (
    SELECT solver, query_id, id,
           row_number() OVER (PARTITION BY solver, query_id ORDER BY round(relevance, 9) DESC, id) AS rank
    FROM lists) WHERE rank <= {TOP}),
qrels AS (
  SELECT q.query_id, c.id FROM corpus c JOIN queries q ON contains(c.text, q.text)),
marked AS (
  SELECT r.*, CAST(q.id IS NOT NULL AS INTEGER) AS rel
  FROM ranked r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.id = r.id),
judged AS (
  SELECT *, sum(rel) OVER (PARTITION BY solver, query_id ORDER BY rank) AS hits FROM marked),
sums AS (
  SELECT solver, query_id, sum(CAST(hits AS DOUBLE) / rank * rel) AS total, sum(rel) AS found
  FROM judged GROUP BY solver, query_id),
wanted AS (
  SELECT solver, query_id, count(*) AS judged FROM qrels, (VALUES ('BM25'), ('Basic')) AS v(solver) GROUP BY solver, query_id),
ap AS (
  SELECT w.solver, w.query_id, CAST(coalesce(found, 0) AS BIGINT) AS relevant,
         CASE WHEN coalesce(found, 0) = 0 THEN 0 ELSE total / found END AS ap, coalesce(total, 0) / judged AS ap_corpus
  FROM wanted w LEFT JOIN sums s ON s.solver = w.solver AND s.query_id = w.query_id)
"""
    )


_PHRASES = (
    _base()
    + _BATCH
    + """
doc_words AS (SELECT id, [lower(w) for w in words if w <> ''] AS dw FROM tokenized),
item_words AS (
  SELECT query_id, [lower(w) for w in string_split_regex(text, '[^\\p{L}]+') if w <> ''] AS qw
  FROM queries),
pairs AS (
  SELECT query_id, id, qw, dw FROM doc_words JOIN item_words
  ON len(qw) > 0 AND contains(' ' || array_to_string(dw, ' ') || ' ', ' ' || array_to_string(qw, ' ') || ' '))
SELECT query_id, id, CAST(len([i for i in range(1, len(dw) - len(qw) + 2) if dw[i:i + len(qw) - 1] = qw]) AS BIGINT)
  AS occurrences FROM pairs
"""
)


def oracle_sql() -> dict[str, str]:
    more = _llm.oracle_sql() if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return _text_sql() | more


def _text_sql() -> dict[str, str]:
    base, end = _base(), "done AS (SELECT 1) "
    bm25, basic = _scored(_BM25_DEFAULT), _scored(_BASIC)
    vocabulary_sql = base + end + "SELECT term, df, round(idf, 6) AS idf, word_id FROM vocab"
    vectors_sql = "FROM tf JOIN vocab USING (term) JOIN docs USING (id)"
    summary = (
        "SELECT n_docs, total_tokens, avgdl, (SELECT count(*) FROM vocab) AS n_terms, "
        "(SELECT count(*) FROM tf) AS n_postings FROM stats"
    )
    known = base + _BATCH + _KNOWN + end
    vectors_rows = (
        base + end + "SELECT id, title, url, doc_length, CAST(row_number() OVER (PARTITION BY id "
        "ORDER BY word_id) - 1 AS INTEGER) AS position, word_id, round(tf * idf, 6) AS weight " + vectors_sql
    )
    scan = base + end + "SELECT id, title, url, text FROM corpus"
    return {
        "scan_corpus_glob": scan,
        "text_index_vocabulary": vocabulary_sql,
        "text_index_summary": base + end + summary,
        "text_index_vectors": vectors_rows,
        "saved_document_vectors": vectors_rows,
        "vector_json": base + end + "SELECT id, title, url, doc_length, count(term) AS n_entries, "
        "coalesce(string_agg(word_id, ',' ORDER BY word_id), '') AS word_ids, "
        "round(coalesce(sum(tf * idf), 0), 6) AS weights "
        "FROM docs LEFT JOIN tf USING (id) LEFT JOIN vocab USING (term) GROUP BY id, title, url, doc_length",
        "text_results": _scored(_BM25_DEFAULT) + _RANKED + "SELECT title, url, round(relevance, 6) AS relevance, "
        f"round(relevance, 6) AS score FROM ranked JOIN docs USING (id) WHERE rank <= {TOP}",
        "search_batch_bm25_exchanged": _top(_BM25_DEFAULT, _BATCH, columns="query_id,"),
        "saved_search_batch_bm25_exchanged": _top(_BM25_DEFAULT, _BATCH, columns="query_id,"),
        "saved_search_batch_bm25_early": _top(_BM25_DEFAULT, _BATCH, columns="query_id,"),
        "saved_search_batch_basic_early": _top(_BASIC, _BATCH, columns="query_id,"),
        "saved_term_bounds": base + end + "SELECT term, max(tf) AS max_tf, "
        "round(max(tf / (tf + 2.0 * (1 + CAST(0.75 AS DOUBLE) * (doc_length / avgdl - 1)))), 6) AS peak "
        "FROM tf JOIN docs USING (id), stats GROUP BY term",
        "refused_outputs": "SELECT * FROM (VALUES ('index', true), ('results', true), ('text results', true)) "
        "AS v(output, refused) WHERE EXISTS (SELECT 1 FROM documents)",
        "index_completeness": "SELECT part, CAST(0 AS BIGINT) AS damaged FROM (VALUES ('docs'), ('postings'), "
        "('stats'), ('vocab')) AS v(part) WHERE EXISTS (SELECT 1 FROM documents)",
        "saved_search_basic": _top(_BASIC),
        "saved_search_batch_basic": _top(_BASIC, _BATCH, columns="query_id,"),
        "scan_corpus": base + end + "SELECT id, title, url, text FROM corpus",
        "repeated_ids": "SELECT CAST(conv_id AS VARCHAR) AS id, count(*) AS copies FROM conversations "
        "GROUP BY conv_id HAVING count(*) > 1",
        "first_of_each_id": "SELECT id, title, url, text FROM (SELECT *, row_number() OVER (PARTITION BY id "
        "ORDER BY title, url, text) AS n FROM (SELECT CAST(conv_id AS VARCHAR) AS id, role AS title, "
        "'turn://' || conv_id || '/' || turn AS url, text FROM conversations)) WHERE n = 1",
        "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "tokenize": base + end + "SELECT id, lower(array_to_string(words, ' ')) AS tokens FROM tokenized",
        "token_explode": base + end + "SELECT id, term AS token FROM occurrences",
        "doc_length": base + end + "SELECT id, doc_length FROM docs",
        "term_frequency": base + end + "SELECT id, term, tf FROM tf",
        "distinct_terms": base + end + "SELECT DISTINCT id, term FROM occurrences",
        "document_frequency": base + end + "SELECT term, count(DISTINCT id) AS df FROM occurrences GROUP BY term",
        "corpus_stats": base + end + "SELECT n_docs, total_tokens, avgdl FROM stats",
        "corpus_stats_exact": base + end + "SELECT n_docs, total_tokens, "
        "round(CAST(total_tokens AS DOUBLE) / n_docs, 6) AS avgdl FROM stats",
        "idf_log": base + end + "SELECT term, df, round(idf, 6) AS idf FROM vocab",
        "idf_normal": _base(_NORMAL) + end + "SELECT term, df, round(idf, 6) AS idf FROM vocab",
        "vocabulary": vocabulary_sql,
        "saved_vocabulary": vocabulary_sql,
        "tfidf_postings": base + end + "SELECT term, id, tf, doc_length, round(tf * idf, 6) AS tfidf " + vectors_sql,
        "document_vectors": base + end + "SELECT id, title, url, doc_length, CAST(row_number() OVER (PARTITION BY id "
        "ORDER BY word_id) - 1 AS INTEGER) AS position, word_id, round(tf * idf, 6) AS weight " + vectors_sql,
        "vector_parse": base + end + "SELECT id, title, url, doc_length, word_id, round(tf * idf, 6) AS weight "
        + vectors_sql,
        "index_summary": base + end + summary,
        "saved_index_summary": base + end + summary,
        "text_index_postings": base + end + "SELECT term, id, tf, doc_length FROM tf JOIN docs USING (id)",
        "saved_postings": base + end + "SELECT term, id, tf, doc_length FROM tf JOIN docs USING (id)",
        "query_vector_basic": known + "SELECT query_id, term, qtf, round(qtf * idf, 6) AS q_weight FROM known",
        "query_vector_bm25": known + "SELECT query_id, term, qtf, round(idf, 6) AS q_weight FROM known",
        "matching_postings": base + _QUERY + _KNOWN + end
        + "SELECT query_id, id, term, tf, doc_length, round(idf, 6) AS idf, qtf FROM matched",
        "bm25_term_scores": bm25 + end + "SELECT query_id, id, term, round(score, 6) AS score FROM term_scores",
        "basic_term_scores": basic + end + "SELECT query_id, id, term, round(score, 6) AS score FROM term_scores",
        "bm25_scores": bm25 + end + "SELECT query_id, id, round(relevance, 6) AS relevance FROM scored",
        "basic_scores": basic + end + "SELECT query_id, id, round(relevance, 6) AS relevance FROM scored",
        "search_bm25": _top(_BM25_DEFAULT),
        "saved_search_bm25": _top(_BM25_DEFAULT),
        "written_results": _top(_BM25_DEFAULT),
        "search_bm25_normal_idf": _top(_BM25_DEFAULT, idf=_NORMAL),
        "search_basic": _top(_BASIC),
        "search_custom_bm25": _top(_BM25.format(k1=1.2, b=0.5)),
        "search_all_matches": _top(_BM25_DEFAULT, n=1_000_000),
        "result_listing": bm25 + _RANKED + "SELECT CAST(rank - 1 AS INTEGER) AS num, CASE WHEN length(title) > 28 THEN "
        "substring(title, 1, 28) || '..' ELSE title END AS title, printf('%.3f', relevance) AS relevance "
        f"FROM ranked JOIN docs USING (id) WHERE rank <= {TOP}",
        "search_batch_bm25": _top(_BM25_DEFAULT, _BATCH, columns="query_id,"),
        "saved_search_batch_bm25": _top(_BM25_DEFAULT, _BATCH, columns="query_id,"),
        "search_batch_basic": _top(_BASIC, _BATCH, columns="query_id,"),
        "phrase_occurrences": _PHRASES,
        "saved_phrase_occurrences": _PHRASES,
        "judgements": base + _BATCH + end + "SELECT q.query_id, c.id, 1 AS rel FROM corpus c "
        "JOIN queries q ON contains(c.text, q.text)",
        "average_precision": _evaluated() + "SELECT query_id, relevant, round(ap, 6) AS ap FROM ap "
        "WHERE solver = 'BM25'",
        "map_score": _evaluated() + "SELECT count(*) AS n_queries, round(avg(ap_corpus), 6) AS map FROM ap "
        "WHERE solver = 'BM25'",
        "solver_comparison": _evaluated() + "SELECT solver, count(*) AS n_queries, round(avg(ap), 6) AS map FROM ap "
        "GROUP BY solver",
    }
