import pytest

from termloom import average_precision, build_index, compare_solvers, documents_containing, mean_average_precision

RESULTS = [
    (1, 1, "a"), (1, 2, "b"), (1, 3, "c"),  # relevant: a, c, and d which is not returned
    (2, 1, "x"), (2, 2, "y"),  # relevant: y beyond none, z not returned
    (3, 1, "x"),  # nothing relevant at all
    (4, 1, "q"),  # relevant: r, not returned
]
QRELS = [(1, "a", 1), (1, "b", 0), (1, "c", 1), (1, "d", 1), (1, "d", 1), (2, "y", 1), (2, "z", 1), (3, "x", 0),
         (4, "r", 1), (5, "s", 1)]


@pytest.fixture(scope="module")
def judged(spark):
    return (
        spark.createDataFrame(RESULTS, "query_id int, rank int, id string"),
        spark.createDataFrame(QRELS, "query_id int, id string, rel int"),
    )


def ap(judged, **options):
    return {r["query_id"]: r["ap"] for r in average_precision(*judged, **options).collect()}


def test_average_precision_over_returned(judged):
    assert ap(judged) == pytest.approx({1: (1 + 2 / 3) / 2, 2: 1 / 2, 4: 0.0, 5: 0.0})


def test_average_precision_over_corpus(judged):
    assert ap(judged, n_rel="corpus") == pytest.approx({1: (1 + 2 / 3) / 3, 2: (1 / 2) / 2, 4: 0.0, 5: 0.0})


def test_cut_at_k(judged):
    assert ap(judged, k=1) == pytest.approx({1: 1.0, 2: 0.0, 4: 0.0, 5: 0.0})


def test_mean(judged):
    row = mean_average_precision(average_precision(*judged)).first()
    assert row["n_queries"] == 4
    assert row["map"] == pytest.approx((5 / 6 + 1 / 2) / 4)


def test_bad_n_rel(judged):
    with pytest.raises(ValueError):
        average_precision(*judged, n_rel="all")


def test_compare_solvers(spark, micro):
    queries = spark.createDataFrame([(1, "cat dog"), (2, "bird fish")], "query_id int, text string")
    qrels = spark.createDataFrame([(1, "1", 1), (2, "2", 1)], "query_id int, id string, rel int")
    rows = {r["solver"]: r for r in compare_solvers(build_index(micro), queries, qrels).collect()}
    assert rows["BM25"]["map"] == pytest.approx((1 + 1 / 2) / 2)
    assert rows["Basic"]["map"] == pytest.approx((1 + 1 / 2) / 2)
    assert rows["Basic"]["n_queries"] == 2


def test_judgements_cover_documents_that_no_solver_returned(spark, make_corpus):
    texts = [f"x alpha beta gamma {'alpha beta ' * 5}"] * 12 + ["y prealpha beta gammas", "short one"]
    corpus = make_corpus(*texts)
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "ort o"), (3, "nowhere at all here"), (4, "")], "query_id int, text string")
    found = documents_containing(corpus, build_index(corpus).once(), items).collect()
    wanted = {(q, str(i)) for q, t in ((1, "alpha beta gamma"), (2, "ort o"), (4, "")) for i, d in enumerate(texts, 1) if t in d}
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)
