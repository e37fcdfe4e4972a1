"""Full-text indexing and ranked retrieval on Spark DataFrames."""

from termloom.operators.evaluation import average_precision, mean_average_precision
from termloom.plans.index import Index, StoredIndex, build_index, load_index
from termloom.plans.phrases import PhraseIndex, documents_containing, phrase_index, phrase_search, save_phrase_index
from termloom.plans.search import (
    compare_results,
    compare_solvers,
    result_listing,
    search,
    search_batch,
    write_results,
)
from termloom.sources.corpus import as_corpus, read_corpus
from termloom.sources.text_index import export_results, export_text_index, read_text_index

__all__ = [
    "Index",
    "PhraseIndex",
    "StoredIndex",
    "as_corpus",
    "average_precision",
    "build_index",
    "compare_results",
    "compare_solvers",
    "documents_containing",
    "export_results",
    "export_text_index",
    "load_index",
    "mean_average_precision",
    "phrase_index",
    "phrase_search",
    "read_corpus",
    "read_text_index",
    "result_listing",
    "save_phrase_index",
    "search",
    "search_batch",
    "write_results",
]
