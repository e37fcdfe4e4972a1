"""Dataset-level operators: statistics, ranking, query vectors, scoring, evaluation."""
