"""DataFrame operators: joins, labels, text aggregation, sampling, trees, scores."""
