"""DataFrame -> DataFrame operators: feature sets, scores, ordering, reports."""
