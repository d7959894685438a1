"""DataFrame operators: ordered scans, intervals, joins, issues, evidence, folds."""
