"""Panel analytics on Spark: features, rules, splits, evaluation, scoring and monitoring of entity x period tables."""
