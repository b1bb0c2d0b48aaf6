"""qualia: a Spark-native data-quality engine (profiles, metrics, rules, checks, reconciliation)."""
