"""User-profile tagging on Spark: declarative tags, shared aggregates, one profile."""
