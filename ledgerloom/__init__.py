"""Account cash-flow panels on Spark: weekly series, quality, policy, features and models."""
