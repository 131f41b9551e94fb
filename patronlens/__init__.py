"""Customer analytics as Spark jobs: ingest, features, churn labels, models, scores, reports and checks."""
