"""Feature association and risk scoring for measured cohorts, planned as Spark DataFrames."""
