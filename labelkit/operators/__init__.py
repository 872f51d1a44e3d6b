"""DataFrame operators: cleaning, profiling, splitting, metrics, features, models."""
