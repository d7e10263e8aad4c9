"""DataFrame to DataFrame operators: aggregates, windows, quantiles, profiles, checks."""
