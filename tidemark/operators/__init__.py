"""Panel operators: labels, features, ranking, quantiles, drift, sampling, scoring, training."""
