"""DataFrame operators, grouped by module: columns, profile, quantiles, running, splits,
metrics, scaling, featurize, forest, net."""
