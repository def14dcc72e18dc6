"""DataFrame operators: prepare, score, quantiles, stats, join, PCA, autoencoder, uploads."""
