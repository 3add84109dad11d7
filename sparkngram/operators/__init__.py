"""DataFrame operators: sampling, features, n-grams, language models,
prediction, evaluation and corpus statistics."""
