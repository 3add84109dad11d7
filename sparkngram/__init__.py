"""Spark-native n-gram language modelling.

Corpus -> clean -> tokens -> n-gram counts -> scored models (stupid
backoff, Katz / Good-Turing, absolute discounting, Kneser-Ney,
interpolation) -> batch next-word prediction -> evaluation, plus corpus
statistics.  Every stage is a DataFrame transformation; the only actions
are the ones a caller asks for.
"""

__version__ = "0.1.0"
