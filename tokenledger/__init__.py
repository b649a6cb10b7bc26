"""tokenledger: byte-level BPE training, encoding and token-cost analytics on Spark.

Layout
------
functions/  Column -> Column helpers (whitespace split, UTF-8 byte strings,
            token strings, encode folds, labels, vocabulary regexes).
operators/  DataFrame -> DataFrame operators (word tables, pair counts,
            training, encoding, bolt-on vocabulary).
sources/    Readers for the driver tables, corpus mixes and the fixed
            reference inputs (corpora, sentences, vocabulary lists, rules).
plans/      Reports built from the operators (baselines, gaps, cost) and
            the registered queries with their SQL oracles.
streaming/  The stateless encoders applied to a file stream.
"""

__version__ = "0.1.0"
