"""Delay-network analytics on Spark DataFrames.

The package turns flight on-time records into a curated table and answers
questions over it: sketches, propagation ranks, components, similarity,
noisy releases and the audits that compare approximate with exact answers.
"""

__version__ = "0.1.0"
