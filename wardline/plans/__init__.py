"""Compositions of operators for the usual jobs: enriching, featuring, training, scoring."""
