"""Graph, matching, score, matrix and table operators."""
