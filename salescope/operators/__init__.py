"""Aggregates, ordered computations, baskets, clustering and neighbour search."""
