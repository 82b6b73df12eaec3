"""Compositions of the operators: document rows, bronze and silver loads, gold marts."""
