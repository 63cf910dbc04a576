"""Operators over datasets: policies, permutation, leak scan, coverage, verification."""
