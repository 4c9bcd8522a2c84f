"""Compositions of the operators: the full build, statistics, SQL and documents."""
