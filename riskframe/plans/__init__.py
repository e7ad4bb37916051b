"""Compositions of operators: the study's phase-level workflows."""
