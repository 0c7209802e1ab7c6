"""Operators on reads, alignments, intervals, counts and key tables."""
