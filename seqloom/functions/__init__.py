"""Column functions on bases, qualities, CIGAR strings and read names."""
