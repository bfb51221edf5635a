"""Column functions on quality scores, likelihoods, intervals, sequences and CIGARs."""
