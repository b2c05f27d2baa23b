"""Column functions and the distributed ranking helpers the operators share."""
