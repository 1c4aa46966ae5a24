"""Column functions and small relational helpers the operators are made of."""
