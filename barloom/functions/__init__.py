"""Column helpers and window layout shared by the operators."""
