"""Column helpers and small distributed building blocks shared by the operators."""
