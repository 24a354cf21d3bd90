"""Column helpers shared by the operators; every one returns a Spark ``Column`` expression."""
