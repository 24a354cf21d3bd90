"""Reading and writing tables, and classifying text by ordered rules."""
