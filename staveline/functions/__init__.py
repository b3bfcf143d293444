"""Column -> Column helpers; all of them compile to built-in expressions."""
