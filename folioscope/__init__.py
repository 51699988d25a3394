"""Document analytics on PySpark: relational, text and rule operators as DataFrame plans."""
