"""Cast-vote-record analytics on PySpark: DataFrame operators, plans and rules."""
