"""Loan feature store on Spark: bronze, silver and gold tables by snapshot month."""
