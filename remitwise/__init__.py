"""Reconcile billing claims against payer remittances with Spark DataFrames."""
