"""Concordat: table reconciliation and synchronisation over Spark DataFrames."""
