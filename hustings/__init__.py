"""hustings: address-to-precinct analytics on Spark DataFrames."""
