"""sievemill: question/answer training-data curation on Spark DataFrames."""
