"""wordloom: text cleaning, corpus statistics, features, classifiers and metrics on Spark."""
