"""Brindle: DataFrame-native cleaning, imputation, upsert, aggregation and like-item analytics."""
