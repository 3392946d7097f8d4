"""Cleaning, training and scoring of the three datasets with MLlib."""
