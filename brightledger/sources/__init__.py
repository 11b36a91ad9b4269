"""Inputs and outputs: reference tables, published tables, and the bank inputs
mapped from order and event tables."""
