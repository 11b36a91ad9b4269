"""The layers: staging (bronze), silver, gold, and the order demo."""
