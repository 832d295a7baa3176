"""Training-data operators: near duplicates, quality, secrets, mixing and scoring."""
