"""tablewarden: history, checks, health, comparison and standardisation of published tables on Spark."""
