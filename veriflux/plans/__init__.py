"""The datasets: bronze, silver, gold and monitoring."""
