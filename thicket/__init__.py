"""Rule-list engine on Spark."""
