"""Entity reporting over versioned financial ledgers, as lazy PySpark DataFrames."""
