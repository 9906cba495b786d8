"""What runs jobs: the stored warehouse, the daily batch, the registered queries."""
