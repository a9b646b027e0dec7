"""DataFrame-level operators: relational helpers, arrays, DML + snapshot
tables, skew handling, the churn model and run tracking."""
