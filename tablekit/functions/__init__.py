"""Scalar, date and array helpers (built-in expressions, JVM-side) and the
UDF surface (SQL functions first, Arrow-batched pandas UDFs second)."""
