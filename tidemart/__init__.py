"""Event and order warehouse for an online shop, as PySpark DataFrame operators."""
