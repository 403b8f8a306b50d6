"""Stand-ins for the business datasets, derived from the given tables; the library itself does not use them."""
