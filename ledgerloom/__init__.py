"""ledgerloom: credit-risk data jobs as PySpark DataFrame transformations."""
