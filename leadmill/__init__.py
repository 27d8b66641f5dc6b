"""Account, campaign and matching tables as lazy PySpark DataFrame transformations."""
