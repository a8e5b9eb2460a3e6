"""DataFrame operators: lazy, no driver-side loops over rows."""
