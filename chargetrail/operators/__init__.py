"""DataFrame-to-DataFrame operators, used through `df.transform`."""
