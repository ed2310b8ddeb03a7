"""The registered queries: driver tables as inputs, one callable per key, and the matching SQL."""
