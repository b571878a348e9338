"""Where the tests find the given tables."""

SMALL = "/root/testdata/sf0.001"
