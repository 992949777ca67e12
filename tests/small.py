"""Where the smallest test tables are."""

SMALL = "/root/testdata/sf0.001"
