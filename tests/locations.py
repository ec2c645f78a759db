"""Where the given tables lie (a module of its own: two folders have a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
