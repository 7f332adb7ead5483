"""Where the smallest test tables lie (a module of its own: conftest is not imported by tests)."""

SMOKE = "/root/testdata/sf0.001"
