"""Where the smallest set of driver tables lies (a module of its own: two folders have a ``conftest``)."""

SMALL = "/root/testdata/sf0.001"
