"""Folders of the driver's tables; a module of its own, since every folder's conftest has the same name."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
