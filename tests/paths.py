"""Folders that several tests read."""

SF_TINY = "/root/testdata/sf0.001"
