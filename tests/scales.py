"""Folders of the test tables.  Not in conftest.py, whose name tests/llm shares."""

SF_SMALL = "/root/testdata/sf0.001"
