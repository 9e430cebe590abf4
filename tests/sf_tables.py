"""Folders of the given tables; a module of its own, as every folder of tests has a conftest."""

import os

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
