"""Where the test tables lie."""

import os

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
