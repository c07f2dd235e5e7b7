"""Where the test tables lie."""

import os

TESTDATA = os.environ.get("FERRYLINE_TESTDATA", "/root/testdata")
