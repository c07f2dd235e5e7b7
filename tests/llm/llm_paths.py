"""Where the test tables of this folder lie."""

import os

SF_DIR = os.environ.get("FERRYLINE_TESTDATA", "/root/testdata") + "/sf0.01"
