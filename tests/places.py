"""Where the driver's tables lie."""

TESTDATA = "/root/testdata"
