"""Where the driver's tables are (a module name that no other test folder has)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
