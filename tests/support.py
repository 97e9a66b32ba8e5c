"""Values that several test modules share."""

from datetime import datetime

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"
START = datetime(2026, 3, 1, 12, 0, 0)
HOME = (40.0, -74.0)
FAR = (34.0, -118.0)
