"""Names that several test modules use."""

import os
from pathlib import Path

DATA_DIR = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))
SALES_SCHEMA = "date date, store_nbr long, family string, sales double, onpromotion double"
