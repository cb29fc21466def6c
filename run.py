"""Entry script for spark-submit."""

import sys

from panelspark.__main__ import main

main(sys.argv[1:])
