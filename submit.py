"""spark-submit entry point for the ledgerhawk command line:

    zip -r ledgerhawk.zip ledgerhawk
    spark-submit --py-files ledgerhawk.zip submit.py run-day --root s3://wh --day 2024-01-15 --mode scd2
"""

import sys

from ledgerhawk.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
