"""Script for ``spark-submit``, run from the folder that holds the package."""

import sys

from skytally.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
