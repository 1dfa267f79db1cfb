"""Launcher for spark-submit: ``spark-submit --py-files stockyard.zip stockyard_job.py ...``."""

import sys

from stockyard.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
