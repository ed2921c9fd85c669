"""Entry for ``spark-submit --py-files streamsync.zip sync_job.py (file|hdfs) <config.json>``."""

import sys

from streamsync.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
