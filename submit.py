"""spark-submit launcher: ``spark-submit --py-files lakeload.zip submit.py <command> ...``
(``python -m lakeload.cli <command> ...`` locally)."""

import sys

from lakeload.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
